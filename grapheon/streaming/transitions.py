"""Transitions between consecutive events of a user, in batch and as a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

PAIRS = "user_id long, src string, dst string, event_id long"


def transitions(events: DataFrame) -> DataFrame:
    """user_id, src, dst, event_id: each event with the one before it of the same user."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return events.select("user_id", F.lag("event_type").over(order).alias("src"), F.col("event_type").alias("dst"), "event_id").filter("src is not null")


def _step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    last = state.get[0] if state.exists else None
    rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
    out = []
    for kind, event in zip(rows["event_type"], rows["event_id"], strict=True):
        if last is not None:
            out.append((key[0], last, kind, event))
        last = kind
    if last is not None:
        state.update((last,))
    yield pd.DataFrame(out, columns=["user_id", "src", "dst", "event_id"])


def stream_transitions(events: DataFrame) -> DataFrame:
    """The same over a stream whose events of a user come in order; state is one event type a user."""
    return events.groupBy("user_id").applyInPandasWithState(_step, PAIRS, "last string", "append", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Events by type and window; with a watermark, so a stream closes its windows."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")

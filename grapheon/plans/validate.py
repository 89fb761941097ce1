"""Checking the query blocks of a document: each is parsed, analysed, and run with a time limit, and none that writes is run.

A document's blocks are fenced with ```sql. Placeholders and bind parameters get values that `binds.bind_values` finds in the graph. A block runs under a job tag of its own;
a timer cancels the tag's jobs, so a slow block ends on the cluster, too, and the next one starts.
"""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from grapheon.plans import guard

FENCE = re.compile(r"^```sql[ \t]*\n(.*?)^```", re.M | re.S)
QUOTED = re.compile(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|`[^`]*`|--[^\n]*|/\*.*?\*/", re.S)
BIND = re.compile(r"(?<![\w:]):([A-Za-z_]\w*)")

#: What stands in an example for a value from a question, and the discovered value that it takes.
PLACEHOLDERS = {"<NAME>": "name", "<ELEMENT>": "display", "<STATE>": "state_name", "<PART>": "part_name", "<ATTRIBUTE>": "attribute", "<WORD>": "word"}
#: Parts of a parameter's name, and the discovered values that it takes, the first that there is. The first row that fits counts; other names take the name.
GUESSES = (
    (("element", "node"), ("element", "start")),
    (("start", "root", "from", "vertex", "_id"), ("start",)),
    (("state",), ("state", "start")),
    (("requirement", "req"), ("requirement",)),
    (("short", "identifier"), ("short",)),
    (("attribute", "property", "quantity", "measure"), ("attribute",)),
    (("module", "model"), ("module",)),
    (("kind", "type"), ("kind",)),
    (("label",), ("label",)),
    (("file",), ("file",)),
    (("word", "term", "search", "text"), ("word",)),
)


@dataclass
class Checked:
    """n: the block's number from 1; binds: its parameters, sorted; error: why it doesn't parse or run."""

    n: int
    query: str
    parses: bool = False
    runs: bool = False
    rows: int = 0
    error: str | None = None
    binds: list[str] = field(default_factory=list)


SCHEMA = "n int, query string, parses boolean, runs boolean, rows long, error string, binds array<string>"


def blocks(document: str) -> list[str]:
    return [b.strip() for b in FENCE.findall(document)]


def parameters(query: str) -> list[str]:
    """Names of the bind parameters, outside of quotes and comments."""
    return sorted(set(BIND.findall(QUOTED.sub("''", query))))


def guess(names: Iterable[str], values: Mapping[str, Any]) -> dict[str, Any]:
    """A value for each parameter, from what it is called."""
    out = {}
    for name in names:
        keys = next((keys for parts, keys in GUESSES if any(p in name.lower() for p in parts)), ("name",))
        out[name] = next((values[k] for k in keys if values.get(k) is not None), None)
    return out


def substitute(query: str, values: Mapping[str, Any]) -> str:
    for token, key in PLACEHOLDERS.items():
        found = values.get(key)
        query = query.replace(token, "" if found is None else str(found).replace("'", "''"))
    return query


def limited(df: DataFrame, seconds: float) -> int:
    """How many rows df has, all columns of each computed and none kept. TimeoutError if that isn't done after so many seconds; its jobs are cancelled then."""
    sc, tag, late = df.sparkSession.sparkContext, f"limited-{uuid.uuid4().hex}", threading.Event()

    def cancel() -> None:
        late.set()
        sc.cancelJobsWithTag(tag)

    timer = threading.Timer(seconds, cancel)
    sc.addJobTag(tag)
    timer.start()
    try:
        seen = Observation()
        named = df.toDF(*(f"c{i}" for i in range(len(df.columns))))  # a result may have a name twice
        named.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
        out = seen.get["n"]
    except Exception as error:
        if late.is_set():
            raise TimeoutError(f"no result after {seconds:g} s") from error
        raise
    finally:
        timer.cancel()
        sc.removeJobTag(tag)
    return out


def _said(error: Exception) -> str:
    text = error.getMessage() if isinstance(error, PySparkException) and error.getMessage() else str(error)
    return f"{type(error).__name__}: {text.splitlines()[0] if text else ''}"


def check(spark: SparkSession, document: str, values: Mapping[str, Any], seconds: float = 90.0) -> list[Checked]:
    """Each block of the document, in order. A block with a parameter that no value is known for runs with null."""
    out = []
    for n, block in enumerate(blocks(document), 1):
        query = substitute(block, values)
        row = Checked(n, query, binds=parameters(query))
        out.append(row)
        try:
            df = guard.read_only(spark, query, guess(row.binds, values))  # parsed, refused or analysed; nothing runs yet
            row.parses = True
            row.rows = limited(df, seconds)
            row.runs = True
        except Exception as error:  # a block's fault is a row of the result
            row.error = _said(error)
    return out


def checked(spark: SparkSession, document: str, values: Mapping[str, Any], seconds: float = 90.0) -> DataFrame:
    rows = [(r.n, r.query, r.parses, r.runs, r.rows, r.error, r.binds) for r in check(spark, document, values, seconds)]
    return spark.createDataFrame(rows, SCHEMA)


def invented(spark: SparkSession, document: str, prefix: str) -> list[str]:
    """Names of tables and views (prefix, underscore, rest) that a document uses, in text or queries, and the catalog doesn't have."""
    real = {t.name.lower() for t in spark.catalog.listTables()}
    used = set(re.findall(rf"\b{re.escape(prefix)}_[A-Za-z]\w*", document))
    return sorted(u for u in used if u.lower() not in real)

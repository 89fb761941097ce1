import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from grapheon.llm import exact
from grapheon.llm.common import spread_join


def plain(rows):
    groups = defaultdict(list)
    for at, (i, t) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]+", "", t or "")].append((-len(t or ""), i is None, i or 0, at))
    out = []
    for t, members in groups.items():
        members.sort()
        keep = None if members[0][1] else members[0][2]
        for m in members:
            out.append((None if m[1] else m[2], keep, len(members), m is members[0], hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def rows():
    out = [(i, f"text number {i % 97}" + " " * (i % 5)) for i in range(1500)]
    out += [(5000 + i, "hot  copy") for i in range(900)] + [(4000, "hot copy  \n"), (4001, "hot copy  \n")]
    out += [(None, "hot copy"), (None, None), (1, ""), (2, None), (3, " \t\n\x0b\x0c\r"), (7, "same"), (7, "same"), (7, "sa me"), (None, "alone"), (None, "alone"), (-5, "text number 3" + " " * 4), (2**63 - 1, "top"), (-(2**63), "t op"), (2**63 - 2, "bottom")]
    out += [(8, "é👍"), (9, "é 👍"), (10, "é👍"), (11, "nb sp"), (12, "nbsp"), (13, "long " * 200_000), (14, "long" * 200_000)]
    return out


@pytest.mark.parametrize("digest", [exact.sha256, lambda c: F.pmod(F.length(c), F.lit(3)).cast("string").cast("binary"), lambda c: F.lit("x").cast("binary")])
def test_groups_equal_a_plain_loop(spark, digest):
    given = rows() if digest is exact.sha256 else rows()[:700] + rows()[1500:]
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in given], "doc_id long, text string, n_chars int, digest string").repartition(6)
    got = sorted((tuple(r) for r in exact.exact_duplicates(df, digest=digest).collect()), key=str)
    assert got == plain(given)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert exact.exact_duplicates(df).count() == 0


def test_a_salted_join_survives_rows_in_another_order(spark):
    """A part follows from the row: the same rows in another order, as after a lost executor, are dealt alike."""
    rows = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"))
    by = rows.groupBy("key").agg(F.count("*").alias("times")).withColumn("value", F.col("key") * 2)
    found = []
    for order in ("id", F.desc("id")):
        one = rows.coalesce(1).sortWithinPartitions(order)
        joined = spread_join(one, by, "key", "times", 3000, few=10)
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert "monotonically" not in plan
        found.append(sorted(tuple(r) for r in joined.collect()))
    assert found[0] == found[1] and len(found[0]) == 3000 and all(v == 2 * k for k, _, v in found[0])

from pyspark.sql import functions as F

from grapheon.operators import names


def test_no_join_broadcasts_what_is_exploded(spark):
    """The planner sizes exploded grams by their table: 0.1 GB of names was broadcast as grams, more than the driver holds."""
    e = spark.range(300).select(F.concat(F.lit("k"), "id").alias("key"), F.concat(F.lit("Name#"), "id").alias("name"), F.concat(F.lit("NAME#"), "id", F.lit("_X")).alias("display"), F.concat(F.lit("N-"), "id").alias("short_name"), F.lit(1).alias("depth"))
    got = names.resolve_names(e, e.select(F.substring("display", 2, 100).alias("written")))
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()
    assert {(r.written, r.key, r.rung) for r in got.collect()} == {(f"AME#{i}_X", f"k{i}", 5) for i in range(300)}

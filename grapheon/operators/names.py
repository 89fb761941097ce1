"""Keys, display names and the ladder that resolves a written name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_of(identity: Column) -> Column:
    """A slug of at most 200 characters and ten hex digits of the identity's SHA-1."""
    slug = F.substring(F.trim(F.regexp_replace(identity, r"[^A-Za-z0-9_-]+", "_"), F.lit("_")), 1, 200)
    return F.concat(F.trim(slug, F.lit("_")), F.lit("_"), F.substring(F.sha1(identity), 1, 10))


def display_names(elements: DataFrame, group: str = "module", depth: int = 8) -> DataFrame:
    """elements (key, module, qualified with :: between names) with a display name unique in its group.

    The shortest suffix of the qualified path that no other element of the group has; names that stay contested get a number in key order.
    """
    segments = F.split("qualified", "::")
    out = elements
    for d in range(1, depth + 1):
        suffix = F.concat_ws("_", F.slice(segments, F.greatest(F.size(segments) - d + 1, F.lit(1)), d))
        out = out.withColumn(f"_s{d}", suffix)
    # one explode and one aggregate for all depths: a suffix that one element has comes with its key; groupBy combines before the shuffle
    suffixes = out.select("key", group, F.posexplode(F.array(*(F.col(f"_s{d}") for d in range(1, depth + 1)))).alias("d", "suffix"))
    lone = suffixes.groupBy(group, "d", "suffix").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("key")).filter("n = 1")
    best = lone.groupBy("key").agg(F.min(F.struct("d", "suffix")).alias("x")).select("key", F.col("x.suffix").alias("_lone"))
    full = F.regexp_replace("qualified", "::", "_")
    numbered = F.row_number().over(Window.partitionBy(group, "qualified").orderBy("key"))
    joined = out.join(best, "key", "left").withColumn("_n", numbered)
    return joined.select(*elements.columns, F.coalesce("_lone", F.when(F.col("_n") == 1, full).otherwise(F.concat(full, F.lit("_"), F.col("_n").cast("string")))).alias("display"))


def squashed(c: Column) -> Column:
    return F.replace(F.upper(c), F.lit(" "), F.lit("_"))


def resolve_name(elements: DataFrame, written: str) -> DataFrame:
    """The element that a written name means: exact name, display in capitals, display squashed, short name in any case; else the shortest display that contains it.

    elements: key, name, display, short_name, depth. One scan; the best row is a top-1, never a sort of all.
    """
    w = F.lit(written)
    rung = (
        F.when(F.col("name") == w, 1).when(F.col("display") == F.upper(w), 2).when(F.col("display") == squashed(w), 3)
        .when(F.lower("short_name") == F.lower(w), 4).when(F.upper("display").contains(F.upper(w)), 5)
    )
    ranked = elements.withColumn("rung", rung).filter("rung is not null")
    return ranked.orderBy("rung", F.when(F.col("rung") == 5, F.length("display")).otherwise(0), "depth", "key").limit(1)


def unique_aliases(entities: DataFrame, declarations: DataFrame) -> DataFrame:
    """entity, key: links of names that mean exactly one declaration of the module. entities: entity, module, name; declarations: key, module, name.

    Names are compared by their letters and digits alone, in lower case.
    """
    plain = F.regexp_replace(F.lower("name"), r"[^a-z0-9]", "")
    one = declarations.select("module", plain.alias("alias"), "key").filter("alias <> ''").groupBy("module", "alias").agg(F.min("key").alias("key"), F.max("key").alias("top")).filter("key = top").drop("top")
    return entities.select("entity", "module", plain.alias("alias")).join(one, ["module", "alias"]).select("entity", "key")


#: Lengths of the grams that names are found by: a name's own are of the longest of these that it has.
GRAMS = (1, 2, 3, 8)


def _grams(text: Column, n: int) -> Column:
    """Distinct grams of n characters; none of a shorter text."""
    starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(n))))


def resolve_names(elements: DataFrame, written: DataFrame) -> DataFrame:
    """written, key, rung: what `resolve_name` gives, for each distinct name of `written` that means something; a null name means nothing.

    elements: key, name, display, short_name, depth. The four rungs of equal names are one equi-join. For names that only a longer display contains, there is an index of
    grams: a name of up to three characters is a gram, whose best element the index has; a longer one is tested against the elements with its rarest gram, and no others.
    """
    asked = written.select(F.col("written").cast("string").alias("written")).filter("written is not null").distinct()
    forms = F.array(*(F.struct(F.lit(r).alias("rung"), c.alias("text")) for r, c in enumerate((F.col("written"), F.upper("written"), squashed(F.col("written")), F.lower("written")), 1)))
    own = F.array(*(F.struct(F.lit(r).alias("rung"), c.alias("text")) for r, c in enumerate((F.col("name"), F.col("display"), F.col("display"), F.lower("short_name")), 1)))
    equal = elements.select("key", "depth", F.explode(own).alias("f")).select("key", "depth", "f.*").filter("text is not null").groupBy("rung", "text").agg(F.min(F.struct("depth", "key")).alias("best"))
    # what is exploded is many times its table, which the planner can't see: no join may broadcast it
    wide = lambda df: df.hint("merge")
    direct = asked.select("written", F.explode(forms).alias("f")).select("written", "f.*").join(wide(equal), ["rung", "text"]).groupBy("written").agg(F.min(F.struct("rung", "best")).alias("x"))
    direct = direct.select("written", F.col("x.best.key").alias("key"), F.col("x.rung").alias("rung"))

    rest = asked.join(wide(direct), "written", "left_anti").select("written", F.upper("written").alias("w"))
    order = F.struct(F.length("display").alias("length"), "depth", "key")
    shown = elements.filter("display is not null").select(F.upper("display").alias("u"), order.alias("order"))
    index = lambda *lengths: shown.select("u", "order", F.explode(F.concat(*(_grams(F.col("u"), n) for n in lengths))).alias("gram"))
    best = index(*GRAMS).groupBy("gram").agg(F.count(F.lit(1)).alias("times"), F.min("order").alias("order"))
    short = rest.filter(F.length("w").between(1, 3)).join(wide(best), rest["w"] == best["gram"]).select("written", "order")
    blank = rest.filter("w = ''").crossJoin(F.broadcast(shown.agg(F.min("order").alias("order"))))  # one row
    longer = rest.filter(F.length("w") > 3).withColumn("grams", F.when(F.length("w") >= 8, _grams(F.col("w"), 8)).otherwise(_grams(F.col("w"), 3)))
    held = wide(longer.select("written", "w", F.size("grams").alias("n"), F.explode("grams").alias("gram"))).join(wide(best.select("gram", "times")), "gram")
    rarest = held.groupBy("written", "w", "n").agg(F.count(F.lit(1)).alias("found"), F.min(F.struct("times", "gram")).alias("x")).filter("found = n").select("written", "w", F.col("x.gram").alias("gram"))
    # only grams of the lengths that longer names are found by
    tested = wide(rarest).join(wide(index(*GRAMS[2:])), "gram").filter(F.contains("u", F.col("w"))).groupBy("written").agg(F.min("order").alias("order"))
    inside = short.unionByName(blank.filter("order is not null").select("written", "order")).unionByName(tested)
    return direct.unionByName(inside.select("written", F.col("order.key").alias("key"), F.lit(5).alias("rung")))

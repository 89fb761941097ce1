"""The ownership forest as ranges of numbers, so that everything below an element is a range.

`intervals` numbers the forest in pre-order: an element's subtree is `pre` to `post`, so its size is a difference, and a total below it is a difference of two
prefix sums. `covering` finds the ranges that hold given numbers by equi-joins on canonical tiles. `reach` walks from range to range over the edges that aren't
ownership, and never has a row for each element below a root.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grapheon.operators.traverse import walk
from grapheon.plans.lineage import cut

#: Parts of the children of one owner; numbers in a tile of the next level; numbers of a part of prefix sums.
PARTS, BASE, WIDTH = 32, 32, 1 << 16
#: Ranges that are broadcast: a few kilobytes.
FEW = 256
MONEY = "decimal(18,2)"


def _before(rows: DataFrame, by: str, order: str, size: str) -> DataFrame:
    """rows with `before`: the sizes of those earlier in their group, whose order is by part and then by `order`. A group of any size is spread over its parts."""
    part = rows.withColumn("_part", F.pmod(F.xxhash64(order), F.lit(PARTS)))
    inner = Window.partitionBy(by, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = part.groupBy(by, "_part").agg(F.sum(size).alias("_held")).withColumn("_base", F.coalesce(F.sum("_held").over(outer), F.lit(0))).drop("_held")
    within = part.withColumn("_in", F.coalesce(F.sum(size).over(inner), F.lit(0)))
    return within.join(held, [by, "_part"]).withColumn("before", F.col("_base") + F.col("_in")).drop("_part", "_base", "_in")


def intervals(elements: DataFrame, most: int = 64) -> DataFrame:
    """key, depth, pre, post. elements: key (each once), owner (null, or of no element: a root).

    Only elements that own something are taken level by level: one round a level to find the levels, then sizes from the lowest level up and numbers from the highest
    down. The others are counted, and numbered after their owner's owning children, in one go. Elements whose owners form a circle have no number.
    """
    nodes = cut(elements.select("key", "owner"))
    held = nodes.filter("owner is not null").groupBy(F.col("owner").alias("key")).agg(F.count(F.lit(1)).alias("children"))
    # a root's owner is blank
    known = nodes.join(nodes.select(F.col("key").alias("owner"), F.lit(True).alias("known")), "owner", "left").select("key", F.when(F.col("known"), F.col("owner")).otherwise("").alias("owner"))
    marked = cut(known.join(held, "key", "left"))
    owning, alone = marked.filter("children is not null").select("key", "owner"), marked.filter("children is null").select("key", "owner")
    leaves = alone.groupBy(F.col("owner").alias("key")).agg(F.count(F.lit(1)).alias("leaves"))
    inner = cut(owning.join(leaves, "key", "left").select("key", "owner", F.coalesce("leaves", F.lit(0)).alias("leaves")))
    levels = [inner.filter("owner = ''")]
    while len(levels) <= most:
        below = cut(inner.join(levels[-1].select(F.col("key").alias("owner")), "owner").select("key", "owner", "leaves"))
        if below.isEmpty():
            break
        levels.append(below)
    else:
        raise RuntimeError(f"ownership is deeper than {most}")
    sized = [levels[-1].select("key", "owner", F.lit(0).cast("long").alias("inside"), (1 + F.col("leaves")).alias("size"))]
    for level in reversed(levels[:-1]):
        under = sized[0].groupBy(F.col("owner").alias("key")).agg(F.sum("size").alias("under"))
        sized.insert(0, cut(level.join(under, "key", "left").withColumn("inside", F.coalesce("under", F.lit(0))).select("key", "owner", "inside", (1 + F.col("inside") + F.col("leaves")).alias("size"))))
    numbered = []
    for depth, level in enumerate(sized):
        placed = _before(level, "owner", "key", "size")
        if depth:
            placed = placed.join(numbered[-1].select(F.col("key").alias("owner"), (F.col("pre") + 1).alias("_first")), "owner").withColumn("before", F.col("_first") + F.col("before"))
        placed = placed.select("key", F.lit(depth).alias("depth"), F.col("before").alias("pre"), (F.col("before") + F.col("size") - 1).alias("post"), "inside")
        numbered.append(cut(placed) if depth % 4 == 3 else placed)
    owners = cut(reduce(DataFrame.unionByName, numbered))
    rooted = owners.filter("depth = 0").agg(F.coalesce(F.max("post") + 1, F.lit(0)).alias("_first")).select(F.lit("").alias("owner"), F.lit(-1).alias("depth"), "_first")
    first = owners.select(F.col("key").alias("owner"), "depth", (F.col("pre") + 1 + F.col("inside")).alias("_first")).unionByName(rooted)
    last = _before(alone.withColumn("size", F.lit(1).cast("long")), "owner", "key", "size").join(first, "owner")
    ends = last.select("key", (F.col("depth") + 1).alias("depth"), (F.col("_first") + F.col("before")).alias("pre"))
    return cut(owners.drop("inside").unionByName(ends.withColumn("post", F.col("pre"))))


def _levels(top: int) -> int:
    """Levels of tiles for numbers up to top."""
    n = 1
    while BASE**n <= top:
        n += 1
    return n


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def _tiles(pre: Column, post: Column, levels: int) -> Column:
    """The fewest tiles that make up a range: at each level those that no tile of the next holds, at most 2 * BASE."""
    out = []
    for level in range(levels):
        size = BASE**level
        low, high = _div(pre + size - 1, size), _div(post + 1, size)  # tiles low to high - 1 lie inside
        if level == levels - 1:
            spans = [(low, high)]
        else:
            first = F.least(_div(low + BASE - 1, BASE) * BASE, high)
            spans = [(low, first), (F.greatest(_div(high, BASE) * BASE, first), high)]
        for a, b in spans:
            numbers = F.when(a < b, F.sequence(a, b - 1)).otherwise(F.array().cast("array<bigint>"))
            out.append(F.arrays_zip(F.transform(numbers, lambda t: F.lit(level)).alias("level"), numbers.alias("tile")))
    return F.concat(*out)


def covering(points: DataFrame, ranges: DataFrame, top: int, few: int = FEW) -> DataFrame:
    """entry, node: each range with the points that it holds, once. points: node, pre; ranges: entry, pre, post; top: the largest number.

    A range of one number is an equi-join. Up to `few` wider ranges, which are counted, are broadcast; more of them are joined by tiles.
    """
    one, wide = ranges.filter("pre = post"), ranges.filter("pre < post")
    single = one.select("entry", "pre").join(points, "pre").select("entry", "node")
    if wide.count() <= few:
        inside = points.join(F.broadcast(wide.select("entry", F.col("pre").alias("_a"), F.col("post").alias("_b"))), F.col("pre").between(F.col("_a"), F.col("_b")))
        return single.unionByName(inside.select("entry", "node"))
    levels = _levels(top)
    at = points.select("node", F.explode(F.array(*(F.struct(F.lit(n).alias("level"), _div(F.col("pre"), BASE**n).alias("tile")) for n in range(levels)))).alias("t"))
    held = wide.select("entry", F.explode(_tiles(F.col("pre"), F.col("post"), levels)).alias("t"))
    return single.unionByName(held.select("entry", "t.level", "t.tile").join(at.select("node", "t.level", "t.tile"), ["level", "tile"]).select("entry", "node"))


def below(ranges: DataFrame, numbered: DataFrame, values: DataFrame) -> DataFrame:
    """entry, unit, total, n: the values in each range, by unit, as differences of prefix sums. ranges: entry, pre, post; values: key, unit, num.

    Numbers are dense, so a part of WIDTH of them has so many rows at most; the sums of parts are short.
    """
    unit = F.coalesce(F.concat(F.lit("u"), "unit"), F.lit(""))  # a null unit is one of its own
    given = values.select("key", unit.alias("unit"), F.col("num").cast(MONEY).alias("num"))
    # a range of one number is its element
    single = ranges.filter("pre = post").select("entry").join(given.withColumnRenamed("key", "entry"), "entry").groupBy("entry", "unit").agg(F.sum("num").alias("total"), F.count(F.lit(1)).alias("n"))
    ranges = ranges.filter("pre < post")
    rows = cut(given.join(numbered.select("key", "pre"), "key").select("unit", "pre", "num", F.lit(1).cast("long").alias("n")))
    units = F.broadcast(rows.agg(F.collect_set("unit").alias("units")))  # one row: the vocabulary of units
    edges = ranges.select("entry", F.explode(F.array(F.struct((F.col("pre") - 1).alias("at"), F.lit(-1).alias("sign")), F.struct(F.col("post").alias("at"), F.lit(1).alias("sign")))).alias("e"))
    asked = edges.select("entry", "e.at", "e.sign").filter("at >= 0").crossJoin(units).withColumn("unit", F.explode("units")).drop("units")
    part = lambda c: _div(F.col(c), WIDTH)
    both = rows.select("unit", part("pre").alias("part"), F.col("pre").alias("at"), F.lit(0).alias("later"), "num", "n", F.lit(None).cast(ranges.schema["entry"].dataType).alias("entry"), F.lit(None).cast("int").alias("sign"))
    both = both.unionByName(asked.select("unit", part("at").alias("part"), "at", F.lit(1).alias("later"), F.lit(0).cast(MONEY).alias("num"), F.lit(0).cast("long").alias("n"), "entry", "sign"))
    running = Window.partitionBy("unit", "part").orderBy("at", "later").rowsBetween(Window.unboundedPreceding, 0)
    sums = both.withColumns({"total": F.sum("num").over(running), "count": F.sum("n").over(running)}).filter("later = 1")
    held = rows.groupBy("unit", part("pre").alias("part")).agg(F.sum("num").alias("total"), F.sum("n").alias("count"))
    # every part that is asked for, also those without values
    parts = held.unionByName(asked.select("unit", part("at").alias("part"), F.lit(0).cast("decimal(28,2)").alias("total"), F.lit(0).cast("long").alias("count")).distinct())
    earlier = Window.partitionBy("unit").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.groupBy("unit", "part").agg(F.sum("total").alias("t"), F.sum("count").alias("c")).select("unit", "part", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("base_total"), F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("base_count"))
    whole = sums.join(base, ["unit", "part"]).select("entry", "unit", ((F.col("total") + F.col("base_total")) * F.col("sign")).alias("t"), ((F.col("count") + F.col("base_count")) * F.col("sign")).alias("c"))
    found = whole.groupBy("entry", "unit").agg(F.sum("t").alias("total"), F.sum("c").alias("n")).filter("n > 0").unionByName(single)
    return found.select("entry", F.when(F.col("unit") != "", F.expr("substring(unit, 2)")).alias("unit"), "total", "n")


def reach(roots: DataFrame, numbered: DataFrame, cross: DataFrame, most: int = 64) -> DataFrame:
    """root, entry, pre, post: ranges that together are what each root reaches over ownership and the edges `cross` (src, dst); they don't overlap.

    A root, and each target of a cross edge, is an entry. An entry leads to the targets of the edges that leave its range; the walk is over these. An entry that
    lies inside another of the same root adds nothing, and goes. An end that is no element is an entry of its own, numbered -1.
    """
    top = numbered.agg(F.coalesce(F.max("post"), F.lit(0))).head()[0]
    edges = cut(cross.select("src", "dst"))  # repeats do no harm
    named = roots.select(F.col("root").alias("entry")).unionByName(edges.select(F.col("dst").alias("entry"))).distinct()
    none = F.lit(-1).cast("long")
    entries = cut(named.join(numbered.select(F.col("key").alias("entry"), "pre", "post"), "entry", "left").select("entry", F.coalesce("pre", none).alias("pre"), F.coalesce("post", none).alias("post")))
    inner, outer = entries.filter("pre >= 0"), entries.filter("pre < 0")
    leaving = edges.select(F.col("src").alias("node")).distinct().join(numbered.select(F.col("key").alias("node"), "pre"), "node")
    steps = covering(leaving, inner, top).join(edges.withColumnRenamed("src", "node"), "node").select(F.col("entry").alias("src"), "dst")
    direct = edges.join(outer.select(F.col("entry").alias("src")), "src")
    reached = walk(roots, steps.unionByName(direct), most).select("root", F.col("node").alias("entry"))
    inside = covering(inner.select(F.col("entry").alias("node"), "pre"), inner.filter("post > pre"), top).filter("entry <> node")
    nested = reached.join(inside, "entry").select("root", F.col("node").alias("entry"))
    return reached.join(nested, ["root", "entry"], "left_anti").join(entries, "entry").select("root", "entry", "pre", "post")

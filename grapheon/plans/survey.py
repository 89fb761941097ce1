"""The survey: canned questions that show what a model graph holds, each a DataFrame, and all of them as text.

Each probe is one aggregate or a top-k over the graph; none collects rows. `survey` renders what a probe shows first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grapheon.functions import scalar
from grapheon.operators import traverse
from grapheon.sources.files import rendered

#: Rows that a sample shows.
SHOWN = 10


@dataclass
class Model:
    """elements: key, module, kind, is_definition, name, short_name, display, owner, multiplicity, modifiers, expression, refs, attributes (name to num, unit, expression).
    edges: src, dst, label, trigger, guard, through. sources: path, module, lines, characters. entities: key, type, element (null where it is linked with none);
    inferred: src, dst, type. labels: label, all that the vocabulary has.
    """

    elements: DataFrame
    edges: DataFrame
    sources: DataFrame
    entities: DataFrame
    inferred: DataFrame
    labels: DataFrame


def _n(*by: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def _attributes(m: Model) -> DataFrame:
    """key, attribute, num, unit, expression: one row for each attribute of each element."""
    return m.elements.select("key", F.explode("attributes").alias("attribute", "v")).select("key", "attribute", "v.*")


def sizes(m: Model) -> DataFrame:
    out = None
    for name in ("elements", "edges", "sources", "entities", "inferred"):
        part = getattr(m, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("collection"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def modules(m: Model) -> DataFrame:
    """Elements of each module, and relations that start in it."""
    of = m.elements.select(F.col("key").alias("src"), "module")
    held = m.edges.join(of, "src").groupBy("module").agg(F.count(F.lit(1)).alias("relations"))
    return m.elements.groupBy("module").agg(F.count(F.lit(1)).alias("elements")).join(held, "module", "left").select("module", "elements", F.coalesce("relations", F.lit(0)).alias("relations"))


def kinds(m: Model) -> DataFrame:
    return m.elements.groupBy("kind").agg(F.count_if("is_definition").alias("definitions"), F.count_if(~F.col("is_definition")).alias("usages"))


def attributes(m: Model) -> DataFrame:
    """Of each attribute name: how many, how many numbers, its units, and the example of the smallest key."""
    return _attributes(m).groupBy("attribute").agg(
        F.count(F.lit(1)).alias("n"), F.count("num").alias("numeric"), F.array_join(scalar.unique_sorted(F.collect_set("unit")), ",").alias("units"), F.min_by("num", "key").alias("example")
    )


def formulas(m: Model) -> DataFrame:
    return _attributes(m).filter("expression is not null").select("key", "attribute", "expression")


def labels(m: Model) -> DataFrame:
    return _n("label")(m.edges)


def empty_labels(m: Model) -> DataFrame:
    return m.labels.join(m.edges.select("label").distinct(), "label", "left_anti")


def _disambiguated(m: Model) -> DataFrame:
    return m.elements.filter(F.col("name").isNotNull() & ~F.col("display").eqNullSafe(F.col("name")))


def disambiguated(m: Model) -> DataFrame:
    return _disambiguated(m).agg(F.count(F.lit(1)).alias("n"))


def disambiguated_sample(m: Model) -> DataFrame:
    return _disambiguated(m).orderBy("key").limit(SHOWN).select("key", "name", "display")


def short_names(m: Model) -> DataFrame:
    return m.elements.filter("short_name is not null").orderBy("short_name", "key").limit(SHOWN).select("short_name", "key")


def roots(m: Model) -> DataFrame:
    """Elements that own most, at any depth: a walk within the collection of elements, all edges but those that leave it."""
    inside = within(m.edges, m.elements).filter("label = 'owns'")
    top = m.elements.filter("owner is null and kind = 'package'").select(F.col("key").alias("root"))
    return traverse.subtree_sizes(top, inside).orderBy(F.desc("size"), "root").limit(SHOWN)


def within(edges: DataFrame, elements: DataFrame) -> DataFrame:
    """Edges whose both ends are in the collection: what a walk that stays in it may cross."""
    return edges.join(elements.select(F.col("key").alias("src")), "src", "left_semi").join(elements.select(F.col("key").alias("dst")), "dst", "left_semi").select(*edges.columns)


def most_numeric(m: Model) -> DataFrame:
    return _attributes(m).filter("num is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "key").limit(SHOWN)


def constraints(m: Model) -> DataFrame:
    """Constraints, with the bound that their expression ends with."""
    bound = F.try_to_number(F.regexp_extract("expression", r"[<>]=?\s*([0-9]+(?:\.[0-9]+)?)\s*$", 1), F.lit("999999999999.999999")).cast("double")
    return m.elements.filter("kind = 'constraint' and expression is not null").select("key", "expression", bound.alias("bound"))


def multiplicities(m: Model) -> DataFrame:
    return _n("multiplicity")(m.elements.filter("multiplicity is not null"))


def modifiers(m: Model) -> DataFrame:
    return _n("modifier")(m.elements.select(F.explode("modifiers").alias("modifier")))


def triggered(m: Model) -> DataFrame:
    return m.edges.filter("label = 'transitionsTo' and trigger is not null").select("src", "dst", "trigger", "guard")


def connections(m: Model) -> DataFrame:
    return m.edges.filter("label = 'connectedTo'").select("src", "dst", "through")


def coverage(m: Model) -> DataFrame:
    """Requirements: all, definitions, satisfied, verified, and neither."""
    hit = m.edges.filter(F.col("label").isin("satisfies", "verifies")).groupBy(F.col("dst").alias("key")).agg(F.max((F.col("label") == "satisfies").cast("int")).alias("s"), F.max((F.col("label") == "verifies").cast("int")).alias("v"))
    return m.elements.filter("kind = 'requirement'").join(hit, "key", "left").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_definition").alias("definitions"), F.count_if(F.col("s") == 1).alias("satisfied"), F.count_if(F.col("v") == 1).alias("verified"), F.count_if(F.col("s").isNull()).alias("open")
    )


def one_element(m: Model) -> DataFrame:
    """An element as stored, without what only machines read."""
    return m.elements.orderBy("key").limit(1).drop("refs", "attributes", "modifiers", "expression")


def one_edge(m: Model) -> DataFrame:
    return m.edges.orderBy("label", "src", "dst").limit(1).drop("trigger", "guard")


def external(m: Model) -> DataFrame:
    """First names of references that no module declares: written references and the expression's, put together, split at `::`."""
    named = m.elements.filter("name is not null").select(F.col("name").alias("namespace")).distinct()
    written = F.concat("refs", F.coalesce(F.regexp_extract_all("expression", F.lit(r"([A-Za-z_]\w*::\w+)"), F.lit(1)), F.array().cast("array<string>")))
    heads = m.elements.select(F.explode(written).alias("r")).select(F.split("r", "::")[0].alias("namespace"))
    return _n("namespace")(heads.join(named, "namespace", "left_anti"))


def inferred_types(m: Model) -> DataFrame:
    return _n("type")(m.entities).select(F.lit("entity").alias("what"), "type", "n").unionByName(_n("type")(m.inferred).select(F.lit("relationship").alias("what"), "type", "n"))


def link_coverage(m: Model) -> DataFrame:
    return m.entities.agg(F.count(F.lit(1)).alias("entities"), F.count("element").alias("linked"), F.count_distinct("element").alias("elements"))


def layers(m: Model) -> DataFrame:
    return m.sources.groupBy("module").agg(F.count(F.lit(1)).alias("files"), F.sum("lines").alias("lines"), F.sum("characters").alias("characters"))


PROBES: dict[str, Callable[[Model], DataFrame]] = {
    f.__name__: f
    for f in (
        sizes, modules, kinds, attributes, formulas, labels, empty_labels, disambiguated, disambiguated_sample, short_names, roots, most_numeric, constraints, multiplicities,
        modifiers, triggered, connections, coverage, one_element, one_edge, external, inferred_types, link_coverage, layers,
    )
}


def survey(m: Model, names: Iterable[str] = tuple(PROBES), most: int = 4500) -> dict[str, str]:
    """Each probe's rows as JSON lines of `most` characters at most, cut at a row."""
    out = {}
    for name in names:
        rows = PROBES[name](m)
        out[name] = rendered(rows, most, rows.columns[0])
    return out

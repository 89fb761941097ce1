"""Model files as a property graph: declarations by mapInPandas over files, names and relations by applyInPandas over modules.

A module (a top folder) is the unit within which names mean anything, so it is the unit of resolution: a group is one model's declarations, never data.
A file that can't be read gives one row of kind `error` and stops nothing. A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grapheon.notation.lexer import NotationError
from grapheon.notation.resolve import Module
from grapheon.notation.statements import Declaration, parse
from grapheon.sources.files import module_of

VALUE = "struct<num: double, str: string, bool: boolean, unit: string, text: string, reference: string, expression: string, operator: string, tree: string>"
_PARSED = f"""module string, path string, ord int, owner_ord int, kind string, name string, short_name string, is_definition boolean, line int, column int, modifiers array<string>,
visibility string, direction string, conjugated boolean, relation string, multiplicity struct<text: string, lower: int, upper: int>, value {VALUE}, expression {VALUE}, doc string,
comments array<string>, annotations array<struct<name: string, values: map<string, string>>>, refs array<struct<role: string, parts: array<string>>>, message string"""
_NAMED = "module string, path string, ord int, identity string, owner string, display string, called string, qualified string, depth int, anonymous boolean, children int"
_EDGES = "module string, path string, line int, src string, label string, dst string, written string, external boolean, emitted int, detail map<string, string>"
_KEYS = VALUE[7:-1].replace(":", "").split(", ")
_VALUE_KEYS = [k.split(" ")[0] for k in _KEYS]


def _value(v: dict | None) -> dict | None:
    return None if v is None else {k: v.get(k) for k in _VALUE_KEYS}


def _rows(module: str, path: str, text: str | None) -> Iterator[dict]:
    blank = {c.strip().split(" ")[0]: None for c in ("kind ", "name ", "short_name ", "visibility ", "direction ", "relation ", "multiplicity ", "value ", "expression ", "doc ", "message ")}
    blank |= {"module": module, "path": path, "owner_ord": None, "is_definition": False, "conjugated": False, "modifiers": [], "comments": [], "annotations": [], "refs": []}
    try:
        found = parse(text or "")
    except NotationError as e:
        yield blank | {"ord": 0, "kind": "error", "line": e.line, "column": e.column, "message": e.message}
        return
    count = 0
    stack: list[tuple[Declaration, int | None]] = [(d, None) for d in reversed(found)]
    while stack:
        d, owner = stack.pop()
        yield blank | {
            "ord": count, "owner_ord": owner, "kind": d.kind, "name": d.name, "short_name": d.short_name, "is_definition": d.is_definition, "line": d.line, "column": d.column,
            "modifiers": sorted(d.modifiers), "visibility": d.visibility, "direction": d.direction, "conjugated": d.conjugated, "relation": d.relation, "multiplicity": d.multiplicity,
            "value": _value(d.value), "expression": _value(d.expression), "doc": d.doc, "comments": d.comments, "annotations": d.annotations,
            "refs": [{"role": a, "parts": b} for a, b in d.refs],
        }
        stack.extend((c, count) for c in reversed(d.children))
        count += 1


def declarations(sources: DataFrame) -> DataFrame:
    """One row for each declaration of each file. sources: path, text."""
    columns = [c.strip().split(" ")[0] for c in _depth_split(_PARSED)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for m, p, t in zip(f["module"], f["path"], f["text"], strict=True):
                out = pd.DataFrame(list(_rows(m, p, t)), columns=columns, dtype=object)
                yield out

    given = sources.select(module_of(F.col("path")).alias("module"), "path", F.coalesce("text", F.lit("")).alias("text"))
    return given.mapInPandas(run, _PARSED)


def _depth_split(schema: str) -> list[str]:
    out, depth, held = [], 0, ""
    for c in schema:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(held)
            held = ""
        else:
            held += c
    return [*out, held]


def _module(pdf: pd.DataFrame) -> Module:
    pdf = pdf[pdf["kind"] != "error"].sort_values(["path", "ord"], kind="stable")
    rows = []
    for r in pdf.to_dict("records"):
        owner = None if pd.isna(r["owner_ord"]) else (r["path"], int(r["owner_ord"]))
        refs = [(x["role"], list(x["parts"])) for x in r["refs"]]
        rows.append(r | {"id": (r["path"], int(r["ord"])), "owner": owner, "refs": refs, "annotations": list(r["annotations"]), "modifiers": list(r["modifiers"])})
    return Module(rows[0]["module"] if rows else "", rows)


def elements(parsed: DataFrame) -> DataFrame:
    """Declarations with their names in the module: identity, owner (identity of the encloser), display (unique in the module), called (as it stands in the qualified name), qualified, depth, children."""

    def named(pdf: pd.DataFrame) -> pd.DataFrame:
        m = _module(pdf)
        own = lambda r: m.by_id[r["owner"]]["identity"] if r["owner"] else None
        out = [(m.name, r["path"], r["id"][1], r["identity"], own(r), r["unique"], r["display"], r["qualified"], r["depth"], r["anonymous"], len(m.children.get(r["id"], ()))) for r in m.rows]
        return pd.DataFrame(out, columns=[c.strip().split(" ")[0] for c in _NAMED.split(",")])

    slim = parsed.select("module", "path", "ord", "owner_ord", "kind", "name", "short_name", "line", "modifiers", "annotations", "refs", "is_definition")
    names = slim.groupBy("module").applyInPandas(named, _NAMED)
    rest = parsed.filter("kind <> 'error'").drop("owner_ord", "message")
    slug = F.regexp_replace(F.regexp_replace("identity", "[^A-Za-z0-9_-]+", "_"), "^_+|_+$", "")
    why = F.filter("annotations", lambda a: a["name"] == "Rationale")
    rest = rest.withColumn("rationale", F.try_element_at(F.try_element_at(why, F.lit(1))["values"], F.lit("text")))
    return names.join(rest, ["module", "path", "ord"]).withColumn("key", F.concat(F.substring(slug, 1, 200), F.lit("_"), F.substring(F.sha1(F.col("identity").cast("binary")), 1, 10)))


def relations(parsed: DataFrame) -> DataFrame:
    """Edges of all modules (src, label, dst: identities). Of equal ones the first stays; none joins an element with itself. dst is null where a name means nothing."""

    def derive(pdf: pd.DataFrame) -> pd.DataFrame:
        m, out = _module(pdf), []
        for n, (src, label, dst, text, row, detail) in enumerate(m.relations()):
            external = dst is None and text.replace(".", "::").split("::")[0] not in m.tails
            out.append((m.name, row["path"], row["line"], src["identity"], label, dst["identity"] if dst is not None else None, text, external, n, detail))
        return pd.DataFrame(out, columns=[c.strip().split(" ")[0] for c in _depth_split(_EDGES)])

    found = parsed.drop("doc", "comments", "message").groupBy("module").applyInPandas(derive, _EDGES)
    once = Window.partitionBy("module", "label", "src", "dst", F.when(F.col("dst").isNull(), F.col("written"))).orderBy("emitted")
    return found.filter("dst is null or src <> dst").withColumn("k", F.row_number().over(once)).filter("k = 1").drop("k", "emitted")


def descriptions(found: DataFrame, values: DataFrame | None = None) -> DataFrame:
    """module, identity, description: a sentence for each element that says only what its declaration does; what a search reads. found: of `elements`; values: of `attributes`."""
    has = lambda role: F.filter("refs", lambda r: r["role"] == role)
    listed = lambda role: F.array_join(F.transform(has(role), lambda r: F.array_join(r["parts"], "")), ", ")
    given = lambda c, *parts: F.when(c, F.concat(*parts))
    number = lambda x: F.regexp_replace(x.cast("string"), r"\.0$", "")
    shown = lambda v: F.coalesce(number(v["num"]), v["str"], v["bool"].cast("string"), v["expression"], v["reference"])
    unit = lambda v: F.coalesce(F.concat(F.lit(" "), v["unit"]), F.lit(""))
    if values is None:
        values = attributes(found)
    kept = F.slice(F.map_entries("attributes"), 1, 6)
    own = values.select("module", F.col("owner").alias("identity"), F.array_join(F.transform(kept, lambda e: F.concat(e["key"], F.lit(" = "), shown(e["value"]), unit(e["value"]))), ", ").alias("_members"))
    what = F.concat(F.when(F.array_contains("modifiers", "abstract"), F.lit("abstract ")).otherwise(F.lit("")), "kind", F.when(F.col("is_definition"), F.lit(" definition")).otherwise(F.lit("")))
    parts = F.concat_ws(
        ", ",
        F.concat("display", F.lit(" is a "), what, F.lit(" declared in "), "qualified"),
        given(F.size(has("type")) > 0, F.lit("typed by "), listed("type")),
        given(F.size(has("super")) > 0, F.when(F.col("is_definition"), F.lit("specializing ")).otherwise(F.lit("subsetting ")), listed("super")),
        given(F.size(has("redefines")) > 0, F.lit("redefining "), listed("redefines")),
        given(F.col("multiplicity").isNotNull(), F.lit("with multiplicity ["), F.col("multiplicity")["text"], F.lit("]")),
        given(F.col("value").isNotNull(), F.lit("whose value is "), shown(F.col("value")), unit(F.col("value"))),
        F.col("_members"),
    )
    sentence = F.concat_ws(
        " ",
        F.concat(parts, F.lit(", at "), "path", F.lit(":"), F.col("line").cast("string"), F.lit(".")),
        given(F.col("short_name").isNotNull(), F.lit("Also written "), "short_name", F.lit(".")),
        F.col("doc"),
        given(F.col("rationale").isNotNull(), F.lit("Rationale: "), "rationale"),
    )
    return found.join(own, ["module", "identity"], "left").select("module", "identity", sentence.alias("description"))


def edges(related: DataFrame) -> DataFrame:
    return related.filter("dst is not null")


def unresolved(related: DataFrame) -> DataFrame:
    return related.filter("dst is null").select("module", "path", "line", "src", "label", "written", "external")


def attributes(found: DataFrame) -> DataFrame:
    """owner, attributes: the values of an element's members by name; of equal names the last."""
    keyed = found.filter("owner is not null and value is not null").withColumn("k", F.coalesce("name", "called"))
    last = keyed.groupBy("module", "owner", "k").agg(F.max_by("value", F.struct("path", "ord")).alias("v"))
    return last.groupBy("module", "owner").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "v")))).alias("attributes"))

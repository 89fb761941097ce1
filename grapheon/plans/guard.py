"""Refusing statements that write, and lint of query text. Both look before anything runs."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

WRITES = re.compile(r"\b(insert|update|delete|merge|drop|create|alter|truncate|replace|load|refresh|cache|uncache|set|reset|use|grant|revoke|analyze|msck|repair|call|execute)\b", re.I)
#: Plan nodes that a read-only statement may hold.
COMMAND = re.compile(r"Insert|Create|Drop|Alter|Delete|Update|Merge|Truncate|Command|Set(?:Catalog|Namespace|Table)|Load|Refresh|Cache|Analyze|Repair|Overwrite|Append(?:Data)?$|ReplaceTable|Rename|Call")


def writes(spark: SparkSession, sql: str) -> str | None:
    """Why a statement isn't read-only, or None. The whole parsed tree is looked through; text is checked only where there is no parser."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except AttributeError:
        found = WRITES.search(re.sub(r"'(?:[^']|'')*'", "''", sql))
        return f"it has {found.group(1).upper()}" if found else None
    todo = [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if COMMAND.search(name):
            return f"it has {name}"
        for children in (node.children(), node.innerChildren()):
            it = children.iterator()
            while it.hasNext():
                x = it.next()
                if hasattr(x, "innerChildren"):
                    todo.append(x)
    return None


def read_only(spark: SparkSession, sql: str, args: dict | None = None) -> DataFrame:
    why = writes(spark, sql)
    if why:
        raise PermissionError(f"only queries are run: {why}")
    return spark.sql(sql, args=args) if args else spark.sql(sql)


#: Faults of query text: name, pattern, what to write instead.
FAULTS = (
    ("bind parameter", re.compile(r"(?<![\w:])[:@]\w+"), "put the value into the text"),
    ("aggregate over inferred entities", re.compile(r"\b(sum|avg|count)\s*\([^)]*\).{0,200}\bentities\b", re.I | re.S), "count stated elements"),
    ("substring as scope", re.compile(r"\b(qualified|identity)\s+like\s+'%", re.I), "walk from the element"),
    ("sparse attribute by path", re.compile(r"\battributes\.\w+\.", re.I), "explode attributes and filter by name"),
    ("literal element key", re.compile(r"\bkey\s*=\s*'[^']*_[0-9a-f]{10}'", re.I), "find the element by name"),
    ("attributes of entities", re.compile(r"\bentities?\b.{0,80}\battributes\b", re.I | re.S), "read attributes of elements"),
)


@dataclass(frozen=True)
class Fault:
    name: str
    advice: str


def lint(sql: str) -> list[Fault]:
    return [Fault(name, advice) for name, pattern, advice in FAULTS if pattern.search(sql)]

"""Scalar functions of the query surface, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def substitute(s: Column, old: str, new: str) -> Column:
    return F.replace(s, F.lit(old), F.lit(new))


def concat(*parts: Column) -> Column:
    """A null part is an empty one."""
    return F.concat_ws("", *parts)


def substring(s: Column, start: int, length: int) -> Column:
    """start counts from 0."""
    return F.substring(s, start + 1, length)


def split_part(s: Column, mark: str, k: int) -> Column:
    return F.get(F.split(s, r"\Q" + mark + r"\E"), F.lit(k))


def key_of_identifier(identifier: Column) -> Column:
    return F.substring_index(identifier, "/", -1)


def unique_sorted(a: Column) -> Column:
    return F.sort_array(F.array_distinct(a))


def is_number(value: Column) -> Column:
    """value: the struct of a value; its num is null unless it was written as a number."""
    return value.getField("num").isNotNull()


def attribute(attributes: Column, name: str) -> Column:
    """Null where the map lacks the name."""
    return F.try_element_at(attributes, F.lit(name))


def lines(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1


def comparable(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), r"[^a-z0-9]", "")


def attributes(m: Column) -> Column:
    """The names that a map or row of attributes has, sorted."""
    return F.sort_array(F.map_keys(m))


def merge(first: Column, second: Column) -> Column:
    """Both maps; where both have a name, the second's value stays."""
    kept = F.map_filter(first, lambda k, _: ~F.map_contains_key(second, k))
    return F.map_concat(kept, second)


def append(a: Column, b: Column, unique: bool = False) -> Column:
    """Arrays end to end; a null one is empty. unique: each value once."""
    empty = F.array()
    out = F.concat(F.coalesce(a, empty), F.coalesce(b, empty))
    return F.array_distinct(out) if unique else out


def same_collection(collection: str, identifier: Column) -> Column:
    """Whether an identifier (`collection/key`) is of this collection."""
    return F.substring_index(identifier, "/", 1) == F.lit(collection)


def expanded(rows: Column, field: str) -> Column:
    """The field of each row of an array."""
    return F.transform(rows, lambda x: x.getField(field))


def is_list(value: Column) -> Column:
    """Whether an array is there at all; an empty one is."""
    return value.isNotNull()

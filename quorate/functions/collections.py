"""Null-safe list and map expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def or_empty(items: Column, kind: str = "string") -> Column:
    return F.coalesce(items, F.array().cast(f"array<{kind}>"))


def list_append(items: Column, value: Column, kind: str = "string") -> Column:
    """Appends also to a null list."""
    return F.array_append(or_empty(items, kind), value)


def list_concat(*lists: Column, kind: str = "string") -> Column:
    """Null lists count as empty; null only if all are."""
    none = reduce(lambda a, b: a & b, [x.isNull() for x in lists])
    return F.when(~none, F.concat(*[or_empty(x, kind) for x in lists]))


def list_distinct(items: Column) -> Column:
    """Distinct non-null values, sorted."""
    return F.array_sort(F.array_distinct(F.array_compact(items)))


def list_contains(items: Column, value) -> Column:
    return F.coalesce(F.array_contains(items, value), F.lit(False))


def list_any_value(items: Column) -> Column:
    """The first non-null value."""
    return F.get(F.array_compact(items), F.lit(0))


def list_unique(items: Column) -> Column:
    """Number of distinct non-null values."""
    return F.size(F.array_distinct(F.array_compact(items)))


def flatten(lists: Column) -> Column:
    """Null sub-lists are skipped."""
    return F.flatten(F.filter(lists, lambda x: x.isNotNull()))


def _counted(items: Column) -> Column:
    """Distinct non-null values as (-count, first index, value), sorted."""
    return bind(
        F.array_compact(items),
        lambda xs: F.array_sort(F.transform(F.array_distinct(xs), lambda v: F.struct((-F.size(F.filter(xs, lambda x: x == v))).alias("n"), F.array_position(xs, v).alias("i"), v.alias("v")))),
    )


def first_mode(items: Column) -> Column:
    """Most frequent non-null value; among equals the one that stands first."""
    return F.get(_counted(items), F.lit(0))["v"]


def ranked_distinct(items: Column, most: int | None = None) -> Column:
    """Distinct values by count, equals in alphabetical order."""
    ranked = F.transform(_counted(F.array_sort(items)), lambda x: x.v)
    return ranked if most is None else F.slice(ranked, 1, most)


def top_n(items: Column, n: int) -> Column:
    return F.slice(items, 1, n)


def ordered_list(value: str, *keys: str) -> Column:
    """Aggregate: values ordered by keys; nulls among them stay."""
    packed = F.struct(*[F.col(k) for k in keys], F.col(value).alias("_value"))
    return F.transform(F.array_sort(F.collect_list(packed)), lambda x: x["_value"])


def any_true(flag: Column) -> Column:
    """Aggregate: whether a flag is true; null counts as false."""
    return F.coalesce(F.bool_or(flag), F.lit(False))


def union_of_lists(items: Column) -> Column:
    """Aggregate: distinct values of all lists, sorted."""
    return list_distinct(F.flatten(F.collect_list(items)))


def key_values(pairs: Column, sep: str = ":") -> tuple[Column, Column]:
    """Key and value of "key:value"; what follows a second separator is cut off."""
    parts = F.split(pairs, f"\\Q{sep}\\E", -1)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def true_wins(flag: Column, other: Column) -> Column:
    """A true flag stays; else the other one."""
    return F.coalesce(F.nullif(flag, F.lit(False)), other)

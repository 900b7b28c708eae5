"""Years from several witnesses, and first events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorate.operators.lookup import pick_one


def reconcile_year(page: Column, item: Column, low: Column, high: Column, now: Column, floor: int = 1600) -> Column:
    """The year that the witnesses allow, by the first rung that holds; else null.

    The page's year if it lies in [floor, now]; the page's, then the item's, in
    the title's range; two-digit years of page, then item, that fit the range's
    centuries in one way only; last the item's year in [floor, now].
    """
    lo, hi = low, high
    century = lambda y: lo + F.pmod(y - lo, F.lit(100))
    inside = lambda y: (y <= now) & y.between(lo, hi)
    alone = lambda y: inside(century(y)) & (century(y) + 100 > hi)
    return (
        F.when(page.between(F.lit(floor), now), page)
        .when(inside(page), page)
        .when(inside(item), item)
        .when(alone(page), century(page))
        .when(alone(item), century(item))
        .when(item.between(F.lit(floor), now), item)
    )


def first_events(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The values of each key's first row by order, from one aggregation and no window."""
    packed = F.min(F.struct(*order, *[v for v in values if v not in order])).alias("_x")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"_x.{v}").alias(v) for v in values])


def earliest(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of each key, numbered from 1."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("n", F.row_number().over(w)).where(F.col("n") <= n)


def claim(candidates: DataFrame, key: str, item: str, first: Column, order: Sequence[Column]) -> DataFrame:
    """(key, item): the preferred category's first item is claimed; other categories take the next one.

    candidates: rows (key, category, item), two or more for each category.
    first: whether a row is of the category that chooses first.
    """
    own = pick_one(candidates.where(first), [key], order).select(key, F.col(item).alias("_taken"))
    rest = candidates.where(~first).join(own, key, "left").where(~F.col(item).eqNullSafe(F.col("_taken")))
    best = pick_one(rest, [key, "category"], order).select(key, "category", item)
    return best.unionByName(pick_one(candidates.where(first), [key], order).select(key, "category", item))

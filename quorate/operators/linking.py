"""Backbone accretion and linkage across sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorate.operators.lookup import pick_one, unseen, update_from


def accrete(seed: DataFrame, sources: Sequence[tuple[DataFrame, Sequence[str], str | None]], order: Sequence[Column] = ()) -> DataFrame:
    """Adds the rows of each source, in turn, that share none of its keys with what is there.

    sources: (rows with the seed's columns, keys, join key for a fill or
    None). After each source its ids fill the nulls of rows with that key.
    """
    out = seed
    for rows, keys, by in sources:
        new = unseen(rows, out, keys)
        if by is not None:
            out = update_from(out, rows, by, [k for k in keys if k != by], order, fill_only=True)
        out = out.unionByName(new, allowMissingColumns=True)
    return out


def concept_order(status: Column, backlinks: Column, support: Sequence[Column], key: Column) -> list[Column]:
    """Accepted before synonym before others, then backlinks, then how many sources know the name, then the id."""
    weight = F.when(status == "accepted", 0).when(status == "synonym", 1).otherwise(2)
    known = sum((F.coalesce(s, F.lit(False)).cast("int") for s in support), F.lit(0))
    return [weight, backlinks.desc_nulls_last(), known.desc(), key.asc()]


def link_by_keys(target: DataFrame, reference: DataFrame, keys: Sequence[str], name: str, popularity: str, ref_id: str, key: str = "id") -> DataFrame:
    """Adds ref_id by the first key that finds one: same name first, then popularity, then id."""
    out = target.withColumn(ref_id, F.lit(None).cast(dict(reference.dtypes)[ref_id]))
    ref = reference.select(F.col(ref_id).alias("_ref"), F.col(name).alias("_name"), F.col(popularity).alias("_pop"), *keys)
    for k in keys:
        found = out.where(F.col(ref_id).isNull() & F.col(k).isNotNull()).select(key, k, name).join(ref.where(F.col(k).isNotNull()).select(k, "_ref", "_name", "_pop"), k)
        order = [(~F.col(name).eqNullSafe(F.col("_name"))).cast("int"), F.col("_pop").desc_nulls_last(), F.col("_ref")]
        best = pick_one(found, [key], order).select(key, "_ref")
        out = out.join(best, key, "left").withColumn(ref_id, F.coalesce(ref_id, "_ref")).drop("_ref")
    return out.select(*target.columns, ref_id)


def link_by_name(target: DataFrame, reference: DataFrame, name: str, popularity: str, ref_id: str, key: str = "id") -> DataFrame:
    """Fills ref_id of unlinked rows by equal name from reference rows that nothing uses yet."""
    used = target.where(F.col(ref_id).isNotNull()).select(ref_id).distinct()
    free = reference.join(used, ref_id, "left_anti").select(F.col(ref_id).alias("_ref"), name, F.col(popularity).alias("_pop"))
    order = [F.col("_pop").desc_nulls_last(), F.col("_ref")]
    found = target.where(F.col(ref_id).isNull()).select(key, name).join(pick_one(free.where("_ref IS NOT NULL"), [name], order), name)
    best = pick_one(found, [key], order).select(key, "_ref")
    return target.join(best, key, "left").withColumn(ref_id, F.coalesce(ref_id, "_ref")).drop("_ref").select(*target.columns)


def supplement_ids(target: DataFrame, reference: DataFrame, ref_id: str, columns: Sequence[str]) -> DataFrame:
    """Fills several ids at once from the linked reference row."""
    return update_from(target, reference, ref_id, columns, [F.col(c).asc_nulls_last() for c in columns], fill_only=True)


def fill_one_to_one(target: DataFrame, source: DataFrame, name: str, source_id: str, order: Sequence[Column], key: str = "id") -> DataFrame:
    """The best free source row of each name goes to the first unlinked target row of that name."""
    used = target.where(F.col(source_id).isNotNull()).select(source_id).distinct()
    best = pick_one(source.join(used, source_id, "left_anti"), [name], order).select(name, F.col(source_id).alias("_sid"))
    first = pick_one(target.where(F.col(source_id).isNull()), [name], [F.col(key)]).select(key, name)
    moves = first.join(best, name).select(key, "_sid")
    return target.join(moves, key, "left").withColumn(source_id, F.coalesce(source_id, "_sid")).drop("_sid").select(*target.columns)


def backlinks(df: DataFrame, pointer: str, key: str) -> DataFrame:
    """Adds how many rows point at each row (0 if none)."""
    n = df.where(F.col(pointer).isNotNull()).groupBy(F.col(pointer).alias("_p")).agg(F.count("*").alias("backlinks"))
    return df.join(n, F.col(key) == F.col("_p"), "left").drop("_p").withColumn("backlinks", F.coalesce("backlinks", F.lit(0)))


def unique_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose values in columns (null equals null) no other row has."""
    return df.withColumn("_n", F.count("*").over(Window.partitionBy(*columns))).where("_n = 1").drop("_n")

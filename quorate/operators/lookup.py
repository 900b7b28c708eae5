"""Ranked lookups, fills, upserts and anti joins on several keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key; rows with a null key are left out."""
    w = Window.partitionBy(*keys).orderBy(*order)
    kept = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    return kept.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def update_from(target: DataFrame, source: DataFrame, key: str, columns: Sequence[str], order: Sequence[Column] = (), fill_only: bool = False) -> DataFrame:
    """Takes columns from the source row with the same key: all of them, or only where target has null.

    Of several source rows the first by order counts. Rows without a match stay.
    """
    own = pick_one(source.select(key, *columns, *[c for c in source.columns if c not in {key, *columns}]), [key], order or [F.col(c) for c in columns])
    found = own.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in columns])
    joined = target.join(found, key, "left")

    def value(c: str) -> Column:
        old = F.col(c) if c in target.columns else F.lit(None)
        return F.coalesce(old, F.col(f"_{c}")) if fill_only else F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(old)

    return joined.withColumns({c: value(c) for c in columns}).select(*dict.fromkeys([*target.columns, *columns]))


def unseen(new: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of new that share none of the keys with seen; null keys never match.

    One hash join for each key: a join on any of them would compare all pairs.
    """
    for k in keys:
        new = new.join(seen.where(F.col(k).isNotNull()).select(k).distinct(), k, "left_anti").select(*new.columns)
    return new


def upsert(existing: DataFrame, delta: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The newest delta row of each key in place of the existing one, and the rest."""
    newest = pick_one(delta, [key], order)
    return existing.join(newest.select(key), key, "left_anti").select(*existing.columns).unionByName(newest, allowMissingColumns=True)


def ambiguous_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys of a lookup that would fan out in a join."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(df: DataFrame, key: str, shown: int = 5) -> DataFrame:
    """df itself; fails, naming the first `shown` keys, where a key would fan out in a join. Null keys join nothing."""
    many = ambiguous_keys(df.where(F.col(key).isNotNull()), key).orderBy(key).limit(shown).collect()  # shown rows at most
    if many:
        raise ValueError(f"{key} is not unique: " + ", ".join(f"{r[0]} ({r.n} rows)" for r in many))
    return df


def changed_rows(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> int:
    """How many keys have another value in one of the columns; keys of one side only do not count."""
    new = after.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)])
    same = [F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(columns)]
    return before.select(key, *[c for c in columns if c != key]).join(new, F.col(key) == F.col("_k")).where(~reduce(and_, same, F.lit(True))).select("_k").distinct().count()


def redirect(df: DataFrame, column: str, history: DataFrame, current: str, former: str) -> DataFrame:
    """Replaces obsolete ids by current ones; history lists former ids for each current one.

    The list is exploded first, so the join is on equality.
    """
    pairs = history.select(F.explode(former).alias("_old"), F.col(current).alias("_new"))
    one = pick_one(pairs, ["_old"], [F.col("_new").asc()])
    return df.join(one, F.col(column) == F.col("_old"), "left").withColumn(column, F.coalesce("_new", column)).drop("_old", "_new")


def keep_known(df: DataFrame, column: str, known: DataFrame, key: str) -> DataFrame:
    """Sets ids to null that the source does not have."""
    have = known.select(F.col(key).alias("_k")).distinct()
    return df.join(have, F.col(column) == F.col("_k"), "left").withColumn(column, F.when(F.col("_k").isNotNull(), F.col(column))).drop("_k")


def prefer_accepted(df: DataFrame, column: str, source: DataFrame, key: str, name: str, accepted: str) -> DataFrame:
    """Ids of rows that are not accepted become the least accepted id of the same name."""
    old = source.where(~F.coalesce(F.col(accepted), F.lit(False))).select(F.col(key).alias("_k"), F.col(name).alias("_name"))
    best = source.where(accepted).groupBy(F.col(name).alias("_name")).agg(F.min(key).alias("_best"))
    moves = pick_one(old.join(best, "_name"), ["_k"], [F.col("_best")]).select("_k", "_best")
    return df.join(moves, F.col(column) == F.col("_k"), "left").withColumn(column, F.coalesce("_best", column)).drop("_k", "_best")


def refresh_queue(df: DataFrame, key: str, checked: str, now: Column, days: int = 14, most: int = 20_000, seed: int | None = None) -> DataFrame:
    """Rows with a key whose last check is missing or older than `days`, oldest first.

    The first `most` are the queue. Ties are spread at random with a seed, else ordered by key.
    """
    due = df.where(F.col(key).isNotNull()).where(F.col(checked).isNull() | (F.col(checked) < now - F.expr(f"INTERVAL {days} DAYS")))
    return due.orderBy(F.col(checked).asc_nulls_first(), F.rand(seed) if seed is not None else F.col(key)).limit(most)


def prefix_parent(children: DataFrame, parents: DataFrame, group: str, path: str, key: str) -> DataFrame:
    """(key, parent) where parent has the longest path in the group that starts the child's path.

    Each child is joined by its path's proper prefixes, so rows grow with the
    length of paths and not with the rows of a group.
    """
    p = parents.where(F.col(path).isNotNull()).groupBy(F.col(group).alias("_g"), F.col(path).alias("_path")).agg(F.min(key).alias("parent"))
    cuts = children.where(F.length(path) > 0).select(key, F.col(group).alias("_g"), F.col(path).alias("_own"), F.explode(F.sequence(F.lit(0), F.length(path) - 1)).alias("_n"))
    found = cuts.select(key, "_g", "_n", F.expr("left(_own, _n)").alias("_path")).join(p, ["_g", "_path"])
    return found.groupBy(key).agg(F.min_by("parent", F.struct(-F.col("_n"), F.col("parent"))).alias("parent"))


def area_candidates(df: DataFrame, column: str) -> DataFrame:
    """Five readings of a free-text area: as it is, without parentheses, before a semicolon, each comma part, the last one."""
    raw = F.col(column)
    own = df.where(raw.isNotNull() & (F.trim(raw) != "")).select(raw.alias("area_raw")).distinct()
    a = F.col("area_raw")
    parts = [
        own.select(a, a.alias("candidate"), F.lit(0).alias("pass")),
        own.select(a, F.trim(F.regexp_replace(a, r"\([^)]*\)", "")).alias("candidate"), F.lit(1).alias("pass")),
        own.where(a.contains(";")).select(a, F.trim(F.split_part(a, F.lit(";"), F.lit(1))).alias("candidate"), F.lit(2).alias("pass")),
        own.select(a, F.explode(F.split(a, ",", -1)).alias("candidate"), F.lit(3).alias("pass")).withColumn("candidate", F.trim("candidate")),
        own.where(a.contains(",")).select(a, F.trim(F.regexp_extract(a, r"([^,]+)$", 1)).alias("candidate"), F.lit(4).alias("pass")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("candidate <> ''")


def match_areas(df: DataFrame, column: str, names: DataFrame, name: str, code: str) -> DataFrame:
    """(area_raw, code): the first reading that the names know, longest first; else a bare two-letter code."""
    from quorate.functions.text import area_name

    look = names.select(area_name(F.col(name)).alias("_n"), F.col(code).alias("code"))
    found = area_candidates(df, column).withColumn("_n", area_name(F.col("candidate"))).join(look, "_n")
    best = pick_one(found, ["area_raw"], [F.col("pass"), F.length("candidate").desc(), F.col("code")]).select("area_raw", "code")
    iso = df.select(F.col(column).alias("area_raw")).distinct().where(F.trim("area_raw").rlike("^[A-Za-z]{2}$"))
    return best.unionByName(iso.join(best, "area_raw", "left_anti").select("area_raw", F.lower(F.trim("area_raw")).alias("code")))


def resolve_synonyms(df: DataFrame, column: str, synonyms: DataFrame, synonym: str, accepted: str, out: str) -> DataFrame:
    """Adds the least accepted key of each synonym; keys that are no synonym stay, and so does the raw column."""
    one = synonyms.where(F.col(synonym).isNotNull()).groupBy(F.col(synonym).alias("_s")).agg(F.min(accepted).alias("_to"))
    return df.join(one, F.col(column) == F.col("_s"), "left").withColumn(out, F.coalesce("_to", column)).drop("_s", "_to")

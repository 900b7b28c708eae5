"""Hierarchies given by parent pointers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorate.functions.collections import union_of_lists
from quorate.functions.text import rank_order
from quorate.operators.lookup import pick_one
from quorate.session import cut


def closure(edges: DataFrame, child: str, parent: str, levels: int = 20) -> DataFrame:
    """(child, ancestor, level), the fewest steps; a cycle ends there, self edges are left out.

    Fails where paths are longer than `levels`.
    """
    e = cut(edges.where(F.col(child).isNotNull() & F.col(parent).isNotNull() & (F.col(child) != F.col(parent))).select(F.col(child).alias("child"), F.col(parent).alias("up")).distinct())
    front = e.select("child", F.col("up").alias("ancestor"), F.lit(1).alias("level"))
    out = front
    up = e.select(F.col("child").alias("ancestor"), F.col("up").alias("next"))
    for level in range(2, levels + 1):
        step = front.join(up, "ancestor").where("next <> child").select("child", F.col("next").alias("ancestor"), F.lit(level).alias("level")).distinct()
        front = cut(step.join(out, ["child", "ancestor"], "left_anti"))
        if front.isEmpty():
            break
        out = out.unionByName(front)
    else:
        if not front.join(up, "ancestor").where("next <> child").select("child", F.col("next").alias("ancestor")).join(out, ["child", "ancestor"], "left_anti").isEmpty():
            raise RuntimeError(f"paths are longer than {levels} steps; raise levels")
    return out.select("child", "ancestor", "level")


def descendants(edges: DataFrame, child: str, parent: str, roots: DataFrame, root: str) -> DataFrame:
    """Every node under the roots, roots included."""
    e = cut(edges.where(F.col(child) != F.col(parent)).select(F.col(child).alias("node"), F.col(parent).alias("_up")))
    seen = cut(roots.select(F.col(root).alias("node")).distinct())
    front = seen
    while not front.isEmpty():
        front = cut(e.join(front.select(F.col("node").alias("_up")), "_up").select("node").distinct().join(seen, "node", "left_anti"))
        seen = cut(seen.unionByName(front))
    return seen


def ancestor_at_rank(df: DataFrame, key: str, parent: str, rank: str, name: str, ranks: Sequence[str], levels: int = 20) -> DataFrame:
    """Adds a column for each rank: the name of the nearest ancestor of that rank."""
    up = closure(df, key, parent, levels).join(df.select(F.col(key).alias("ancestor"), F.lower(rank).alias("_rank"), F.col(name).alias("_name")), "ancestor")
    nearest = [F.min_by(F.when(F.col("_rank") == r, F.col("_name")), F.when(F.col("_rank") == r, F.struct("level", "_name"))).alias(r) for r in ranks]
    return df.join(up.where(F.col("_rank").isin(*ranks)).groupBy(F.col("child").alias(key)).agg(*nearest), key, "left")


def genus_from_name(rank: Column, name: Column, genus: Column) -> Column:
    """The known genus, else the first word of names from species down."""
    return F.coalesce(genus, F.when(rank_order(rank) >= rank_order(F.lit("species")), F.get(F.split(name, " "), F.lit(0))))


def backfill_mode(df: DataFrame, ranks: Sequence[str]) -> DataFrame:
    """For each rank but the first, fills missing higher ranks with the most frequent value among rows that share it.

    ranks: from the highest down. Of equally frequent values the least counts.
    """
    for i, low in enumerate(ranks[1:], 1):
        highs = ranks[:i]
        modes = df.where(F.col(low).isNotNull()).groupBy(low).agg(*[F.mode(h, True).alias(f"_{h}") for h in highs])
        df = df.join(modes, low, "left").withColumns({h: F.coalesce(h, f"_{h}") for h in highs}).select(*df.columns)
    return df


def link_orphans(df: DataFrame, key: str, parent: str, name: str, rank: str, group: str, accepted: str, ids: Column) -> DataFrame:
    """Rows without a parent go to the accepted genus of their first word, or, from three words on, the species of their first two.

    Same group; of several the one with most ids, then the least key. Each name
    hands on its two best rows only: one of them may be the orphan itself.
    """
    n = F.size(F.split(name, " "))
    orphans = df.where(F.col(parent).isNull()).select(
        F.col(key).alias("_k"), F.col(group).alias("_g"), F.when(n == 2, "genus").when(n >= 3, "species").alias("_rank"), F.substring_index(name, " ", 1).alias("_one"), F.substring_index(name, " ", 2).alias("_two")
    )
    wanted = orphans.select("_k", "_g", "_rank", F.when(F.col("_rank") == "genus", F.col("_one")).otherwise(F.col("_two")).alias("_name")).where("_rank IS NOT NULL")
    have = df.where(accepted).select(F.col(key).alias("_to"), F.col(group).alias("_g"), F.lower(rank).alias("_rank"), F.col(name).alias("_name"), ids.alias("_ids"))
    order = [F.col("_ids").desc(), F.col("_to")]
    places = Window.partitionBy("_g", "_rank", "_name").orderBy(*order)
    have = have.where("_to IS NOT NULL").groupBy("_g", "_rank", "_name", "_to").agg(F.max("_ids").alias("_ids")).withColumn("_n", F.row_number().over(places)).where("_n <= 2").drop("_n")
    best = pick_one(wanted.join(have, ["_g", "_rank", "_name"]).where("_k <> _to"), ["_k"], order)
    return df.join(best.select(F.col("_k").alias(key), "_to"), key, "left").withColumn(parent, F.coalesce(parent, "_to")).drop("_to").select(*df.columns)


def cascade_up(df: DataFrame, key: str, parent: str, flag: str, provenance: str, may: Column | None = None, rounds: int | None = None, stall: bool = False) -> DataFrame:
    """Rows without the flag get it, with their children's provenance, once a child has it.

    Ends without candidates (each round adds rows with the flag, so it does),
    or after `rounds` if given; with stall, also when a round has as many
    candidates as the one before.
    """
    may = F.lit(True) if may is None else may
    before, round_ = -1, 0
    while rounds is None or round_ < rounds:
        round_ += 1
        kids = df.where(flag).where(F.col(parent).isNotNull()).groupBy(F.col(parent).alias("_p")).agg(union_of_lists(F.col(provenance)).alias("_by"))
        joined = cut(df.join(kids, F.col(key) == F.col("_p"), "left").withColumn("_new", F.col("_p").isNotNull() & ~F.coalesce(F.col(flag), F.lit(False)) & may))
        n = joined.where("_new").count()
        if n == 0 or stall and n == before:
            break
        before = n
        df = cut(joined.withColumns({flag: F.col("_new") | F.col(flag), provenance: F.when(F.col("_new"), F.col("_by")).otherwise(F.col(provenance))}).select(*df.columns))
    return df


def relink_dangling(df: DataFrame, key: str, parent: str, name: str, accepted: str) -> DataFrame:
    """Parents that are not accepted are replaced by the accepted row of their name (least key), else by null."""
    rows = df.select(F.col(key).alias("_p"), F.col(name).alias("_name"), F.col(accepted).alias("_ok"))
    best = df.where(accepted).groupBy(F.col(name).alias("_name")).agg(F.min(key).alias("_best"))
    out = df.join(rows, F.col(parent) == F.col("_p"), "left").join(best, "_name", "left")
    fixed = F.when(F.coalesce(F.col("_ok"), F.lit(False)), F.col(parent)).otherwise(F.when(F.col("_best") != F.col(key), F.col("_best")))
    return out.withColumn(parent, fixed).select(*df.columns)


def child_counts(df: DataFrame, key: str, parent: str, accepted: str | None = None) -> DataFrame:
    """Adds the number of (accepted) children; null for rows without any."""
    kids = df.where(accepted) if accepted else df
    n = kids.where(F.col(parent).isNotNull()).groupBy(F.col(parent).alias("_p")).agg(F.count("*").alias("child_count"))
    return df.join(n, F.col(key) == F.col("_p"), "left").drop("_p")


def rollup(values: DataFrame, edges: DataFrame, node: str, child: str, parent: str, keys: Sequence[str], sums: Sequence[str], levels: int = 20) -> DataFrame:
    """Values of each node with those of all nodes below, added up level by level along direct edges.

    Rows are aggregated before each step, so no step is larger than nodes times keys.
    Fails where paths are longer than `levels`, as in a cycle.
    """
    e = cut(edges.where(F.col(child).isNotNull() & F.col(parent).isNotNull() & (F.col(child) != F.col(parent))).select(F.col(child).alias(node), F.col(parent).alias("_up")).distinct())
    add: Callable[[DataFrame], DataFrame] = lambda d: d.groupBy(node, *keys).agg(*[F.sum(s).alias(s) for s in sums])
    front = cut(add(values.select(node, *keys, *sums)))
    out = front
    for _ in range(levels):
        front = cut(add(front.join(e, node).select(F.col("_up").alias(node), *keys, *sums)))
        if front.isEmpty():
            break
        out = out.unionByName(front)
    else:
        if not front.join(e, node).isEmpty():
            raise RuntimeError(f"paths are longer than {levels} steps, or a cycle; raise levels")
    return add(out)

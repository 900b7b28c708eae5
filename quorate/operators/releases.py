"""Differences between releases, and assertions over one."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def diff(current: DataFrame, previous: DataFrame, key: str, columns: Sequence[str], scope: str | None = None, context: Sequence[str] = (), rekey: bool = True) -> DataFrame:
    """(key, old key, kind, fields): rows that are new, deleted or changed, and the changed columns.

    scope: a flag; only rows that have it in a release count there (null is
    false). Null equals null. A new and a deleted row with equal columns and
    context, unique on each side, are one row whose key changed.
    """
    columns = [c for c in columns if c in current.columns and c in previous.columns]

    def side(df: DataFrame, mark: str) -> DataFrame:
        own = df.where(F.coalesce(F.col(scope), F.lit(False))) if scope else df
        return own.select(F.col(key), F.lit(True).alias(f"_{mark}"), *[F.col(c).alias(f"{mark}_{c}") for c in dict.fromkeys((*columns, *context))])

    both = side(current, "c").join(side(previous, "p"), key, "full")
    fields = F.array_compact(F.array(*[F.when(~F.col(f"c_{c}").eqNullSafe(F.col(f"p_{c}")), F.lit(c)) for c in columns])) if columns else F.array().cast("array<string>")
    kind = F.when(F.col("_p").isNull(), "new").when(F.col("_c").isNull(), "deleted").otherwise(F.when(F.size(fields) > 0, "changed"))
    none = F.array().cast("array<string>")
    rows = both.withColumn("kind", kind).where("kind IS NOT NULL")
    out = rows.select(key, F.lit(None).cast(dict(current.dtypes)[key]).alias("old_key"), "kind", F.when(F.col("kind") == "changed", fields).otherwise(none).alias("fields"))
    names = list(dict.fromkeys((*columns, *context)))
    if not rekey or not names:
        return out

    def alone(mark: str, kind: str) -> DataFrame:
        w = Window.partitionBy(*[f"{mark}_{c}" for c in names])
        return rows.where(F.col("kind") == kind).withColumn("_n", F.count("*").over(w)).where("_n = 1").select(F.col(key).alias(f"_{kind}"), *[F.col(f"{mark}_{c}").alias(f"{kind}_{c}") for c in names])

    same = None
    for c in names:
        one = F.col(f"new_{c}").eqNullSafe(F.col(f"deleted_{c}"))
        same = one if same is None else same & one
    moved = alone("c", "new").join(alone("p", "deleted"), same).select("_new", "_deleted")
    gone = moved.select(F.explode(F.array("_new", "_deleted")).alias(key))
    changed = moved.select(F.col("_new").alias(key), F.col("_deleted").alias("old_key"), F.lit("changed").alias("kind"), F.array(F.lit(key)).alias("fields"))
    return out.join(gone, key, "left_anti").select(*out.columns).unionByName(changed)


def diff_profile(changes: DataFrame, total: Column | int, key: str, ratio: float = 0.10, samples: int = 200) -> DataFrame:
    """(kind, n, share, suspicious, sample, truncated) of each kind of change; samples are the least keys.

    Only `samples` keys of each kind are gathered, picked by ranked windows over parts of a kind and then over what these leave.
    """
    salted, w = Window.partitionBy("kind", "_s").orderBy(key), Window.partitionBy("kind").orderBy(key)
    counts = changes.groupBy("kind").agg(F.count("*").alias("n"))
    few = changes.select("kind", key, F.pmod(F.xxhash64(key), F.lit(64)).alias("_s")).withColumn("_i", F.row_number().over(salted)).where(F.col("_i") <= samples)
    some = few.withColumn("_i", F.row_number().over(w)).where(F.col("_i") <= samples).groupBy("kind").agg(F.array_sort(F.collect_list(key)).alias("sample"))
    share = F.col("n") / (F.lit(total) if isinstance(total, int) else total)
    return counts.join(some, "kind").withColumns({"share": share, "suspicious": share > ratio, "truncated": F.col("n") > samples})


def field_counts(changes: DataFrame) -> DataFrame:
    """(field, n): how often each column changed."""
    return changes.select(F.explode("fields").alias("field")).groupBy("field").agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class Check:
    """A query over the final table; expects "any" rows or "none"."""

    name: str
    rows: Callable[[DataFrame], DataFrame]
    expect: str = "none"


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(check, status): passed, failed or skipped (a column is missing). Skips are counted as such."""
    out = []
    for c in checks:
        try:
            found = c.rows(df)
            found.schema  # noqa: B018  resolves the columns
        except AnalysisException:
            out.append((c.name, "skipped"))
            continue
        empty = found.isEmpty()
        out.append((c.name, "passed" if empty == (c.expect == "none") else "failed"))
    return df.sparkSession.createDataFrame(out, "check string, status string")


def count_checks(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """(check, violations) of row conditions, all in one pass."""
    sums = df.agg(*[F.sum(F.when(F.coalesce(~c, F.lit(True)), 1).otherwise(0)).alias(n) for n, c in conditions.items()])
    return sums.select(F.explode(F.map_from_entries(F.array(*[F.struct(F.lit(n), F.col(n).cast("long")) for n in conditions]))).alias("check", "violations"))


def profile(df: DataFrame) -> DataFrame:
    """(column, type, nulls, distinct, least, largest) of each column, in one pass."""
    aggs = []
    for i, (c, _) in enumerate(df.dtypes):
        aggs += [F.sum(F.col(c).isNull().cast("int")).alias(f"n{i}"), F.approx_count_distinct(F.col(c).cast("string")).alias(f"d{i}"), F.min(F.col(c).cast("string")).alias(f"a{i}"), F.max(F.col(c).cast("string")).alias(f"b{i}")]
    rows = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"n{i}").alias("nulls"), F.col(f"d{i}").alias("distinct"), F.col(f"a{i}").alias("least"), F.col(f"b{i}").alias("largest")) for i, (c, t) in enumerate(df.dtypes)]
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("x")).select("x.*")

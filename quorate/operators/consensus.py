"""Votes, duplicate merges, acceptance and deduplication by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorate.functions.collections import first_mode, list_distinct
from quorate.functions.vocabulary import AUTHORITIES
from quorate.functions.text import rank_order
from quorate.operators.lookup import pick_one


def vote_pool(target: DataFrame, sources: Mapping[str, DataFrame], links: Mapping[str, str], column: str, key: str = "id_raw", valid: Callable[[Column], Column] | None = None) -> DataFrame:
    """Adds `pool`: one candidate of each source, in the order of `sources`; null where it has none or it is not valid.

    links: target column that holds each source's id. Sources without the
    column are skipped. Of several rows with one id the least value counts.
    """
    out, names = target, []
    for name, source in sources.items():
        if column not in source.columns or name not in links:
            continue
        value = F.trim(F.col(column)) if dict(source.dtypes)[column] == "string" else F.col(column)
        if valid is not None:
            value = F.when(valid(value), value)
        one = source.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_k_{name}")).agg(F.min(value).alias(f"_v_{name}"))
        out = out.join(one, F.col(links[name]) == F.col(f"_k_{name}"), "left").drop(f"_k_{name}")
        names.append(f"_v_{name}")
    return out.withColumn("pool", F.array(*names)).drop(*names)


def vote(target: DataFrame, sources: Mapping[str, DataFrame], links: Mapping[str, str], column: str, out: str, fallback: str | None = None, **options) -> DataFrame:
    """Adds the most frequent candidate, ties going to the source that comes first; null without candidates."""
    won = first_mode(F.col("pool"))
    return vote_pool(target, sources, links, column, **options).withColumn(out, F.coalesce(won, F.col(fallback)) if fallback else won).drop("pool")


def first_mode_of(df: DataFrame, key: str, value: str, order: Sequence[str], out: str) -> DataFrame:
    """(key, out): the most frequent value of each key, ties going to the value that comes first in the order; null if all are.

    Values are counted with map-side combining; no key's rows are gathered.
    """
    counts = df.groupBy(key, value).agg(F.count(value).alias("_n"), F.min(F.struct(*order)).alias("_first"))
    return counts.groupBy(key).agg(F.min_by(value, F.struct(-F.col("_n"), F.col("_first"))).alias(out))


def ambiguous(pool: Column) -> Column:
    """Whether more than one distinct candidate stands."""
    return F.size(F.array_distinct(F.array_compact(pool))) > 1


def valid_year(year: Column, first: int = 1700) -> Column:
    return year.between(F.lit(first), F.year(F.current_date()))


def valid_name(name: Column) -> Column:
    """Three words at most, or a quoted cultivar."""
    return (F.size(F.split(name, r"\s+")) <= 3) | F.contains(name, F.lit("'"))


def valid_rank(rank: Column) -> Column:
    return rank_order(rank).isNotNull()


def canonical_parents(sources: DataFrame, records: DataFrame, canonical: DataFrame) -> DataFrame:
    """(id, parent): the source's parent record, read as the canonical row of its name and kingdom; else the raw parent.

    sources: id, parent_raw, kingdom. records: id_raw, name. canonical: id, name, kingdom, accepted.
    """
    named = sources.join(records.select(F.col("id_raw").alias("parent_raw"), F.col("name").alias("_name")).distinct(), "parent_raw", "left")
    c = canonical.where("accepted").groupBy(F.col("name").alias("_name"), "kingdom").agg(F.min("id").alias("_c"))
    found = named.join(c, ["_name", "kingdom"], "left")
    w = Window.partitionBy("id").orderBy(F.col("_c").isNull(), "_c", "parent_raw")
    return found.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("id", F.coalesce("_c", "parent_raw").alias("parent"))


def merge_duplicates(df: DataFrame, key: str, ids: Sequence[str] = (), largest: Sequence[str] = (), tie: Sequence[str] = ()) -> DataFrame:
    """One row for each key: the one with most values, then most ids, then by tie; `largest` columns take the maximum."""
    rest = [c for c in df.columns if c != key]
    filled = lambda cs: sum((F.col(c).isNotNull().cast("int") for c in cs), F.lit(0))
    w = Window.partitionBy(key)
    order = [filled(rest).desc(), filled(ids).desc(), *[F.col(c).asc_nulls_last() for c in (tie or rest)]]
    tops = {c: F.max(c).over(w) for c in largest}
    return df.withColumns(tops | {"_n": F.row_number().over(w.orderBy(*order))}).where("_n = 1").drop("_n")


def decide_acceptance(df: DataFrame, votes: Mapping[str, Column], group: str = "kingdom", authorities: Mapping[str, Sequence[str]] = AUTHORITIES, popular: Column | None = None) -> DataFrame:
    """Adds accepted_by, considered_synonym, synonym and accepted.

    votes: each authority's status column. Only the group's authorities count.
    popular: a further vote ("wikidata") for rows that nobody calls a synonym.
    """

    def by(status: str) -> Column:
        out = F.array().cast("array<string>")
        for g, names in authorities.items():
            own = F.array_compact(F.array(*[F.when(votes[a] == status, F.lit(a)) for a in names if a in votes]))
            out = F.when(F.col(group) == g, own).otherwise(out)
        return out

    known = F.col(group).isin(*authorities)
    out = df.withColumns({"accepted_by": by("accepted"), "considered_synonym": by("synonym")}).withColumn("synonym", F.size("considered_synonym") > 0)
    if popular is not None:
        extra = known & ~F.col("synonym") & F.coalesce(popular, F.lit(False))
        out = out.withColumn("accepted_by", F.when(extra, F.array_append("accepted_by", F.lit("wikidata"))).otherwise(F.col("accepted_by")))
    return out.withColumn("accepted", F.size("accepted_by") > 0)


def dedupe_by(df: DataFrame, key: str, order: Sequence[Column], lists: Sequence[str] = (), flags: Sequence[str] = (), fills: Sequence[str] = (), largest: Sequence[str] = (), accepted: str = "accepted") -> DataFrame:
    """Among accepted rows with one key the first by order keeps; the others lose `accepted` but stay.

    The winner takes from all: unions of lists, ors of flags, its own value or
    else the most frequent (least of equals) for fills, maxima for largest.
    """
    own = df.where(F.coalesce(F.col(accepted), F.lit(False)) & F.col(key).isNotNull())
    rest = df.where(~(F.coalesce(F.col(accepted), F.lit(False)) & F.col(key).isNotNull()))
    many = {f"_{c}": F.flatten(F.collect_list(c)) for c in lists} | {f"_{c}": F.coalesce(F.bool_or(c), F.lit(False)) for c in flags}
    many |= {f"_{c}": F.mode(c, True) for c in fills} | {f"_{c}": F.max(c) for c in largest}
    merged = own.groupBy(key).agg(F.count("*").alias("_many"), *[v.alias(k) for k, v in many.items()])
    ranked = own.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).join(merged, key)
    best = (F.col("_n") == 1) & (F.col("_many") > 1)
    new = {c: F.when(best, list_distinct(F.col(f"_{c}"))).otherwise(F.col(c)) for c in lists}
    new |= {c: F.when(best, F.col(f"_{c}")).otherwise(F.col(c)) for c in (*flags, *largest)}
    new |= {c: F.when(best, F.coalesce(c, f"_{c}")).otherwise(F.col(c)) for c in fills}
    return ranked.withColumns(new | {accepted: F.col("_n") == 1}).select(*df.columns).unionByName(rest)


def transfer_flags(target: DataFrame, source: DataFrame, key: str, flags: Sequence[str], lists: Sequence[str] = ()) -> DataFrame:
    """A true flag stays, else the source's; lists become the union of both."""
    one = pick_one(source, [key], [F.col(c).desc_nulls_last() for c in flags] or [F.col(key)])
    joined = target.join(one.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in (*flags, *lists)]), key, "left")
    empty = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    new = {c: F.when(F.col("_hit"), F.coalesce(F.nullif(F.col(c), F.lit(False)), F.col(f"_{c}"))).otherwise(F.col(c)) for c in flags}
    new |= {c: F.when(F.col(c).isNotNull() | F.col(f"_{c}").isNotNull(), list_distinct(F.concat(empty(F.col(c)), empty(F.col(f"_{c}"))))) for c in lists}
    return joined.withColumns(new).select(*target.columns)

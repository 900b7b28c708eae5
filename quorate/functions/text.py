"""Clean-up and extraction of names and other strings."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorate.functions import vocabulary as V

_TOKENS = "|".join(re.escape(t).replace(r"\ ", " ") for t in V.NAME_RANK_TOKENS)
RANK_TOKEN = rf" (notho)?({_TOKENS})(\.?)(\s|$)"


def strip_infix(name: Column, part: Column) -> Column:
    """name without every occurrence of part, ignoring case; unchanged where part is null or absent.

    Lower-cased and trimmed; only the first run of white space becomes one space.
    """
    low, piece = F.lower(name), F.lower(F.trim(part))
    out = F.regexp_replace(F.trim(F.replace(low, piece, F.lit(""))), r"^(\S*)\s+", "$1 ")
    return F.when(F.contains(low, piece) & (piece != ""), out).otherwise(name)


def strip_rank_tokens(name: Column) -> Column:
    return F.regexp_replace(name, RANK_TOKEN, " ")


def fold_quotes(name: Column) -> Column:
    return F.translate(name, V.QUOTES, "'" * len(V.QUOTES))


def clean_name(name: Column) -> Column:
    """Rank tokens out, quotes folded, stray characters out, spaces collapsed; null where nothing is left.

    Stray is all but a-z and the characters from space to apostrophe, so a hyphen is stray too.
    """
    kept = F.regexp_replace(fold_quotes(strip_rank_tokens(name)), r"[^a-z\x20-\x27]", "")
    return F.nullif(F.trim(F.regexp_replace(kept, " {2,}", " ")), F.lit(""))


def find_markers(df: DataFrame, name: str = "name_clean", rank: str | None = "rank_raw", mark: str = "×") -> DataFrame:
    """Adds hybrid and hybridpos (0-based, of the marker) and takes the marker out of name."""
    marked = F.replace(F.col(name), F.lit(" x "), F.lit(f" {mark} "))
    flag = F.contains(marked, F.lit(mark))
    if rank and rank in df.columns:
        by_rank = F.startswith(F.col(rank), F.lit("notho")) | F.col(rank).isin(*V.HYBRID_RANKS)
        flag = F.when(F.coalesce(flag, F.lit(False)), F.lit(True)).otherwise(by_rank)
    return (
        df.withColumn("_marked", marked)
        .withColumn("hybrid", flag)
        .withColumn("hybridpos", F.when(F.col("hybrid"), F.nullif(F.locate(mark, F.col("_marked")) - 1, F.lit(-1))).cast("short"))
        .withColumn(name, F.replace(F.replace(F.col("_marked"), F.lit(f"{mark} "), F.lit("")), F.lit(mark), F.lit("")))
        .drop("_marked")
    )


def spelling_rows(spellings: dict[str, tuple[str, ...]]) -> list[tuple[str, str]]:
    return [(s, clean) for clean, all_ in spellings.items() for s in all_]


def map_values(df: DataFrame, column: str, spellings: dict[str, tuple[str, ...]], out: str) -> DataFrame:
    """Adds the canonical value of a column's spelling, ignoring case; null where it is unknown."""
    rows = spelling_rows(spellings)  # fixed, small
    look = F.broadcast(df.sparkSession.createDataFrame(rows, f"_spelling string, {out} string"))
    return df.join(look, F.lower(F.col(column)) == F.col("_spelling"), "left").drop("_spelling")


def status_flags(status: Column) -> tuple[Column, Column]:
    """(accepted, synonym); null status leaves both null."""
    return status == "accepted", status == "synonym"


def rank_order(rank: Column) -> Column:
    """Place of a rank in RANKS; null where it is unknown."""
    return F.nullif(F.array_position(F.array(*[F.lit(r) for r in V.RANKS]), F.upper(rank)), F.lit(0))


def area_name(text: Column) -> Column:
    """Area names for comparison: lower case, no diacritics, only letters and digits."""
    plain = F.translate(F.replace(F.lower(text), F.lit("&"), F.lit(" and ")), V.DIACRITICS, V.PLAIN)
    return F.trim(F.regexp_replace(F.regexp_replace(plain, r"[.`']+", ""), "[^a-z0-9]+", " "))


def extract_id(text: Column, pattern: str, kind: str = "bigint", group: int = 1) -> Column:
    """An id inside a string; null where it is absent or does not fit."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).try_cast(kind)


def unsigned(value: Column, bits: int = 32) -> Column:
    """value as a number of that many bits without sign; null outside."""
    n = value.try_cast("decimal(38,0)")
    return F.when((n >= 0) & (n <= (1 << bits) - 1), n.cast("bigint"))


def split_year(author: Column) -> tuple[Column, Column]:
    """(author without a trailing year, that year)."""
    year = extract_id(author, r"(\d{4})\)?\s*$", "int")
    return F.when(year.isNotNull(), F.trim(F.regexp_replace(author, r"[,\s(]*\d{4}\)?\s*$", ""))).otherwise(author), year


def words(text: Column) -> Column:
    return F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != "")


def rank_of_name(name: Column) -> Column:
    """Rank by shape: one word a genus, two a species, an abbreviation between words what it says, else null."""
    n = F.size(words(name))
    marked = [F.when(F.contains(name, F.lit(f" {mark} ")), F.lit(rank)) for mark, rank in (("subsp.", "subspecies"), ("var.", "variety"), ("f.", "form"))]
    return F.coalesce(*marked, F.when(n == 1, F.lit("genus")).when(n == 2, F.lit("species")))


def invalid_names(df: DataFrame, name: str = "name_clean", rank: str = "rank_clean", most: int = 3) -> DataFrame:
    """Rows whose name has over `most` words (cultivars apart) or odd characters, with the reason."""
    long = F.size(words(F.col(name))) > most
    if rank in df.columns:
        long = long & ~F.col(rank).eqNullSafe("cultivar")
    odd = F.col(name).rlike(r"[^a-z\x20-\x27]")
    return df.withColumn("reason", F.when(long, "words").when(odd, "characters")).where("reason IS NOT NULL")


def after_prefix(full: Column, prefix: Column) -> Column:
    """What follows prefix (an authority after a name); null where full does not start with it or nothing follows."""
    return F.when(F.startswith(full, prefix), F.nullif(F.trim(F.substring(full, F.length(prefix) + 1, F.length(full))), F.lit("")))


def tagged_names(df: DataFrame, key: str, lang: str, name: str, codes: DataFrame, code: str, short: str) -> DataFrame:
    """(key, names): distinct "language:name" of each key, sorted, with language codes made short.

    Languages without a short code and empty names are left out.
    """
    rows = df.join(codes.select(F.col(code).alias("_code"), F.col(short).alias("_short")), F.lower(lang) == F.col("_code"))
    clean = F.lower(F.trim(name))
    return rows.where(clean != "").groupBy(key).agg(F.array_sort(F.collect_set(F.concat("_short", F.lit(":"), clean))).alias("names"))

"""Quality rules with risk-controlled cutoffs (DataFrame functions only).

Every rule compares one statistic of a text with a cutoff. Cutoffs come from
labelled documents: for each stratum (language), rule and candidate cutoff the
good documents (quality 1) that the cutoff would reject are counted, and the
exact binomial tail P(Bin(n, alpha / rules) <= rejected) is the p-value of
"this cutoff rejects more than alpha / rules of the good documents". Candidates
with a p-value under delta / (strata * rules * cutoffs) are certified, so with
probability 1 - delta no stratum loses more than alpha of its good documents.
Among certified cutoffs the rule takes the one that rejects most bad documents
net of `price` for each good one, and none if that is not positive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorate.llm.common import scratch, written

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Candidate cutoffs; a text is rejected if its statistic is larger.
GRID = {
    "symbols_per_word": (0.05, 0.1, 0.2, 0.3, 0.5, 0.8),
    "upper_share": (0.1, 0.2, 0.3, 0.4, 0.5, 0.7),
    "exclaims_per_word": (0.05, 0.1, 0.2, 0.3, 0.5, 0.8),
    "dup_line_share": (0.1, 0.2, 0.3, 0.5, 0.7, 0.9),
    "repeat_share": (0.02, 0.05, 0.1, 0.15, 0.2, 0.3),
    "chars_per_word": (8.0, 9.0, 10.0, 12.0, 15.0, 20.0),
}
#: The statistics, written once for Spark and DuckDB.
STATISTICS = {
    "symbols_per_word": "CASE WHEN n_words > 0 THEN n_symbols * 1.0D / n_words END",
    "upper_share": "CASE WHEN word_chars > 0 THEN n_upper * 1.0D / word_chars END",
    "exclaims_per_word": "CASE WHEN n_words > 0 THEN n_exclaims * 1.0D / n_words END",
    "dup_line_share": "CASE WHEN n_lines > 0 THEN n_dup_lines * 1.0D / n_lines END",
    "repeat_share": "CASE WHEN n_words > 0 THEN n_repeat_words * 1.0D / n_words END",
    "chars_per_word": "CASE WHEN n_words > 0 THEN word_chars * 1.0D / n_words END",
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def bind(value: Column, body) -> Column:
    """body(value) with value computed once, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _without(text: Column, letters: str) -> Column:
    return F.length(F.translate(text, letters, "")).cast("long")


def _repeat_words(words: Column, hashes: Column, width: int) -> Column:
    """Words under windows whose hash occurs twice or more in the text."""

    def covered(starts: Column) -> Column:
        return F.aggregate(
            F.transform(starts, lambda p, k: F.least(F.lit(width), F.coalesce(F.get(starts, k + 1) - p, F.lit(width)))),
            F.lit(0),
            lambda total, x: total + x,
        )

    def twice(rows: Column) -> Column:
        same = F.filter(rows, lambda x, k: (x.h == F.get(rows, k - 1).h) | (x.h == F.get(rows, k + 1).h))
        return bind(F.array_sort(F.transform(same, lambda x: x.i)), covered)

    rows = F.sort_array(F.transform(hashes, lambda h, k: F.struct(h.alias("h"), k.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(bind(rows, twice)).cast("long")


def text_statistics(documents: DataFrame, keep: list[str], text: str = "text", width: int = 5) -> DataFrame:
    """Counts of each text, computed inside its row (no shuffle); null text: empty."""
    t = F.col("_t")
    space = f"[{SPACE}]+"
    hashes = F.when(
        F.col("n_words") >= width,
        F.transform(F.sequence(F.lit(1), F.col("n_words").cast("int") - (width - 1)), lambda i: F.xxhash64(F.slice("_w", i, F.lit(width)))),
    ).otherwise(F.array().cast("array<bigint>"))
    return (
        documents.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
        .select(
            *keep,
            "_t",
            F.filter(F.split(t, space, -1), lambda w: w != "").alias("_w"),
            F.filter(F.split(t, "\n", -1), lambda x: F.translate(x, SPACE, "") != "").alias("_l"),
        )
        .withColumn("n_words", F.size("_w").cast("long"))
        .withColumn("_h", hashes)
        .select(
            *keep,
            "n_words",
            _without(t, SPACE).alias("word_chars"),
            (F.length(t) - _without(t, SYMBOLS)).alias("n_symbols"),
            (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
            _repeat_words(F.col("_w"), F.col("_h"), width).alias("n_repeat_words"),
            F.size("_l").cast("long").alias("n_lines"),
            (F.length(t) - _without(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).alias("n_upper"),
            (F.length(t) - _without(t, "!")).alias("n_exclaims"),
        )
    )


#: Errors of Stirling's formula for ln x!, x from 1 to 15; a series serves above.
_STIRLING = [math.lgamma(x + 1) - ((x + 0.5) * math.log(x) - x + 0.5 * math.log(2 * math.pi)) for x in range(1, 16)]


def _stirling_error(x: Column) -> Column:
    series = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * x * x)) / (x * x)) / (x * x)) / x
    return F.when(x < 16, F.get(F.array(*map(F.lit, _STIRLING)), x.cast("int") - 1)).otherwise(series)


def binomial_tail(n: Column, k: Column, p: Column) -> Column:
    """P(Bin(n, p) <= k) for k below n * p, exact to double precision.

    The term of k, by the saddle-point form, times the sum of the ratios of
    the terms below it. Terms over 9 standard deviations below the mean add
    nothing, so the sum is short whatever n is.
    """
    n, k = n.cast("double"), k.cast("double")
    m = n - k
    divergence = k * F.log(k / (n * p)) + m * F.log(m / (n * (1 - p)))
    inside = _stirling_error(n) - _stirling_error(k) - _stirling_error(m) - divergence + 0.5 * F.log(n / (2 * math.pi * k * m))
    log_term = F.when(k <= 0, n * F.log(1 - p)).when(m <= 0, n * F.log(p)).otherwise(inside)
    steps = F.least(k, F.ceil(9 * F.sqrt(n * p)) + 60).cast("long")

    def add(acc: Column, i: Column) -> Column:
        term = acc.term * (k - i) * (1 - p) / ((m + i + 1) * p)
        return F.struct(term.alias("term"), (acc.total + term).alias("total"))

    rest = F.when(steps >= 1, F.sequence(F.lit(0).cast("long"), steps - 1)).otherwise(F.array().cast("array<bigint>"))
    return F.least(F.lit(1.0), F.exp(log_term) * F.aggregate(rest, F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")), add, lambda acc: acc.total))


def certified_cutoffs(stats: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.05, delta: float = 0.05, price: float = 20.0) -> DataFrame:
    """One row (stratum, rule, cutoff) for each rule that is in force there.

    A document with several labels counts as good only if all say so; rows
    without doc_id or label are left out. A stratum without labels has no rule.
    """
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("_good"))
    counted = stats.where("doc_id IS NOT NULL").join(marks, "doc_id").withColumn("_s", F.coalesce(F.col(stratum).cast("string"), F.lit("")))
    cells = [(name, c) for name, grid in GRID.items() for c in grid]
    sums = [F.sum(F.when((F.col("_good") == good) & (F.expr(STATISTICS[name]) > c), 1).otherwise(0)).alias(f"c{i}_{good}") for i, (name, c) in enumerate(cells) for good in (1, 0)]
    # labelled rows meet in one row for each stratum, with map-side sums
    groups = counted.groupBy(F.col("_s").alias("stratum")).agg(F.sum("_good").alias("good"), *sums)
    long = groups.select(
        "stratum",
        "good",
        F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(float(c)).alias("cutoff"), F.col(f"c{i}_1").alias("lost"), F.col(f"c{i}_0").alias("caught")) for i, (name, c) in enumerate(cells)])).alias("x"),
    ).select("stratum", "good", "x.*")
    share = F.lit(alpha / len(GRID))
    tests = groups.select(F.count("*").alias("strata"))
    p = F.when(F.col("lost") < F.col("good") * share, binomial_tail(F.col("good"), F.col("lost"), share)).otherwise(F.lit(1.0))
    gain = F.col("caught") - F.lit(price) * F.col("lost")
    return (
        long.crossJoin(F.broadcast(tests))  # one row
        .where((gain > 0) & (p <= F.lit(delta) / (F.col("strata") * len(cells))))
        .groupBy("stratum", "rule")
        .agg(F.max_by("cutoff", F.struct(gain, F.col("cutoff"))).alias("cutoff"))
    )


def apply_quality_rules(documents: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.05, delta: float = 0.05, price: float = 20.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """The documents' doc_id, stratum, columns keep, counts, base_failed, rejected_by and kept.

    One row for each row of documents. Null or empty text: no words, so
    base_failed. base_failed: under 10 words, or over a fifth of the words in
    5-word windows that occur twice or more. rejected_by: names of the rules
    in force whose cutoff the text exceeds. kept: neither. Without labels no
    rule is in force and only the base decides. Further columns are ignored.
    """
    stats = scratch(text_statistics(documents, ["doc_id", stratum, *keep]))
    cutoffs = certified_cutoffs(stats, labels, stratum, alpha, delta, price)
    # one row for each stratum, in a table of known size: Spark broadcasts it only where it is small
    wide = written(cutoffs.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_{r}") for r in GRID]))
    joined = stats.withColumn("_s", F.coalesce(F.col(stratum).cast("string"), F.lit(""))).join(wide.withColumnRenamed("stratum", "_own"), F.col("_s") == F.col("_own"), "left")
    broken = [F.when(F.expr(STATISTICS[r]) > F.col(f"_{r}"), F.lit(r)) for r in GRID]
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return joined.select("doc_id", stratum, *keep, *COUNTS, failed.alias("base_failed"), F.array_compact(F.array(*broken)).alias("rejected_by")).withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))


def op1(spark, sf_dir) -> DataFrame:
    """The counts and the verdict of each document."""
    documents, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return apply_quality_rules(documents, labels).select("doc_id", *COUNTS, "base_failed", "kept")


_CELLS = [(name, c) for name, grid in GRID.items() for c in grid]
_N = len(GRID)
STATS_SQL = r"""
_t AS (SELECT row_number() OVER () AS _r, doc_id, lang, coalesce(text, '') AS t FROM documents),
_w AS (
  SELECT _r, doc_id, lang, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM _t),
_g AS (SELECT _r, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT _r, w, unnest(range(1, len(w) - 3)) AS i FROM _w)),
_d AS (SELECT _r, s FROM _g GROUP BY _r, s HAVING count(*) > 1),
_c AS (SELECT _r, count(DISTINCT i + k) AS n FROM _g JOIN _d USING (_r, s), range(0, 5) AS o(k) GROUP BY _r),
_stats AS (
  SELECT doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines,
         length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper, length(t) - length(replace(t, '!', '')) AS n_exclaims
  FROM _w LEFT JOIN _c ON _w._r = _c._r)"""
_VALUES = ", ".join(f"{x.replace('1.0D', '1.0::DOUBLE')} AS {name}" for name, x in STATISTICS.items())


def rules_sql(alpha: float = 0.05, delta: float = 0.05, price: float = 20.0) -> str:
    """CTEs ending in _verdicts: one row for each row of documents."""
    cells = ", ".join(f"('{name}', {c}::DOUBLE)" for name, c in _CELLS)
    value = "CASE rule " + " ".join(f"WHEN '{name}' THEN {name}" for name in GRID) + " END"
    a = alpha / _N
    return f"""{STATS_SQL},
_v AS (SELECT *, {_VALUES} FROM _stats),
_marks AS (SELECT doc_id, min(quality) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
_cells(rule, cutoff) AS (VALUES {cells}),
_n AS (
  SELECT coalesce(lang, '') AS s, rule, cutoff, sum(good) AS n, sum(CASE WHEN good = 1 AND {value} > cutoff THEN 1 ELSE 0 END) AS lost,
         sum(CASE WHEN good = 0 AND {value} > cutoff THEN 1 ELSE 0 END) AS caught
  FROM _v JOIN _marks USING (doc_id), _cells GROUP BY 1, 2, 3),
_p AS (
  SELECT *, CASE WHEN lost < n * {a!r} THEN list_sum(list_transform(range(0, CAST(lost AS BIGINT) + 1),
      lambda j: exp(lgamma(n + 1) - (CASE WHEN j < 2 THEN 0 ELSE lgamma(j + 1) END) - lgamma(n - j + 1) + j * ln({a!r}) + (n - j) * ln(1 - {a!r})))) ELSE 1 END AS p,
      caught - {price} * lost AS gain FROM _n),
_cut AS (
  SELECT s, rule, arg_max(cutoff, struct_pack(g := gain, c := cutoff)) AS cutoff FROM _p
  WHERE gain > 0 AND p <= {delta} / ((SELECT count(DISTINCT s) FROM _n) * {len(_CELLS)}) GROUP BY 1, 2),
_wide AS (SELECT s, {", ".join(f"max(cutoff) FILTER (WHERE rule = '{r}') AS x_{r}" for r in GRID)} FROM _cut GROUP BY s),
_verdicts AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
         NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT ({" OR ".join(f"coalesce({r} > x_{r}, false)" for r in GRID)}) AS kept
  FROM _v LEFT JOIN _wide ON coalesce(_v.lang, '') = _wide.s)"""


ORACLE = f"WITH {rules_sql()} SELECT * FROM _verdicts"

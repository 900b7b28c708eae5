"""Secret scan by patterns and a randomness test battery (DataFrame functions only).

Three patterns give the base spans. Every other run of `least` or more key
characters is a candidate. Its encoding (hex, base32, lower-case base36, base64
or letters) fixes an alphabet, and three tests ask whether the run could be
uniform over it: chi-squared on letter counts, the runs test above and below
the middle of the alphabet, and lag-1 serial correlation. A run that one of
them rejects (Bonferroni over the three) has the p-value 1. Else its p-value is
that of its chi-squared statistic in ordinary text: the lower tail, with the
mean and variance that the statistic has for letters drawn with the shares that
all documents' text has in that alphabet (a normal law; the statistic is skewed
upwards, so lower tails are overstated). Benjamini-Hochberg within bands of
length, over the candidates of all documents, keeps the expected share of
ordinary runs among the declared ones under `fdr`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorate.llm.common import scratch
from quorate.llm.quality_rules import bind

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # the runs of [0-9a-f]+ with 32 or more characters
KINDS = ("assign", "access", "hex", "random")
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
BANDS = (24, 32, 48, 64, 96)
_BIN = 0.25  # width of the bins of -log10 p


def _placed(text: Column, pattern: str, kind: int, group: int | None = None) -> Column:
    """Leftmost non-overlapping matches as structs (start, kind, end, match); offsets in code points.

    split() gives the text between the same matches, so their lengths add up to the offsets.
    """
    # group: only matches with 8 or more characters there
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def place(pairs: Column) -> Column:
        # blocks of matches, so that appending copies little however many there are
        block = 256
        none = F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>")

        def add(acc: Column, x: Column) -> Column:
            start = acc.at + F.length(x.before)
            end = start + F.length(x.match)
            own = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x.match.alias("match")))
            return F.struct(end.alias("at"), (F.when(F.length(x.value) >= 8, F.concat(acc.xs, own)).otherwise(acc.xs) if group else F.concat(acc.xs, own)).alias("xs"))

        def add_block(acc: Column, i: Column) -> Column:
            part = F.aggregate(F.slice(pairs, i * block + 1, F.lit(block)), F.struct(acc.at.alias("at"), none.alias("xs")), add)
            return bind(part, lambda x: F.struct(x.at.alias("at"), F.concat(acc.xs, F.array(x.xs)).alias("xs")))

        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,kind:int,end:int,match:string>>>").alias("xs"))
        blocks = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / block).cast("int"))
        return F.flatten(F.aggregate(blocks, first, add_block, lambda acc: acc.xs))

    pairs = F.transform(F.arrays_zip(found.alias("match"), values.alias("value"), F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)).alias("before")), lambda x: x)
    none = F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>")
    return F.when(F.size(found) == 0, none).otherwise(bind(pairs, place))


def normal_tail(z: Column) -> Column:
    """P(N(0, 1) > |z|), Abramowitz and Stegun 26.2.17 (error under 1e-7)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * series


def letter_shares(documents: DataFrame, text: str = "text") -> dict[str, tuple[float, float]]:
    """For each alphabet the sums of squares and of cubes of its letters' shares in all texts (- and _ as + and /); without text, those of equal shares."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    letters = sorted(set("".join(ALPHABETS.values())) | set("-_"))
    found = documents.agg(*[F.sum((F.octet_length(t) - F.octet_length(F.replace(t, F.lit(c), F.lit("")))).cast("long")).alias(f"c{i}") for i, c in enumerate(letters)]).first()  # one row
    n = {c: found[i] or 0 for i, c in enumerate(letters)}
    n["+"], n["/"] = n["+"] + n["-"], n["/"] + n["_"]
    out = {}
    for name, alphabet in ALPHABETS.items():
        total = sum(n[c] for c in alphabet)
        shares = [n[c] / total if total else 1 / len(alphabet) for c in alphabet]
        out[name] = (sum(q**2 for q in shares), sum(q**3 for q in shares))
    return out


def _battery(run: Column, shares: dict[str, tuple[float, float]]) -> Column:
    """struct(p_random, nlog): the battery's p-value and -log10 of the chi-squared statistic's p-value in ordinary text."""
    core = F.regexp_replace(F.translate(run, "-_", "+/"), "=+$", "")
    return bind(core, lambda s: _tests(s, shares))


def _tests(s: Column, shares: dict[str, tuple[float, float]]) -> Column:
    name = (
        F.when(s.rlike("^[0-9a-f]+$"), "hex")
        .when(s.rlike("^[0-9A-F]+$"), "HEX")
        .when(s.rlike("^[A-Z2-7]+$"), "base32")
        .when(s.rlike("^[0-9a-z]+$"), "base36")
        .otherwise("base64")
    )
    of_alphabet = F.element_at(F.create_map(*[x for k, v in ALPHABETS.items() for x in (F.lit(k), F.struct(F.lit(v).alias("letters"), *[F.lit(y).alias(f"s{i}") for i, y in zip((2, 3), shares[k], strict=True)]))]), name)

    def with_alphabet(a: Column) -> Column:
        k = F.length(a.letters).cast("double")
        codes = F.transform(F.split(s, ""), lambda c: F.call_function("instr", a.letters, c).cast("double"))
        return bind(codes, lambda xs: with_codes(xs, k, a.s2, a.s3))

    def with_codes(xs: Column, k: Column, s2: Column, s3: Column) -> Column:
        n = F.size(xs).cast("double")
        squares = F.aggregate(F.array_distinct(xs), F.lit(0.0), lambda t, c: t + F.pow(F.size(F.filter(xs, lambda x: x == c)).cast("double"), F.lit(2.0)))
        chi, free = squares * k / n - n, k - 1
        z1 = (F.pow(F.greatest(chi, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        high = F.size(F.filter(xs, lambda x: x > k / 2)).cast("double")
        low = n - high
        changes = F.size(F.filter(F.transform(xs, lambda x, i: (x > k / 2) != (F.get(xs, i + 1) > k / 2)), lambda b: b)).cast("double")
        expect = 2 * high * low / n + 1
        spread = F.sqrt(F.greatest((expect - 1) * (expect - 2) / (n - 1), F.lit(1e-9)))
        z2 = F.when((high == 0) | (low == 0), F.lit(9.0)).otherwise((changes + 1 - expect) / spread)
        mean = F.aggregate(xs, F.lit(0.0), lambda t, x: t + x) / n
        var = F.aggregate(xs, F.lit(0.0), lambda t, x: t + (x - mean) * (x - mean))
        lag = F.aggregate(F.transform(xs, lambda x, i: (x - mean) * (F.get(xs, i + 1) - mean)), F.lit(0.0), lambda t, x: t + F.coalesce(x, F.lit(0.0)))
        z3 = F.when(var <= 0, F.lit(9.0)).otherwise(lag / var * F.sqrt(n))
        p = F.least(F.lit(1.0), 3 * F.least(*[2 * normal_tail(z) for z in (z1, z2, z3)]))
        # the sum of squared counts stands for chi-squared; its first two moments for letters of the text's shares
        usual = n + n * (n - 1) * s2
        spread = F.sqrt(F.greatest(2 * n * (n - 1) * (s2 + 2 * (n - 2) * s3 - (2 * n - 3) * s2 * s2), F.lit(1e-9)))
        z = (squares - usual) / spread
        nlog = F.when(z >= 0, F.lit(0.0)).otherwise(-F.log10(F.greatest(normal_tail(z), F.lit(1e-300))))
        return F.struct(p.alias("p_random"), nlog.alias("nlog"))

    return bind(of_alphabet, with_alphabet)


def _scanned(documents: DataFrame, keep: list[str], least: int, alpha: float, fdr: float) -> DataFrame:
    """kept (a struct of the columns keep), base and added."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    shares = letter_shares(documents)
    run = rf"[A-Za-z0-9+/_=-]{{{least},}}"
    spans = F.concat(_placed(F.col("t"), ASSIGN, 0, 2), _placed(F.col("t"), ACCESS, 1), _placed(F.col("t"), HEX, 2))
    found = (
        documents.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), text.alias("t"))
        .select("kept", F.filter(spans, lambda x: (x.kind != 1) | (x.end - x.start >= 16)).alias("base"), _placed(F.col("t"), run, 3).alias("runs"))
        .withColumn("runs", F.filter("runs", lambda r: ~F.exists("base", lambda b: (b.start < r.end) & (r.start < b.end))))
        .withColumn("runs", F.transform("runs", lambda r: F.struct(r.start.alias("start"), r.kind.alias("kind"), r.end.alias("end"), _battery(r.match, shares).alias("t"))))
    )
    bare = "transform(base, x -> struct(x.start, x.kind, x.end))"
    found = scratch(found.withColumn("base", F.array_sort(F.expr(bare))).select("kept", "base", "runs"))
    band = lambda n: sum((F.when(n >= b, 1).otherwise(0) for b in BANDS), F.lit(0))
    bins = lambda x: F.floor(x.t.nlog / _BIN).cast("int")
    # at most len(BANDS) + 1 bands of at most 400 bins, with map-side counts
    cells = found.select(F.explode("runs").alias("r")).groupBy(band(F.col("r.end") - F.col("r.start")).alias("band"), F.when(F.col("r.t.p_random") >= alpha, F.least(bins(F.col("r")), F.lit(400))).otherwise(-1).alias("bin")).count()
    down = Window.partitionBy("band").orderBy(F.desc("bin"))
    everyone = Window.partitionBy("band")
    limits = (
        cells.withColumn("m", F.sum("count").over(everyone))
        .withColumn("above", F.sum("count").over(down))
        .where((F.col("bin") >= 0) & (F.col("m") * F.pow(F.lit(10.0), -F.col("bin") * _BIN) <= fdr * F.col("above")))
        .groupBy("band")
        .agg(F.min("bin").alias("bin"))
        .agg(F.map_from_entries(F.collect_list(F.struct("band", "bin"))).alias("limits"))  # one row
    )
    declared = lambda r: (r.t.p_random >= alpha) & (bins(r) >= F.coalesce(F.try_element_at(F.col("limits"), band(r.end - r.start)), F.lit(1 << 30)))
    added = F.transform(F.filter("runs", declared), lambda r: F.struct(r.start.alias("start"), r.kind.alias("kind"), r.end.alias("end")))
    return found.crossJoin(F.broadcast(limits)).select("kept", "base", F.array_sort(added).alias("added"))


def scan_secrets(documents: DataFrame, keep: list[str] | None = None, least: int = 20, alpha: float = 0.01, fdr: float = 0.01) -> DataFrame:
    """keep columns, base and added: arrays of (start, kind, end), sorted.

    One row for each row of documents, repeated rows and ids too; null or
    empty text has no spans, an empty table no rows. kind numbers KINDS. Added
    spans never touch base spans. A very long text is one row throughout; only
    candidates (runs of key characters) leave the scan. Columns of documents
    may have any names; kept ones named base or added give way to the result.
    """
    keep = [c for c in keep or ["doc_id"] if c.lower() not in ("base", "added")]
    return _scanned(documents, keep, least, alpha, fdr).select(*[F.col("kept").getField(c).alias(c) for c in keep], "base", "added")


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x.kind), x.start.cast("string"), x.end.cast("string"))), ",")


def _count(kind: int) -> Column:
    return F.size(F.filter("base", lambda x: x.kind == kind)).cast("long")


def op5(spark, sf_dir) -> DataFrame:
    """Counts and digests of the secrets of each document."""
    out = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(
        "doc_id",
        _count(0).alias("n_assign"),
        _count(1).alias("n_access"),
        _count(2).alias("n_hex"),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


def redact(documents: DataFrame, mark: str = "<secret>", least: int = 20, alpha: float = 0.01, fdr: float = 0.01) -> DataFrame:
    """The documents with every found span replaced by mark; other columns unchanged.

    Null text stays null and empty text empty; each row, repeated or not and
    with or without an id, is judged on its own text. Columns may have any names.
    """
    names = documents.columns
    found = _scanned(documents, names, least, alpha, fdr)
    text = F.col("kept").getField("text")

    def cut(spans: Column) -> Column:
        # spans in order; of overlapping ones the union goes
        first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

        def add(acc: Column, x: Column) -> Column:
            fresh = F.when(x.start >= acc.at, F.concat(acc.out, F.substring(text, acc.at + 1, x.start - acc.at), F.lit(mark))).otherwise(acc.out)
            return F.struct(F.greatest(acc.at, x.end).alias("at"), fresh.alias("out"))

        return F.aggregate(spans, first, add, lambda acc: F.concat(acc.out, F.substring(text, acc.at + 1, 1 << 30)))

    spans = F.array_sort(F.concat("base", "added"))
    clean = F.when(F.size("base") + F.size("added") == 0, text).otherwise(bind(spans, cut))
    return found.select(*[clean.alias(c) if c == "text" else F.col("kept").getField(c).alias(c) for c in names])

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from quorate.llm import common, ngram_join, rk_dedup, sa_dedup
from quorate.llm.common import components


def frame(spark, rows):
    """Rows (doc_id, text) with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], "doc_id long, text string, h string, start int, sid int").repartition(3)


def words(rng, n, size=400):
    return " ".join(rng.choice([f"w{i}" for i in range(size)]) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    base = [words(rng, rng.choice([3, 5, 12, 13, 40, 200, 900])) for _ in range(40)]
    passage = words(rng, 60)
    rows = list(enumerate(base))
    for i in range(60):  # near copies, some of copies
        w = rng.choice(rows)[1].split()
        for _ in range(rng.choice([0, 1, 2, 6])):
            w[rng.randrange(len(w))] = f"e{rng.randrange(1000)}"
        rows.append((100 + i, " ".join(w)))
    rows += [(300 + i, words(rng, 30) + " " + passage + " " + words(rng, 30)) for i in range(25)]
    rows += [(400 + i, base[5]) for i in range(30)]
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "one"), (504, "ONE"), (505, "a b c d"), (506, "é É"), (507, "a " * 300)]
    return rows


def brute_components(rows, width=5, percent=80):
    sets = {}
    for d, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
        sets[d] = {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = list(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b]:
                same = len(sets[a] & sets[b])
                if 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


@pytest.mark.parametrize("options", [{}, {"heavy": 2, "share": 1}, {"boundary": 0}, {"boundary": 40}, {"boundary": 10**6}])
def test_join_equals_all_pairs(spark, corpus, options):
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_components(frame(spark, corpus), **options).collect()}
    assert out == brute_components(corpus)


def test_join_on_a_chain(spark):
    rng = random.Random(1)
    w, rows = [f"t{i}" for i in range(200)], []
    for i in range(40):  # neighbours link, far ones do not
        w = w[3:] + [f"n{i}-{k}" for k in range(3)]
        rows.append((i, " ".join(w)))
    rng.shuffle(rows)
    out = {r.doc_id: r.component_id for r in ngram_join.similar_components(frame(spark, rows)).collect()}
    assert set(out.values()) == {0}


def test_join_repeated_ids_and_nulls(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "q r s t u v"), (3, "a b c d e f")]
    out = sorted((str(r.doc_id), str(r.component_id)) for r in ngram_join.similar_components(frame(spark, rows)).collect())
    assert out == [("1", "1"), ("1", "1"), ("3", "1"), ("None", "1"), ("None", "None")]
    assert ngram_join.similar_components(frame(spark, rows).limit(0)).count() == 0


def test_sets_of_one_shingle_under_a_boundary(spark):
    import numpy as np

    rng = random.Random(3)
    for short in ("one", "a b c d e"):
        texts = [words(rng, 14), short, words(rng, 12), short + " x"[: 2 * (short == "one")]]
        rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
        out = ngram_join._postings(rows, 5, 80, 15, np.zeros(16, np.uint64)).collect()
        assert {r.n for r in out} == {8, 10}  # a set of one shingle links to its equals only: it has no pair
        want = sum(p * (p - 1) // 2 for p in (8 - 7 + 2, 10 - 8 + 2))
        assert len(out) == want


def test_boundary_follows_cost():
    rows = [(False, 10, 30, 0.0), (False, 13, 3, 0.0), (False, 200, 410, 0.0), (True, 10, 60, 0.0), (True, 13, 6, 0.0), (True, 200, 8000, 0.0)]
    assert ngram_join.choose_boundary(rows, 16, 80, 8.0) == 0  # lists meet nobody
    rows[0] = (False, 10, 30, 20.0)
    assert ngram_join.choose_boundary(rows, 16, 80, 8.0) == 13  # sets of 13 write lists too, those of 10 only subsets


def test_both_paths_run_on_the_documents(spark):
    """The measured boundary puts some classes on each path."""
    from quorate.llm.common import Tables

    docs = ngram_join._docs(spark.read.parquet(f"{DATA}/documents.parquet"))
    want = {(r.doc_id, r.component_id) for r in ngram_join.similar_components(docs).collect()}
    sizes = [r.n_shingles for r in ngram_join.similar_components(docs).collect()]
    for boundary in (0, 15, 10**6):
        assert any(n > boundary for n in sizes) == (boundary < 10**6) and any(0 < n <= boundary for n in sizes) == (boundary > 0)
        with Tables(spark) as tables:
            out = ngram_join._components_of(docs, tables, 5, 80, 16, 8, 8.0, boundary).collect()
        assert {(r.doc_id, r.component_id) for r in out} == want


@pytest.mark.parametrize("local", [4_000_000, 7])
def test_components(spark, local):
    from quorate.llm.common import Tables

    links = [(i, i + 1) for i in range(50)] + [(100, 101), (102, 101), (7, 7)]
    with Tables(spark) as tables:
        out = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long").repartition(9), tables, local).collect()}
        assert out == {i: 0 for i in range(51)} | {100: 100, 101: 100, 102: 100}
        assert components(spark.createDataFrame([], "a long, b long"), tables, local).count() == 0


def brute_windows(rows, width=13):
    low = {}
    texts = [(d, (t or "").split()) for d, t in rows]
    for d, w in texts:
        for i in range(len(w) - width + 1):
            k = tuple(w[i : i + width])
            low[k] = min(low.get(k, d), d)
    out = {}
    for d, w in texts:
        gone = {j for i in range(len(w) - width + 1) if low[tuple(w[i : i + width])] < d for j in range(i, i + width)}
        out[d] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    return out


def test_windows_equal_brute_force(spark, corpus):
    out = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in rk_dedup.remove_repeats(frame(spark, corpus)).collect()}
    assert out == brute_windows(corpus)


def test_a_full_bitmap_changes_nothing(spark, corpus):
    out = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in rk_dedup.remove_repeats(frame(spark, corpus), bits=6).collect()}
    assert out == brute_windows(corpus)


def test_windows_repeated_ids_and_nulls(spark):
    t = words(random.Random(2), 40)
    rows = [(1, t), (1, t), (2, t), (None, t), (None, None)]
    out = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in rk_dedup.remove_repeats(frame(spark, rows)).collect())
    assert out == [("1", 40, 0), ("1", 40, 0), ("2", 40, 40), ("None", 0, 0), ("None", 40, 40)]
    assert rk_dedup.remove_repeats(frame(spark, rows).limit(0)).count() == 0


def test_intervals_are_maximal(spark, corpus):
    for r in rk_dedup.remove_repeats(frame(spark, corpus)).collect():
        ends = [(x.start, x.end) for x in r.intervals]
        assert all(b < c for (_, b), (c, _) in zip(ends, ends[1:])) and sum(b - a for a, b in ends) == r.n_removed


@pytest.mark.parametrize("most", [200_000, 3])
def test_bytes_equal_brute_force(spark, corpus, most):
    rows = corpus + [(600, "ab" * 500), (601, "x" * 199), (602, "x" * 300), (603, "q" * 100 + "é" * 250), (604, "é" * 250 + "r" * 100)]
    out = sa_dedup.remove_repeated_bytes(frame(spark, rows), most=most).select("doc_id", "n_bytes", "n_removed", F.size("removed").alias("n"), F.sha2("kept", 256).alias("h"))
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n, r.h) for r in out.collect()} == sa_dedup.brute_force(dict(rows))


def test_bytes_repeated_ids_and_nulls(spark):
    t = words(random.Random(3), 100)
    rows = [(1, t), (1, t), (None, "z" * 150 + "y" * 149), (None, None)]
    out = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in sa_dedup.remove_repeated_bytes(frame(spark, rows)).collect())
    n = len(t)
    assert out == [("1", n, n), ("1", n, n), ("None", 0, 0), ("None", 299, 0)]


def test_suffix_query(spark):
    from quorate.llm.registry import QUERIES

    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    out = {r.doc_id: tuple(r)[1:] for r in QUERIES["op10_suffix_dedup"](spark, DATA).collect()}
    assert out == sa_dedup.brute_force(rows)


def test_pairs_that_meet_too_seldom_are_no_candidates(spark, monkeypatch):
    """Texts around the threshold: all pairs lost by the number of common lists are no links."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words[: rng.choice([100, 120])]))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    kept = []
    often = ngram_join._often

    def counted(pairs, percent, boundary):
        out = often(pairs, percent, boundary)
        kept.append((out.count(), ngram_join._near(pairs, percent).count()))
        return out

    monkeypatch.setattr(ngram_join, "_often", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in ngram_join.similar_components(df, boundary=0).collect()}
    root = list(range(150))
    for a in range(150):
        for b in range(a):
            same = len(sets[a] & sets[b])
            if 100 * same >= 80 * (len(sets[a]) + len(sets[b]) - same):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    assert found == dict(enumerate(root)) and kept and sum(x for x, _ in kept) < sum(y for _, y in kept)


def test_a_round_leaves_no_tables_behind(spark, corpus, monkeypatch):
    """Pairs, forms and links of a round go with it; older components and lists too."""
    left = []

    class Watched(ngram_join.Tables):
        def __exit__(self, *error):
            left.append(len(self.paths))
            super().__exit__(*error)

    monkeypatch.setattr(ngram_join, "Tables", Watched)
    d = frame(spark, corpus)
    assert {r.doc_id: r.component_id for r in ngram_join.similar_components(d, boundary=0).collect()} == {k: v[1] for k, v in brute_components(corpus).items()}
    assert len(left) > 2 and left[-1] <= 9  # six tables for all rounds, the components, what is left of the lists, and its last form


def test_little_stands_beside_the_postings(spark, corpus, monkeypatch):
    """Shuffles go with what made them, without a collection of garbage, and tables once nothing reads them."""

    def shuffles():
        return set(re.findall(r"shuffle_(\d+)_", spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")))

    class Watched(ngram_join.Tables):
        def __enter__(self):
            opened.append(self)
            return super().__enter__()

    def lists(*args):
        beside.append([spark.read.parquet(p).columns for p in opened[0].paths])
        return plain_lists(*args)

    def forms(*args):
        end = time.time() + 20
        while not left and shuffles() - before and time.time() < end:  # Spark deletes the files beside the run
            time.sleep(0.1)
        left.append(shuffles() - before)
        return plain_forms(*args)

    opened, beside, left, plain_lists, plain_forms = [], [], [], ngram_join._lists, ngram_join._forms
    for module, name, new in ((ngram_join, "Tables", Watched), (ngram_join, "_lists", lists), (ngram_join, "_forms", forms), (ngram_join, "release", lambda spark: None), (common, "ease", lambda spark: None)):
        monkeypatch.setattr(module, name, new)
    d, key = frame(spark, corpus), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(key, None), shuffles()
    assert {r.doc_id: r.component_id for r in ngram_join.similar_components(d).collect()} == {k: v[1] for k, v in brute_components(corpus).items()}
    assert left[0] == set() and spark.conf.get(key, None) == setting
    assert beside == [[["doc_id", "n_shingles", "sid"], ["h", "n"]]]

import numpy as np
import pytest
from pyspark.sql import functions as F

from quorate.operators import clustering, consensus, graph, history, linking, lookup, releases, tiles


def test_vote_ignores_row_order(spark):
    target = spark.createDataFrame([(1, 10, 20, 30), (2, 11, None, 31), (3, None, None, None)], "id int, a int, b int, c int")
    rows = {"a": [(10, "x "), (11, None)], "b": [(20, "y")], "c": [(30, "y"), (31, "z"), (31, "q")]}
    for flip in (1, -1):
        sources = {k: spark.createDataFrame(v[::flip], "id_raw int, name string") for k, v in rows.items()}
        out = consensus.vote(target, sources, {k: k for k in rows}, "name", "won").orderBy("id").collect()
        assert [r.won for r in out] == ["y", "q", None]


def test_accretion_keys(spark):
    seed = spark.createDataFrame([(1, None, "a"), (2, 7, "b")], "x int, y int, name string")
    new = spark.createDataFrame([(1, 9, "n"), (3, 8, "b"), (4, None, "c"), (None, None, "d")], "x int, y int, name string")
    out = linking.accrete(seed, [(new, ["x", "y", "name"], "x")]).orderBy(F.col("name")).collect()
    assert [(r.x, r.y, r.name) for r in out] == [(1, 9, "a"), (2, 7, "b"), (4, None, "c"), (None, None, "d")]


def test_merge_keeps_the_most_complete(spark):
    rows = spark.createDataFrame([("k", 1, None, 5), ("k", 2, "v", 3), ("m", 3, None, None)], "k string, id int, v string, pop int")
    out = {r.k: r for r in consensus.merge_duplicates(rows, "k", largest=["pop"], tie=["id"]).collect()}
    assert (out["k"].id, out["k"].pop, out["m"].id) == (2, 5, 3)


def test_dedupe_orders_nulls_last(spark):
    rows = spark.createDataFrame([(1, "n", True, None, ["a"]), (2, "n", True, 1, ["b"]), (3, "n", False, 0, ["c"])], "id int, name string, accepted boolean, syn int, by array<string>")
    out = {r.id: r for r in consensus.dedupe_by(rows, "name", [F.col("syn").asc_nulls_last(), F.col("id")], lists=["by"]).collect()}
    assert len(out) == 3 and [out[i].accepted for i in (1, 2, 3)] == [False, True, False] and out[2].by == ["a", "b"]


def test_closure_with_cycle_and_self_edge(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 4), (5, 4), (6, None)], "c int, p int")
    out = {(r.child, r.ancestor): r.level for r in graph.closure(edges, "c", "p").collect()}
    assert out[1, 3] == 2 and out[5, 4] == 1 and (4, 4) not in out and all(a != b for a, b in out)


def test_cascade_stops(spark):
    rows = spark.createDataFrame([(1, None, False, []), (2, 1, False, []), (3, 2, True, ["a"]), (4, 9, True, ["b"])], "id int, up int, ok boolean, by array<string>")
    out = {r.id: (r.ok, r.by) for r in graph.cascade_up(rows, "id", "up", "ok", "by").collect()}
    assert out == {1: (True, ["a"]), 2: (True, ["a"]), 3: (True, ["a"]), 4: (True, ["b"])}


def test_rollup_keeps_mass(spark):
    values = spark.createDataFrame([(1, 5), (2, 7), (2, 1)], "n int, v int")
    edges = spark.createDataFrame([(1, 3), (2, 3), (3, 4), (4, 4)], "c int, p int")
    out = {r.n: r.v for r in graph.rollup(values, edges, "n", "c", "p", [], ["v"]).collect()}
    assert out == {1: 5, 2: 8, 3: 13, 4: 13}


def test_guarded_tiles_keep_heavy_ones_apart(spark):
    seeds = spark.createDataFrame([(1, 9, 0.0, 0.0, 60_000), (2, 9, 1.0, 1.0, 10), (3, 9, 2.0, 2.0, 20)], "e int, tile long, lng double, lat double, n long")
    edges = spark.createDataFrame([(1, 7), (2, 7), (3, 7)], "c int, p int")
    out = tiles.guarded_rollup(seeds, edges, "e", "c", "p").where("e = 7").orderBy("n").collect()
    assert [(r.n, r.lng) for r in out] == [(30, 2.0), (60_000, 0.0)]
    merged = tiles.guarded_rollup(seeds, edges, "e", "c", "p", merge=True).where("e = 7").collect()
    assert [r.n for r in merged] == [60_030]


def test_coarsen_keeps_mass(spark):
    rows = spark.createDataFrame([(1, x * 1024 + y, float(x), float(y), 1) for x in range(8) for y in range(8)] + [(2, 5, 0.0, 0.0, 3)], "e int, tile long, lng double, lat double, n long")
    out = tiles.coarsen(rows, "e", most=20).groupBy("e").agg(F.sum("n").alias("n"), F.count("*").alias("tiles")).orderBy("e").collect()
    assert [(r.n, r.tiles) for r in out] == [(64, 16), (3, 1)]


def test_weighted_median_and_null_bins(spark):
    bins = spark.createDataFrame([(1, 0, 1), (1, 100, 3), (1, None, 50), (2, None, 4)], "e int, bin int, n int")
    assert [(r.e, r.median) for r in tiles.weighted_median(bins, "e").collect()] == [(1, 100)]


def test_representatives():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(c, 0.5, (40, 2)) for c in ((0, 0), (40, 0), (0, 40))])
    out = clustering.representatives(points, np.ones(len(points)))
    assert len(out) == 3 and all((points == p).all(1).any() for p in out)
    assert min(np.linalg.norm(a - b) for i, a in enumerate(out) for b in out[:i]) > 9
    assert len(clustering.representatives(points[:2], np.ones(2))) == 2


def test_spellings(spark):
    rows = spark.createDataFrame([(1, "en", n) for n in ("Starfruit", "starfruits", "star fruit", "starfruit", "carambola", "own")] + [(1, "fr", "carambole"), (2, "en", None)], "id int, lang string, name string")
    out = clustering.cluster_strings(rows, "id", "lang", "name", own=F.lit("OWN")).collect()
    assert len(out) == 1 and out[0].vernacular == {"en": ["starfruit", "carambola"], "fr": ["carambole"]} and out[0].common_name == "starfruit"


@pytest.mark.parametrize(
    ("page", "item", "low", "high", "want"),
    [(1850, None, None, None, 1850), (1200, None, 1100, 1300, 1200), (None, 1500, 1400, 1550, 1500), (53, None, 1750, 1760, 1753), (53, None, 1700, 1900, None), (None, 53, 1750, 1760, 1753), (None, 1700, None, None, 1700), (None, None, None, None, None)],
)
def test_year_ladder(spark, page, item, low, high, want):
    rows = spark.createDataFrame([(page, item, low, high)], "p int, i int, a int, b int")
    assert rows.select(history.reconcile_year(F.col("p"), F.col("i"), F.col("a"), F.col("b"), F.lit(2025)).alias("y")).first().y == want


def test_diff_finds_moved_keys(spark):
    prev = spark.createDataFrame([(1, "a", True), (2, "b", True), (3, "c", True), (4, "d", None), (5, "e", True), (6, "e", True)], "id int, v string, ok boolean")
    cur = spark.createDataFrame([(1, "a", True), (2, None, True), (9, "c", True), (7, "e", True), (8, "e", True)], "id int, v string, ok boolean")
    out = {r.id: (r.old_key, r.kind, r.fields) for r in releases.diff(cur, prev, "id", ["v"], scope="ok").collect()}
    assert out[9] == (3, "changed", ["id"]) and out[2][1:] == ("changed", ["v"]) and 1 not in out and 4 not in out and 3 not in out
    assert {out[i][1] for i in (7, 8)} == {"new"} and {out[i][1] for i in (5, 6)} == {"deleted"}


def test_checks_report_skips(spark):
    rows = spark.createDataFrame([(1,)], "x int")
    checks = [releases.Check("a", lambda d: d.where("x > 5")), releases.Check("b", lambda d: d.where("x = 1")), releases.Check("c", lambda d: d.where("x = 1"), "any"), releases.Check("d", lambda d: d.where("y = 1"))]
    assert {r["check"]: r.status for r in releases.run_checks(rows, checks).collect()} == {"a": "passed", "b": "failed", "c": "passed", "d": "skipped"}


def test_update_and_redirect(spark):
    target = spark.createDataFrame([(1, None), (2, "y"), (3, "z")], "k int, v string")
    source = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (None, "n")], "k int, v string")
    assert [r.v for r in lookup.update_from(target, source, "k", ["v"]).orderBy("k").collect()] == ["a", None, "z"]
    assert [r.v for r in lookup.update_from(target, source, "k", ["v"], fill_only=True).orderBy("k").collect()] == ["a", "y", "z"]
    history_ = spark.createDataFrame([(100, [1, 2]), (200, [2])], "cur int, old array<int>")
    assert [r.k for r in lookup.redirect(target, "k", history_, "cur", "old").orderBy("v").collect()] == [100, 100, 3]


def test_enrich_in_requests(spark):
    rows = spark.createDataFrame([(f"t{i}",) for i in range(45)] + [(None,)], "title string").coalesce(1)
    out = clustering.enrich(rows, "title", lambda keys: {k: f"{k}:{len(keys) <= 20}" for k in keys if k != "t3"}).collect()
    assert len(out) == 45 and {r.value for r in out if r.title == "t3"} == {None} and all(r.value.endswith("True") for r in out if r.value)


def test_levels_beyond_the_limit_fail(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(6)], "c int, p int")
    values = spark.createDataFrame([(0, 1)], "n int, v int")
    assert graph.closure(chain, "c", "p", levels=6).count() == 21
    assert graph.rollup(values, chain, "n", "c", "p", [], ["v"], levels=6).count() == 7
    for call in (lambda: graph.closure(chain, "c", "p", levels=5), lambda: graph.rollup(values, chain, "n", "c", "p", [], ["v"], levels=5)):
        with pytest.raises(RuntimeError):
            call()


def test_cascade_reaches_the_top_of_a_long_chain(spark):
    rows = spark.createDataFrame([(i, i - 1 if i else None, i == 24, ["x"] if i == 24 else []) for i in range(25)], "id int, up int, ok boolean, by array<string>")
    assert graph.cascade_up(rows, "id", "up", "ok", "by").where("ok").count() == 25


def test_prefix_parent_takes_the_longest(spark):
    rows = [(1, "h", "/"), (2, "h", "/a"), (3, "h", "/a/b"), (4, "h", "/a/b/c"), (5, "g", "/a/b"), (6, "h", None), (7, "h", ""), (8, "h", "/a")]
    df = spark.createDataFrame(rows, "id int, host string, path string")
    out = {r.id: r.parent for r in lookup.prefix_parent(df, df, "host", "path", "id").collect()}
    assert out == {1: 7, 2: 1, 3: 2, 4: 3, 8: 1}


def test_fan_out_guard_fails_and_changes_are_counted(spark):
    look = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "d")], "k long, v string")
    assert lookup.require_unique(look, "k").count() == 4
    with pytest.raises(ValueError, match=r"k is not unique: 2 \(3 rows\)"):
        lookup.require_unique(look.unionByName(look.where("k = 2")).unionByName(look.where("k = 2")), "k")
    target = spark.createDataFrame([(1, "a", 1), (2, None, 2), (3, "c", 3)], "k long, v string, w int")
    after = lookup.update_from(target, spark.createDataFrame([(1, "a"), (2, "x"), (4, "y")], "k long, v string"), "k", ["v"])
    assert lookup.changed_rows(target, after, "k", ["v", "w"]) == 1
    assert lookup.changed_rows(target, target, "k", ["k", "v", "w"]) == 0


def joined_rows(df):
    """df's rows, and the most rows that one of its joins made."""
    rows = df.collect()
    most, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if "Join" in name:
                most = max(most, node.metrics().apply("numOutputRows").value())
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return rows, most


def test_orphans_of_one_name_do_not_meet_in_pairs(spark):
    rows = [(i, None, "red", "genus", "a", i % 5 > 0, i % 7) for i in range(600)] + [(i, None, "red ring", "species", "a", True, None) for i in range(600, 1200)] + [(2000, None, "red ring", "species", None, True, 9)]
    df = spark.createDataFrame(rows, "id long, parent long, name string, rank string, g string, ok boolean, n int")
    found, most = joined_rows(graph.link_orphans(df, "id", "parent", "name", "rank", "g", "ok", F.col("n")))
    best = min((r for r in rows[:600] if r[5]), key=lambda r: (-r[6], r[0]))[0]
    assert {r.id: r.parent for r in found} == {r[0]: best if 600 <= r[0] < 2000 else None for r in rows} and most <= 2 * len(rows)
    own = spark.createDataFrame([(1, None, "red ring", "genus", "a", True, 5), (2, None, "red", "genus", "a", True, 9), (3, None, "red", "genus", "a", True, 9)], df.schema)
    assert {r.id: r.parent for r in graph.link_orphans(own, "id", "parent", "name", "rank", "g", "ok", F.col("n")).collect()} == {1: 2, 2: None, 3: None}
    selves = spark.createDataFrame([(k, None, "red ring x", "Species", "a", True, 9 - k) for k in (1, 2, 3)] + [(4, None, "red ring", "species", "a", True, 1)], df.schema)
    assert {r.id: r.parent for r in graph.link_orphans(selves, "id", "parent", "name", "rank", "g", "ok", F.col("n")).collect()} == {1: 4, 2: 4, 3: 4, 4: None}


def test_canonical_rows_of_one_name_do_not_fan_out(spark):
    sources = spark.createDataFrame([(i, i % 3, "a") for i in range(400)] + [(900, 7, "b"), (901, None, "a")], "id long, parent_raw long, kingdom string")
    records = spark.createDataFrame([(0, "x"), (0, "x"), (1, "x"), (2, "y")], "id_raw long, name string")
    canonical = spark.createDataFrame([(1000 - i, "x", "a", i < 300) for i in range(400)], "id long, name string, kingdom string, accepted boolean")
    found, most = joined_rows(consensus.canonical_parents(sources, records, canonical))
    assert {r.id: r.parent for r in found} == {i: 2 if i % 3 == 2 else 701 for i in range(400)} | {900: 7, 901: None} and most <= 402


def test_free_rows_of_one_name_do_not_fan_out(spark):
    target = spark.createDataFrame([(i, "x", None) for i in range(300)] + [(900, "x", 5), (901, "y", None), (902, None, None)], "id long, name string, ref long")
    reference = spark.createDataFrame([(i, "x", None if i % 9 == 0 else i % 50) for i in range(300)] + [(None, "x", 99)], "ref long, name string, pop int")
    found, most = joined_rows(linking.link_by_name(target, reference, "name", "pop", "ref"))
    assert {r.id: r.ref for r in found} == {i: 49 for i in range(300)} | {900: 5, 901: None, 902: None} and most <= 303

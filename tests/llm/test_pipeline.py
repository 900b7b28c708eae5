import corpus_pipeline
from conftest import DATA
from quorate.llm import decontam, ngram_join


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, kept = docs.columns, [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, DATA).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        kept.append(docs.count())
        if name != "byte_level_bpe":
            assert docs.columns == columns
        if name == "ngram_jaccard_join":
            groups = {r.component_id for r in ngram_join.similar_components(before).collect()}
            assert {r.doc_id for r in docs.collect()} == groups
        if name == "benchmark_decontamination":
            assert decontam.find_leaks(docs, spark.read.parquet(f"{DATA}/benchmark.parquet")).count() == 0
        if name == "secret_scans":
            assert docs.where("text LIKE '%<secret>%'").count() > 0 or before.where("text RLIKE 'AKIA[A-Z0-9]{12}'").count() == 0
    assert kept[0] > kept[1] > kept[2] >= kept[3] == kept[4] == kept[5] > 0


def test_run_equals_its_stages(spark):
    out = corpus_pipeline.run(spark, DATA).collect()
    assert out and out[0].asDict().keys() == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} and len({r.doc_id for r in out}) == len(out)


def test_empty_input(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
        assert docs.count() == 0


def test_rows_without_an_id_or_with_a_shared_one(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    good, bad = " ".join(f"word{i} of a clean text" for i in range(40)), "too short"
    rows = [(None, good), (None, bad), (10**9, good + " one"), (10**9, bad), (None, None), (10**9 + 1, "")]
    odd = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.quality(spark, docs.unionByName(odd).unionByName(odd.limit(1)), DATA).where("doc_id IS NULL OR doc_id >= 1000000000").collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in out))) == sorted(map(repr, [(None, good), (None, good), (10**9, good + " one")]))


def test_decontamination_counts_every_passage(spark, tmp_path, monkeypatch):
    """The stage's SVD is fitted on all passages of what reaches it, not on a sample."""
    seen, plain = [], decontam._unpacked
    monkeypatch.setattr(decontam, "_unpacked", lambda n, b, v: seen.append((b, plain(n, b, v))) or plain(n, b, v))
    docs = spark.createDataFrame([(i, f"alpha beta w{i}") for i in range(20_000)], "doc_id long, text string")
    spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).count()
    assert [x[-1] for b, x in seen if b < 0] == [20_000]


def test_the_driver_gives_memory_back_before_each_stage(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(corpus_pipeline, "release", calls.append)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:4], 1):
        stage(spark, docs, DATA)
        assert len(calls) == n

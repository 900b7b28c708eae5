import gzip
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quorate.sources import readers, writers
from quorate.streaming import jobs


def test_text_formats(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('id\tname\n1\t"quoted\n2\tplain\n')
    assert [r.name for r in readers.tsv(spark, str(tmp_path / "a.tsv"), "id int, name string").orderBy("id").collect()] == ['"quoted', "plain"]
    (tmp_path / "b.csv").write_text("id|name\n1|x\nbad|y\n3|z\n")
    assert [r.id for r in readers.csv(spark, str(tmp_path / "b.csv"), "id int, name string", sep="|", lenient=True).orderBy("id").collect()] == [1, 3]
    (tmp_path / "c.dmp").write_text("1\t|\t2\t|\tfamily\t|\n3\t|\t\t|\tgenus\t|\n")
    assert [tuple(r) for r in readers.dump(spark, str(tmp_path / "c.dmp"), ["a", "b", "c"]).collect()] == [("1", "2", "family"), ("3", "", "genus")]
    (tmp_path / "d.json").write_text('{"id": 1, "m": {"P1": ["x"]}}\nnot json\n')
    assert readers.json_lines(spark, str(tmp_path / "d.json"), "id int, m map<string,array<string>>").where("id IS NOT NULL").count() == 1
    (tmp_path / "e.json").write_text('[{"id": 1}, {"id": 2}]')
    assert readers.json_array(spark, str(tmp_path / "e.json"), "id int").count() == 2
    with gzip.open(tmp_path / "f.json.gz", "wt") as f:
        f.write('[\n{"id": 1, "c": "P225"},\n{"id": 2, "c": "P31"},\n]\n')
    assert [r.id for r in readers.filtered_dump(spark, str(tmp_path / "f.json.gz"), "P225", "id int, c string").collect()] == [1]


def test_nested_archives(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "p"))
    part = next((tmp_path / "p").glob("*.parquet"))
    with zipfile.ZipFile(tmp_path / "inner.zip", "w") as z:
        z.write(part, "x/0001.parquet")
    with zipfile.ZipFile(tmp_path / "outer.zip", "w") as z:
        z.write(tmp_path / "inner.zip", "inner.zip")
    assert len(readers.unpack(str(tmp_path / "outer.zip"), ".parquet", str(tmp_path / "out"))) == 1


def test_versions_and_releases(spark, tmp_path):
    rows, base = spark.range(5), str(tmp_path)
    writers.write_versioned(rows, base, "src", "20240101")
    path = writers.write_versioned(rows.limit(2), base, "src", "20240202")
    assert [n for n in writers.names(spark, base) if n.startswith("src")] == ["src.20240202.parquet"] and spark.read.parquet(path).count() == 2
    a = writers.package_release(rows, f"{base}/r", {"x": "20240101", "y": "20240202"})
    assert a == writers.package_release(rows, f"{base}/r", {"y": "20240202", "x": "20240101"}) and a.startswith("20240202-")
    assert writers.find_release(spark, f"{base}/r") == a and writers.find_release(spark, f"{base}/r", before=a) is None
    assert writers.read_json(spark, f"{base}/r/{a}/manifest.json")["rows"] == 5
    assert writers.stale(None, "1") and not writers.stale("2", "1") and writers.stale("2", "1", force=True) and not writers.stale("1", None)
    table = f"{base}/t"
    rows.write.parquet(table)
    writers.rewrite(spark.read.parquet(table).where("id > 2"), table)
    assert spark.read.parquet(table).count() == 2


@pytest.mark.parametrize(("there", "want"), [(("old",), 5), (("old", "new"), 2), (("new",), 2), (("path", "old"), 5), (("path", "new"), 5), (("path", "part"), 5), (("old", "part"), 5)])
def test_a_swap_cut_half_way_is_ended(spark, tmp_path, there, want):
    """A driver lost between any two steps of a rewrite leaves all old or all new rows."""
    base = str(tmp_path / "t")
    rows = spark.range(5).selectExpr("id", "cast(id AS string) AS v", "1 AS ts")
    for name, path in (("path", base), ("old", f"{base}.old")):
        if name in there:
            rows.write.parquet(path)
    if "new" in there or "part" in there:
        rows.where("id < 2").write.parquet(f"{base}.new")
    if "part" in there:  # not written to its end
        (tmp_path / "t.new" / "_SUCCESS").unlink()
    writers.recover(spark, base)
    assert spark.read.parquet(base).count() == want
    writers.rewrite(spark.read.parquet(base).where("id < 1"), base)
    assert spark.read.parquet(base).count() == 1 and writers.names(spark, str(tmp_path)) == ["t"]


def test_stream_upsert_is_idempotent(spark, tmp_path):
    deltas, table = tmp_path / "deltas", str(tmp_path / "table")
    schema = "id int, v string, ts int"

    def put(n, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "one"))
        deltas.mkdir(exist_ok=True)
        next((tmp_path / "one").glob("*.parquet")).rename(deltas / f"{n}.parquet")

    def run(checkpoint):
        jobs.upsert_stream(jobs.read_deltas(spark, str(deltas), schema), table, "id", [F.col("ts").desc(), F.col("v")], str(tmp_path / checkpoint)).awaitTermination(60)
        return sorted(tuple(r) for r in spark.read.parquet(table).collect())

    put(1, [(1, "a", 1), (2, "b", 1), (1, "late", 0)])
    assert run("c1") == [(1, "a", 1), (2, "b", 1)]
    put(2, [(1, "new", 2), (3, "c", 1), (2, "old", 0)])
    want = [(1, "new", 2), (2, "b", 1), (3, "c", 1)]
    assert run("c1") == want
    assert run("c2") == want  # everything is delivered again


def test_stream_windows_equal_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    stream = spark.readStream.schema(events.schema).parquet("/root/testdata/sf0.001/events*.parquet")
    rows = jobs.windowed_counts(stream, "ts", ["event_type"], late="3650 days")
    q = rows.writeStream.format("memory").queryName("counts").outputMode("update").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.table("counts").collect())
    batch = events.withColumn("ts", F.col("ts").cast("timestamp")).groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n")).select("window.start", "event_type", "n")
    assert got == sorted(tuple(r) for r in batch.collect())


def test_stream_keeps_each_event_once(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.unionByName(events.limit(100)).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    q = jobs.distinct_events(stream, "event_id", "ts", "3650 days").writeStream.format("memory").queryName("once").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination(120)
    assert spark.table("once").count() == events.count()


def test_arrow_tables_are_read(spark):
    table = pa.table({"a": pa.array([1, None], pa.int64()), "b": [["x"], []]})
    assert [tuple(r) for r in readers.arrow(spark, table).orderBy("a").collect()] == [(None, []), (1, ["x"])]

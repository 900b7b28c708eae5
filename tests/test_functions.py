import uuid

import pytest
from pyspark.sql import functions as F

from quorate.functions import collections as C
from quorate.functions import geo, keys, text, vocabulary


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items()) or "x int"
    row = tuple(v for _, v in values.values()) or (1,)
    return spark.createDataFrame([row], schema).select(column.alias("v")).first().v


A = "array<string>"


@pytest.mark.parametrize(
    ("items", "want"),
    [(["a", "b", "b"], "b"), (["a", "b"], "a"), (["b", "a", "a", "b"], "b"), ([None, "x"], "x"), ([None], None), ([], None), (None, None)],
)
def test_first_mode(spark, items, want):
    assert one(spark, C.first_mode(F.col("a")), a=(A, items)) == want


def test_lists_and_nulls(spark):
    assert one(spark, C.list_append(F.col("a"), F.lit("x")), a=(A, None)) == ["x"]
    assert one(spark, C.list_concat(F.col("a"), F.col("b")), a=(A, None), b=(A, ["y"])) == ["y"]
    assert one(spark, C.list_concat(F.col("a"), F.col("b")), a=(A, None), b=(A, None)) is None
    assert one(spark, C.list_distinct(F.col("a")), a=(A, ["b", None, "a", "b"])) == ["a", "b"]
    assert one(spark, C.list_contains(F.col("a"), "z"), a=(A, ["b", None])) is False
    assert one(spark, C.list_any_value(F.col("a")), a=(A, [None, "q"])) == "q"
    assert one(spark, C.flatten(F.col("a")), a=("array<array<string>>", [["a"], None])) == ["a"]
    assert one(spark, C.ranked_distinct(F.col("a"), 2), a=(A, ["c", "b", "a", "b"])) == ["b", "a"]
    assert one(spark, C.true_wins(F.col("p"), F.col("q")), p=("boolean", False), q=("boolean", None)) is None
    assert one(spark, C.true_wins(F.col("p"), F.col("q")), p=("boolean", True), q=("boolean", None)) is True
    assert [one(spark, x, s=("string", "en:a:b")) for x in C.key_values(F.col("s"))] == ["en", "a"]


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("plantae:species:averrhoa.carambola:l.:1753", "39d0a0ff-4b49-5f9e-ad22-2b0030ee3d03"),
        ("plantae:species:comarum.palustre:l.:1753", "b2f0c3e6-94ae-56c7-8c2c-bfd7c3684ea7"),
        ("plantae:species:tetragonia.tetragonoides:(pall.) kuntze:1891", "6c589398-8031-552b-a790-18e91e691536"),
    ],
)
def test_golden_uuids(spark, name, want):
    assert one(spark, keys.uuid5(F.col("s")), s=("string", name)) == want


def test_uuid5_of_any_text(spark):
    for s in ("", "é × ü", "x" * 500):
        assert one(spark, keys.uuid5(F.col("s")), s=("string", s)) == str(uuid.uuid5(keys.NAMESPACE, s))
    assert one(spark, keys.uuid5(F.col("s")), s=("string", None)) is None


@pytest.mark.parametrize(
    ("name", "want"),
    [("vitis-idaea", "vitisidaea"), ("abies var. alba", "abies alba"), ("rosa ‘peace’", "rosa 'peace'"), ("a  b", "a b"), ("123", None), ("", None), (None, None)],
)
def test_clean_name(spark, name, want):
    assert one(spark, text.clean_name(F.col("s")), s=("string", name)) == want


def test_strip_infix(spark):
    assert one(spark, text.strip_infix(F.col("a"), F.col("b")), a=("string", "Abies alba Mill."), b=("string", " mill. ")) == "abies alba"
    assert one(spark, text.strip_infix(F.col("a"), F.col("b")), a=("string", "Abies (x+) a  b"), b=("string", "(x+)")) == "abies a  b"
    assert one(spark, text.strip_infix(F.col("a"), F.col("b")), a=("string", "Abies"), b=("string", None)) == "Abies"


def test_spellings_are_unambiguous():
    for table in (vocabulary.RANK_SPELLINGS, vocabulary.STATUS_SPELLINGS):
        rows = text.spelling_rows(table)
        assert len({s for s, _ in rows}) == len(rows)
    assert {r.upper() for r in vocabulary.RANK_SPELLINGS} == set(vocabulary.RANKS)


def test_unsigned_and_years(spark):
    assert one(spark, text.unsigned(F.col("s")), s=("string", "-1")) is None
    assert one(spark, text.unsigned(F.col("s"), 16), s=("string", "70000")) is None
    assert one(spark, text.unsigned(F.col("s")), s=("string", "4294967295")) == 4294967295
    assert [one(spark, x, s=("string", "Mill., 1768")) for x in text.split_year(F.col("s"))] == ["Mill.", 1768]


def test_tiles_at_the_edges(spark):
    for lng, lat, want in ((0.0, 0.0, 512 * 1024 + 512), (-180.0, 90.0, 0), (180.0, -90.0, 1024 * 1024 - 1)):
        assert one(spark, geo.tile_id(F.col("a"), F.col("b")), a=("double", lng), b=("double", lat)) == want
    assert one(spark, geo.floor_bin(F.col("a")), a=("double", -150.0)) == -200


def test_wkb(spark):
    import struct

    raw = b"\x01" + struct.pack("<I", 1) + struct.pack("<dd", 12.34567, -7.5)
    rows = geo.wkb_points(spark.createDataFrame([(raw,), (None,)], "wkb binary")).select("lng", "lat").collect()
    assert tuple(rows[0]) == (12.346, -7.5) and rows[1].lng is None

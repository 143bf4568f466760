"""Joins behind a bitmap, and shared files."""
import pytest
from conftest import plan_text

from tidemark.llm import common


def ids(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bits", [1 << 24, 64])
def test_joins_are_exact_whatever_the_bitmap(spark, monkeypatch, bits):
    monkeypatch.setattr(common, "bitmap_bits", lambda n: bits)
    rows = [(i, f"t{i}", "x") for i in range(200)] + [(None, "none", "x"), (7, "t7", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, id string")
    keep = spark.createDataFrame([(i,) for i in range(0, 400, 3)] + [(None,), (3,)], "id long")
    inside = [(i, t) for i, t, _ in rows if i is not None and i % 3 == 0]
    outside = [(i, t) for i, t, _ in rows if i is None or i % 3]
    semi, anti = common.semi_join(df, "doc_id", keep, "id"), common.anti_join(
        df, "doc_id", keep, "id")
    assert semi.columns == anti.columns == df.columns
    assert ids(semi) == sorted(inside, key=repr) and ids(anti) == sorted(outside, key=repr)


def test_empty_sides(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "id long")
    assert ids(common.semi_join(df, "doc_id", none, "id")) == []
    assert ids(common.anti_join(df, "doc_id", none, "id")) == [(1, "a")]
    assert ids(common.anti_join(df.limit(0), "doc_id", none, "id")) == []


def test_rows_are_filtered_before_they_are_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).selectExpr("id AS doc_id", "'t' AS text")
        some = spark.range(0, 1000, 9)
        for joined in (common.semi_join(df, "doc_id", some, "id"),
                       common.anti_join(df, "doc_id", some, "id")):
            plan = plan_text(joined)
            shuffled = plan[plan.index("Exchange hashpartitioning(doc_id"):]
            assert "getbit" in shuffled.split("Exchange", 2)[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("form", ["{}", "file:{}", "file://{}"])
def test_shared_paths(tmp_path, form):
    (tmp_path / "x").write_bytes(b"shared")
    filesystem, path = common.open_shared(form.format(tmp_path))
    with filesystem.open_input_file(f"{path}/x") as f:
        assert f.read() == b"shared"


def test_bitmaps_are_bounded():
    assert common.bitmap_bits(0) == 1 << 16
    assert common.bitmap_bits(10**12) == common.MAX_BITMAP_BITS

"""Repeated keys by tiles (S9) and NULL counts from footers."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from relq.operators import checks as K

from support import shuffled_bytes


def both(df, keys):
    got, want = (K.duplicate_keys(df, keys, compact=c) for c in (True, False))
    assert got.schema.simpleString() == want.schema.simpleString()
    return sorted(map(str, got.collect())), sorted(map(str, want.collect()))


small = st.one_of(st.none(), st.integers(-70, 70), st.sampled_from([0, 1, 63, 64, -1, -64, 2**31 - 1, -2**31]))


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(small, small), max_size=60))
def test_tiles_find_what_a_count_finds(spark, data):
    df = spark.createDataFrame(data, "a int, b bigint").repartition(3)
    for keys in (["a"], ["a", "b"], ["b", "a"]):
        got, want = both(df, keys)
        assert got == want


@pytest.mark.parametrize("times", [1, 2, 3, 5])
def test_keys_that_occur_so_many_times(spark, times):
    """More than twice: the tile cannot tell, and its rows are counted."""
    df = spark.range(5000).select((F.col("id") - 2500).alias("k"), F.explode(F.sequence(F.lit(1), F.when(F.col("id") % 50 == 0, times).otherwise(1))).alias("n"))
    got, want = both(df, ["k"])
    assert got == want and len(got) == (100 if times > 1 else 0)


def test_a_hot_key_and_extreme_values(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 2**63 - 1).when(F.col("id") == 1, -2**63).otherwise(F.col("id")).alias("k"))
    got = K.duplicate_keys(df, ["k"]).collect()
    assert [tuple(r) for r in got] == [(2**63 - 1, 10000)]


def test_many_unclear_tiles_are_counted_plainly(spark, monkeypatch):
    monkeypatch.setattr(K, "BROADCAST_TILES", 3)
    df = spark.range(3000).select((F.col("id") % 700).alias("k"))
    got, want = both(df, ["k"])
    assert got == want and len(got) == 700


def test_three_key_columns_and_other_types(spark):
    df = spark.range(600).select((F.col("id") % 5).cast("byte").alias("a"), (F.col("id") % 11).cast("short").alias("b"), (F.col("id") % 7).cast("int").alias("c"))
    assert both(df, ["a", "b", "c"])[0] == both(df, ["a", "b", "c"])[1]
    text = df.select(F.col("a").cast("string").alias("a"))
    assert K.duplicate_keys(text, ["a"]).count() == 5
    with pytest.raises(ValueError, match="whole-number"):
        K.duplicate_keys(text, ["a"], compact=True)
    assert K.duplicate_keys(df.limit(0), ["a"]).count() == 0


def test_a_thousandth_of_repeats_shuffles_a_twentieth(spark, tmp_path):
    """1,000,000 ids in the order they were written, every thousandth twice."""
    path = str(tmp_path / "t")
    spark.range(0, 1_000_000, 1, 8).select(F.explode(F.when(F.col("id") % 1000 == 7, F.array("id", "id")).otherwise(F.array("id"))).alias("id")).write.parquet(path)
    df = spark.read.schema("id bigint").parquet(path)
    sent, found = {}, {}
    for compact in (True, False):
        with shuffled_bytes(spark) as total:
            found[compact] = sorted(map(tuple, K.duplicate_keys(df, ["id"], compact=compact).collect()))
        sent[compact] = total()
    assert found[True] == found[False] and len(found[True]) == 1000
    assert sent[True] * 20 < sent[False], sent


def test_null_counts_from_footers_equal_a_scan(spark, tmp_path):
    from relq.sources.tables import read_footers, read_table

    rows = [(i if i % 3 else None, None if i % 5 else "x" * i, None) for i in range(1000)]
    spark.createDataFrame(rows, "a bigint, b string, c double").repartition(4).write.parquet(f"{tmp_path}/t.parquet")
    schema = spark.createDataFrame([], "a bigint, b string, c double").schema
    footers, scan = (f(spark, str(tmp_path), "t", schema) for f in (read_footers, read_table))
    want = sorted(map(tuple, K.null_counts(scan).collect()))
    assert sorted(map(tuple, K.null_counts(footers).collect())) == want == [("a", 334, 1000), ("b", 800, 1000), ("c", 1000, 1000)]
    assert sorted(map(tuple, K.validate(scan, "t", ["a", "b"], ["a"], footers).collect())) == sorted(map(tuple, K.validate(scan, "t", ["a", "b"], ["a"]).collect()))
    # a filter makes it an ordinary scan
    assert K.null_counts(footers.where("a > 500")).collect()[0]["null_count"] == 0
    assert spark.conf.get("spark.sql.sources.useV1SourceList").count("parquet") == 1

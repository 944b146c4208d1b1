"""Value domains and mergeable profiles."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from relq.operators import domains as D

from support import SF_ORACLE


def test_small_domains_are_complete_and_exact(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("a"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("v"), F.col("id") % 3)).alias("b"),
                                  F.lit(None).cast("date").alias("none"), (F.col("id") % 2 == 0).alias("flag"), F.when(F.col("id") % 2 == 0, -0.0).otherwise(0.0).alias("zero"))
    got = {(r["column_name"], r["value"]): r for r in D.value_domain(df, df.columns).collect()}
    for c in df.columns[:4]:
        want = {None if r["v"] is None else r["v"]: r["n"] for r in df.groupBy(F.col(c).cast("string").alias("v")).agg(F.count("*").alias("n")).collect()}
        assert {v: r["n_rows"] for (name, v), r in got.items() if name == c} == want
        assert all(r["exact"] and r["max_error"] == 0 and r["domain_size"] == len(want) for (name, _), r in got.items() if name == c)
    assert got["zero", "0.0"]["n_rows"] == 5000
    assert D.value_domain(df.limit(0), df.columns).count() == 0


def test_large_domains_report_frequent_values_within_the_error(spark):
    n = 200_000
    df = spark.range(0, n, 1, 8).select(F.when(F.col("id") % 4 == 0, -1).when(F.col("id") % 100 == 1, -2).otherwise(F.col("id")).alias("k"))
    rows = D.value_domain(df, ["k"], limit=100, top=5).collect()
    assert not any(r["exact"] for r in rows) and len(rows) <= 5
    error = rows[0]["max_error"]
    got = {r["value"]: r["n_rows"] for r in rows}
    for value, true in (("-1", n // 4), ("-2", n // 100)):
        assert true <= got[value] <= true + error
    assert abs(rows[0]["domain_size"] - df.distinct().count()) < 0.1 * n
    with pytest.raises(ValueError, match="limit"):
        D.value_domain(df, ["k"], limit=D.TRACKED)


@pytest.mark.parametrize("extra", [0, 1])
def test_the_bound_of_exact_domains(spark, extra):
    df = spark.range((50 + extra) * 20).select((F.col("id") % (50 + extra)).alias("k"))
    rows = D.value_domain(df, ["k"], limit=50, top=7).collect()
    assert {r["exact"] for r in rows} == {not extra} and len(rows) == (7 if extra else 50)


def test_merged_states_equal_a_full_profile(spark, tmp_path):
    orders = spark.read.parquet(f"{SF_ORACLE}/orders.parquet").withColumn("BASIS_YEAR", F.year("o_orderdate"))
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    D.snapshot_states(orders, "BASIS_YEAR", cols).write.partitionBy("BASIS_YEAR").parquet(str(tmp_path / "states"))
    states = spark.read.parquet(str(tmp_path / "states"))
    for part, source in ((states, orders), (states.where("BASIS_YEAR = 1997"), orders.where("BASIS_YEAR = 1997"))):
        got = {r["column_name"]: r for r in D.merged_profile(part).collect()}
        n = source.count()
        for c in cols:
            true = source.agg(F.count(c).alias("n"), F.count_distinct(c).alias("d"), F.min(c).alias("lo"), F.max(c).alias("hi")).first()
            r = got[c]
            assert (r["row_count"], r["non_null"]) == (n, true["n"])
            assert abs(r["distinct_values"] - true["d"]) <= max(1, D.HLL_ERROR * true["d"])
            if c in ("o_orderkey", "o_custkey"):
                assert (r["min_whole"], r["max_whole"]) == (true["lo"], true["hi"])
            if c == "o_totalprice":
                assert (r["min_num"], r["max_num"]) == (true["lo"], true["hi"])
                for q, value in zip((0.25, 0.5, 0.75), r["quartiles"]):
                    assert abs(source.where(F.col(c) <= value).count() / n - q) <= D.RANK_ERROR
            if c == "o_orderstatus":
                want = {x["o_orderstatus"]: x["count"] for x in source.groupBy("o_orderstatus").count().collect()}
                assert {v["value"]: v["n_rows"] for v in r["top_values"]} == want and r["quartiles"] is None


def test_a_new_date_costs_that_dates_scan(spark, tmp_path):
    fact, states = str(tmp_path / "fact"), str(tmp_path / "states")
    spark.range(3000).select((F.col("id") % 3 + 2020).alias("y"), F.col("id").alias("v")).write.partitionBy("y").parquet(fact)
    stored = spark.read.parquet(fact)
    D.snapshot_states(stored.where("y < 2022"), "y", ["v"]).write.parquet(states)
    assert D.merged_profile(spark.read.parquet(states)).first()["row_count"] == 2000
    new = D.snapshot_states(stored.where("y = 2022"), "y", ["v"])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        new.explain()
    assert "PartitionFilters: [isnotnull(y" in buf.getvalue()
    new.write.mode("append").parquet(states)
    r = D.merged_profile(spark.read.parquet(states)).first()
    assert (r["row_count"], r["min_whole"], r["max_whole"]) == (3000, 0, 2999)


def test_states_with_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([("d1", None, None), ("d1", 1, "x"), (None, 2, None)], "day string, n int, t string")
    got = {r["column_name"]: r for r in D.merged_profile(D.snapshot_states(df, "day", ["n", "t"])).collect()}
    assert (got["n"]["row_count"], got["n"]["non_null"], got["n"]["distinct_values"], got["t"]["non_null"], got["t"]["min_text"]) == (3, 2, 2, 1, "x")
    assert D.merged_profile(D.snapshot_states(df.limit(0), "day", ["n", "t"])).count() == 0

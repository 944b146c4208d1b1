"""Edge rows the seed lacks (FIXTURES.md §3) and negative cases."""

import pytest
from pyspark.sql import functions as F

from support import rows
from relq.functions import expressions as X
from relq.operators import aggregates as A
from relq.operators import checks as K
from relq.operators import filters as P
from relq.operators import joins as J
from relq.operators import ordering as O
from relq.plans import reports as R
from relq.sources.adhoc import run_sql


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(
        [("11", "Seoul", "G1", "capital"), ("26", "Busan", "G1", "province"),
         ("51", "Gangwon", "G1", "province"), ("77", "Other", "G2", "capital")],
        "CD_ID string, CD_NM string, CD_GRP_ID string, ZONE_TYPE string")


@pytest.fixture(scope="module")
def fact(spark):
    # region 51 has no guarantee; code 99 is unknown; codes 10 and 12 are both unlabelled
    return spark.createDataFrame(
        [("20230630", "G-1", "11", "07", 100), ("20230630", "G-2", "11", "10", 10),
         ("20230630", "G-3", "11", "12", 20), ("20230630", "G-4", "99", "07", 5),
         ("20220630", "G-1", "26", "08", 50), ("20230630", "G-5", "77", "07", 7)],
        "BASIS_DY string, GRNT_NO string, ZONE string, CODE string, CNT bigint")


def test_group_by_code_keeps_unknown_codes_apart(fact):
    out = A.group_then_label(fact, ["BASIS_DY"], "CODE", X.case_map("CODE", {"07": "lease"}, "other"),
                             "label", [F.sum("CNT").alias("s")])
    got = sorted(rows(out.filter(F.col("BASIS_DY") == "20230630")))
    assert got == [("20230630", "lease", 112), ("20230630", "other", 10), ("20230630", "other", 20)]


def test_inner_left_right_full_differ(fact, dim):
    inner = J.equi_join(fact, dim, "ZONE", "CD_ID")
    left = J.equi_join(fact, dim, "ZONE", "CD_ID", how="left")
    right = J.equi_join(fact, dim, "ZONE", "CD_ID", how="right")
    full = J.full_outer_join(fact, dim, "ZONE", "CD_ID")
    assert (inner.count(), left.count(), right.count(), full.count()) == (5, 6, 6, 7)
    native = fact.join(dim, fact["ZONE"] == dim["CD_ID"], "full")
    assert sorted(rows(full.select(*native.columns)), key=str) == sorted(rows(native), key=str)


def test_on_predicate_versus_where_on_outer_join(fact, dim):
    on = J.equi_join(fact, dim, "ZONE", "CD_ID", how="left", right_filter=P.eq("CD_GRP_ID", "G1"))
    assert on.count() == 6                      # G-5 kept, its dim columns NULL
    assert on.filter(F.col("GRNT_NO") == "G-5").select("CD_NM").first()[0] is None
    where = P.where(J.equi_join(fact, dim, "ZONE", "CD_ID", how="left"), P.eq("CD_GRP_ID", "G1"))
    assert where.count() == 4                   # WHERE drops the unmatched and the G2 row
    with pytest.raises(ValueError):
        J.equi_join(fact, dim, "ZONE", "CD_ID", how="right", right_filter=P.eq("CD_GRP_ID", "G1"))


def test_full_outer_duplicates_and_union_form(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, a string")
    b = spark.createDataFrame([(1, "p"), (3, "q")], "kb int, b string")
    full = J.full_outer_join(a, b, "k", "kb").select("a", "b")
    assert full.count() == 4                    # the duplicate row survives
    dedup = J.full_outer_distinct(a, b, "k", "kb", ["a", "b"])
    union = O.union_distinct(J.equi_join(a, b, "k", "kb", how="left").select("a", "b"),
                             J.equi_join(b, a, "kb", "k", how="left").select("a", "b"))
    assert sorted(rows(dedup), key=str) == sorted(rows(union), key=str)
    assert dedup.count() == 3


def test_full_outer_using_keys(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string")
    b = spark.createDataFrame([(1, "p"), (3, "q")], "k int, b string")
    got = sorted(rows(J.full_outer_join(a, b, "k")), key=str)
    assert got == sorted([(1, "x", "p"), (2, "y", None), (3, None, "q")], key=str)


def test_cartesian_guard(fact, dim):
    with pytest.raises(ValueError):
        J.equi_join(fact, dim, [], [])
    with pytest.raises(ValueError):
        J.full_outer_join(fact, dim, [], [])


def test_one_guarantee_two_dates_composite_key(spark):
    st = spark.createDataFrame([("d1", "G"), ("d2", "G")], "BASIS_DY string, GRNT_NO string")
    am = spark.createDataFrame([("d1", "G", 1.0), ("d2", "G", 2.0)],
                               "BASIS_DY string, GRNT_NO string, AMT double")
    single = J.equi_join(st, am.drop("BASIS_DY"), "GRNT_NO")
    both = J.equi_join(st, am, ["GRNT_NO", "BASIS_DY"])
    assert single.count() == 4 and both.count() == 2


def test_case_and_coalesce_nulls(spark):
    df = spark.createDataFrame([(None, None, None), ("0", None, 3.0), ("1", 2.0, 3.0), (None, None, 4.0)],
                               "flag string, p1 double, p2 double")
    out = df.select(X.case_flag(P.ne("flag", "0"), "board", "kb").alias("src"),
                    X.coalesce_chain(["p1", "p2"], 0.0).alias("price"),
                    X.case_map("flag", {"1": "one"}).alias("no_else"))
    assert rows(out) == [("kb", 0.0, None), ("kb", 3.0, None), ("board", 2.0, "one"), ("kb", 4.0, None)]


def test_null_operand_in_row_sum(spark):
    df = spark.createDataFrame([(1, 2, None), (1, 2, 3)], "a bigint, b bigint, c bigint")
    assert [r[0] for r in rows(df.select(X.row_sum("a", "b", "c")))] == [None, 6]


def test_empty_pivot_category_is_zero(fact):
    out = A.pivot_sums(fact, ["BASIS_DY"], "CODE", {"lease": "07", "mid": "09"}, "CNT", "total")
    got = dict((r[0], r[1:]) for r in rows(out))
    assert got["20220630"] == (0, 0, 50)


def test_like_versus_ilike(spark):
    df = spark.createDataFrame([("G-2023-0001",), ("g-2023-0002",)], "id string")
    assert df.filter(P.like("id", "G-2023%")).count() == 1
    assert df.filter(P.like("id", "G-2023%", case_sensitive=False)).count() == 2
    assert df.filter(P.like("id", "_-____-____")).count() == 2


def test_null_sort_order(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert [r[0] for r in rows(O.order_by(df, ["v"]))] == [None, 1, 3]
    assert [r[0] for r in rows(O.order_by(df, ["-v"]))] == [3, 1, None]


def test_eq_null_keeps_nothing(spark):
    df = spark.createDataFrame([(None,), ("a",)], "v string")
    assert df.filter(P.eq_null("v")).count() == 0
    assert df.filter(P.is_null("v")).count() == 1


def test_not_and_in_subquery(spark, fact, dim):
    assert fact.filter(P.negate(P.eq("CODE", "07"))).count() == 3
    sub = P.where(dim, P.eq("ZONE_TYPE", "capital"))
    got = P.in_subquery(fact, "ZONE", sub, "CD_ID")
    assert sorted(r[1] for r in rows(got)) == ["G-1", "G-2", "G-3", "G-5"]


def test_above_average_uses_unjoined_fact(fact, dim):
    pivot = R.zone_pivot(fact, dim, fact_region="ZONE", dim_key="CD_ID", zone_col="ZONE_TYPE",
                         date_col="BASIS_DY", zones={"cap": "capital", "prov": "province"}, value="CNT",
                         total="total")
    # unjoined totals per date: 142 and 50 -> average 96; joined 2023 total is 137
    out = R.above_average(pivot, "total", fact, "BASIS_DY", "CNT")
    assert rows(out) == [("20230630", 137, 0, 137)]


def test_checks(spark, fact, dim):
    prof = {r["column_name"]: r for r in K.profile(fact).collect()}
    assert prof["CODE"]["distinct_values"] == 4 and prof["CNT"]["max_text"] == "100"
    assert prof["GRNT_NO"]["row_count"] == 6
    approx = {r["column_name"]: r for r in K.profile(fact, exact_distinct=False).collect()}
    assert approx["CODE"]["distinct_values"] == 4
    dup = K.duplicate_keys(fact, ["GRNT_NO"])
    assert rows(dup) == [("G-1", 2)]
    orphan = K.orphans(fact, dim, ["ZONE"], ["CD_ID"])
    assert [r[1] for r in rows(orphan)] == ["G-4"]
    nulls = {r[0]: r[1] for r in rows(K.null_counts(
        spark.createDataFrame([(1, None), (None, None)], "a int, b string")))}
    assert nulls == {"a": 1, "b": 2}


def test_run_sql_contract(spark, fact):
    fact.createOrReplaceTempView("fact_t")
    df, err = run_sql(spark, "SELECT CODE, COUNT(*) AS n FROM fact_t GROUP BY CODE ORDER BY CODE;")
    assert err is None and rows(df)[0] == ("07", 3)
    for bad in ["DROP VIEW fact_t", "SELECT 1; SELECT 2", "EXPLAIN SELECT 1", "SHOW TABLES",
                "SELECT CODE, CNT FROM fact_t GROUP BY CODE",
                "SELECT CODE FROM fact_t WHERE SUM(CNT) > 1", "   ", "SELECT nope FROM fact_t"]:
        df, err = run_sql(spark, bad)
        assert df is None and err, bad
    assert spark.catalog.tableExists("fact_t")


def test_right_outer_join_is_swapped_left(fact, dim):
    ours = J.right_outer_join(fact, dim, "ZONE", "CD_ID")
    native = fact.join(dim, fact["ZONE"] == dim["CD_ID"], "right")
    assert ours.columns == native.columns
    assert sorted(rows(ours), key=str) == sorted(rows(native), key=str)


def test_label_codes_case_and_lookup_agree(spark):
    from relq.operators import projections as PR
    df = spark.createDataFrame([(f"{i:03d}",) for i in range(100)] + [(None,), ("zzz",)], "code string")
    small = {f"{i:03d}": f"L{i}" for i in range(10)}
    large = {f"{i:03d}": f"L{i}" for i in range(80)}
    for mapping in (small, large):
        got = {r["code"]: r["label"] for r in PR.label_codes(df, "code", mapping, "label", "other").collect()}
        want = {c: mapping.get(c, "other") if c is not None else "other" for c in got}
        assert got == want and len(got) == 102
    codes = spark.createDataFrame([(i,) for i in range(50)], "code int")
    for n in (6, 40):  # text keys of an int column, at any length
        labels = {str(i): f"L{i}" for i in range(n)}
        got = {r["code"]: r["label"] for r in PR.label_codes(codes, "code", labels, "label").collect()}
        assert got == {i: f"L{i}" if i < n else None for i in range(50)}


def test_run_sql_comments_and_cte(spark, fact):
    fact.createOrReplaceTempView("fact_t")
    df, err = run_sql(spark, "SELECT COUNT(*) AS n FROM fact_t -- trailing comment")
    assert err is None and df.first()["n"] == 6
    df, err = run_sql(spark, "WITH c AS (SELECT CODE FROM fact_t WHERE CNT > 10) SELECT COUNT(*) AS n FROM c;")
    assert err is None and df.first()["n"] == 3          # CNT 100, 20, 50
    df, err = run_sql(spark, "SELECT COUNT(*) AS n FROM fact_t; -- note; more /* text\n ;; /* end */ ")
    assert err is None and df.first()["n"] == 6
    df, err = run_sql(spark, "SELECT ';--' AS s, COUNT(*) AS n FROM fact_t")
    assert err is None and df.first()["s"] == ";--"
    df, err = run_sql(spark, "SELECT 1 /* unclosed")
    assert df is None and err


def test_outer_join_refuses_ambiguous_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, "y")], "kb int, v string")
    with pytest.raises(ValueError):
        J.full_outer_join(a, b, "k", "kb")
    with pytest.raises(ValueError):
        J.left_outer_join(a, b, "k", "kb")


def test_order_by_skips_unorderable_tiebreakers(spark):
    df = spark.createDataFrame([(2, {"a": 1}, "long text"), (1, {"b": 2}, "other")], "k int, m map<string,int>, t string")
    assert [r["k"] for r in O.order_by(df, ["k"], tiebreak=True).collect()] == [1, 2]
    text = O.order_by(df, ["k"], tiebreak=True)._jdf.queryExecution().toString()
    assert "Sort [k#" in text and "t#" not in text[text.index("Sort [k#"):].split("]")[0]


def test_sub_cent_values_are_never_rounded_unseen(spark):
    df = spark.createDataFrame([(0.005,)] * 3, "v double")
    assert float(df.agg(X.money_sum("v", digits=3).alias("s")).first()["s"]) == 0.015
    with pytest.raises(Exception, match="more than 2 decimals"):
        df.agg(X.money_sum("v").alias("s")).collect()
    fine = spark.createDataFrame([(0.07,), (123456789.29,), (-0.29,), (None,)], "v double")
    assert str(fine.agg(X.money_sum("v").alias("s")).first()["s"]) == "123456789.07"


def test_key_text_keeps_long_years(spark):
    df = spark.createDataFrame([(12345,), (98,)], "y int")
    assert [r[0] for r in df.select(X.key_text("y", "yyyy")).collect()] == ["12345", "0098"]


def test_profile_keeps_every_digit(spark):
    df = spark.createDataFrame([(9007199254740993, 1.5), (3, 2.5)], "n long, x double")
    got = {r["column_name"]: r for r in K.profile(df).collect()}
    assert got["n"]["max_text"] == "9007199254740993" and got["n"]["max_num"] is None
    assert (got["x"]["min_num"], got["x"]["max_num"], got["x"]["min_text"]) == (1.5, 2.5, None)


def test_like_takes_a_backslash_as_itself(spark):
    df = spark.createDataFrame([("a\\b",), ("ab",), ("a%b",)], "s string")
    assert rows(df.filter(P.like("s", "a\\b"))) == [("a\\b",)]
    assert len(rows(df.filter(P.like("s", "a\\%")))) == 1
    assert rows(df.filter(P.like("s", "A\\B", case_sensitive=False))) == [("a\\b",)]


def test_foreign_key_check_passes_nulls(spark):
    fact = spark.createDataFrame([(1,), (7,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (1,)], "id int")
    assert rows(K.orphans(fact, dim, ["k"], ["id"])) == [(7,)]
    assert sorted(rows(K.orphans(fact, dim, ["k"], ["id"], report_nulls=True)), key=str) == [(7,), (None,)]


def test_validate_reports_nulls_and_repeated_keys(spark, housing):
    from relq.sources import schemas as S
    df = spark.createDataFrame([("a", None), ("a", "x"), (None, None)], "CD_ID string, CD_NM string")
    got = rows(K.validate(df, S.REGION_CODE, S.HOUSING_NOT_NULL[S.REGION_CODE], S.HOUSING_PRIMARY_KEYS[S.REGION_CODE]))
    assert [r[1:] for r in got] == [("not null", "CD_ID", 1, 3), ("not null", "CD_NM", 2, 3), ("unique", "CD_ID", 1, 3)]
    clean = K.validate(housing["region"], S.REGION_CODE, S.HOUSING_NOT_NULL[S.REGION_CODE], S.HOUSING_PRIMARY_KEYS[S.REGION_CODE])
    assert all(r["violations"] == 0 for r in clean.collect())
    empty = rows(K.validate(df.limit(0), "t", ["CD_NM"], ["CD_ID"]))
    assert [r[3:] for r in empty] == [(0, 0), (0, 0)]


def test_configure_keeps_what_the_session_chose(spark):
    from relq import session as SE
    other = spark.newSession()
    other.conf.set("spark.sql.adaptive.enabled", "false")
    SE.configure(other)
    assert other.conf.get("spark.sql.adaptive.enabled") == "false"
    other.conf.set("spark.sql.ansi.enabled", "false")
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "50MB")
    SE.configure(other)
    assert other.conf.get("spark.sql.ansi.enabled") == "false"
    assert other.conf.get("spark.sql.autoBroadcastJoinThreshold") == "50MB"


def test_round_rows_halves_and_negatives(spark):
    df = spark.createDataFrame([("0.25",), ("-0.25",), ("-150.00",), ("149.99",)], "s string").select(F.col("s").cast("decimal(18,2)").alias("v"))
    assert [r[0] for r in df.select(X.round_to(F.col("v"), 1)).collect()] == [0.3, -0.3, -150.0, 150.0]
    assert [r[0] for r in df.select(X.round_to(F.col("v"), -2)).collect()] == [0.0, 0.0, -200.0, 100.0]


def test_aggregated_join_matches_native(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(1, 10), (3, 30)], "k long, n int")
    for how in ("inner", "left"):
        ours = J.aggregated_join(a, b, "k", how=how).select("k", "v", "n")
        native = a.join(b, "k", how).select("k", "v", "n")
        assert sorted(rows(ours), key=str) == sorted(rows(native), key=str)

"""The operators on the course's own seed tables reproduce its answers (FIXTURES.md §2)."""

from pyspark.sql import functions as F

import housing_seed as H
from support import rows
from relq.functions import expressions as X
from relq.operators import aggregates as A
from relq.operators import filters as P
from relq.operators import joins as J
from relq.operators import ordering as O
from relq.operators import projections as PR
from relq.operators.aggregates import Measure
from relq.plans import reports as R


def group():
    return P.eq("CD_GRP_ID", H.REGION_GROUP)


def count(df):
    return df.count()


def test_select_distinct_codes(housing):
    out = PR.distinct_values(housing["status"], [F.col("PNSN_GV_METH_DVCD").alias("code")])
    assert sorted(r[0] for r in rows(out)) == ["07", "08", "09"]


def test_where_examples(housing):
    st = housing["status"]
    assert count(P.where(st, P.eq("BASIS_DY", "20230630"))) == 8
    assert count(P.where(st, P.compare("GRNT_SPLY_CNT", ">=", 10000))) == 14
    assert count(P.where(st, P.eq("BASIS_DY", "20230630"), P.compare("GRNT_SPLY_CNT", ">=", 5000))) == 6
    assert count(P.where(st, P.in_list("PNSN_GV_METH_DVCD", ["07", "08"]))) == 30
    assert count(P.where(st, P.between("BASIS_DY", "20200101", "20250630"))) == 32
    amt = housing["amount"]
    assert count(P.where(amt, P.is_null("LAST_CNCL_DY"))) == 27
    assert count(P.where(amt, P.is_not_null("LAST_CNCL_DY"))) == 5


def test_where_practice(housing):
    df = P.where(housing["status"], P.between("BASIS_DY", "20220101", "20250630"),
                 P.eq("PNSN_GV_METH_DVCD", "07"), P.compare("GRNT_SPLY_CNT", ">=", 10000))
    out = O.order_by(df, ["-GRNT_SPLY_CNT"]).select("GRNT_SPLY_CNT")
    assert [r[0] for r in rows(out)] == [27500, 25000, 19200, 17900, 11800, 10500]


def test_like_examples(housing):
    st = housing["status"]
    assert count(P.where(st, P.like("GRNT_NO", "G-2023%"))) == 8
    assert count(P.where(st, P.like("GRNT_NO", "%-0003"))) == 4
    seoul = PR.distinct_values(housing["region"], ["CD_ID", "CD_NM", "ZONE_TYPE"], where=P.like("CD_NM", "%서%"))
    assert [r[0] for r in rows(seoul)] == ["11"]
    assert count(P.where(st, P.like("GRNT_NO", "G-____-____"))) == 32


def test_like_practice(housing):
    df = P.where(housing["status"], P.any_of(P.like("GRNT_NO", "G-2021%"), P.like("GRNT_NO", "G-2022%")),
                 P.compare("GRNT_SPLY_CNT", ">=", 5000))
    vals = [r[0] for r in rows(O.order_by(df, ["-GRNT_SPLY_CNT"]).select("GRNT_SPLY_CNT"))]
    assert len(vals) == 11 and vals[0] == 25000 and vals[-1] == 6400


def test_order_examples(housing):
    j = J.equi_join(housing["status"], housing["amount"].drop("BASIS_DY"), "GRNT_NO")
    assert count(O.order_by(j, ["BASIS_DY", "-GRNT_AMT"])) == 32
    pay = P.where(housing["payment"], P.is_not_null("MM_PYAT_AMT"))
    vals = [r[0] for r in rows(O.order_by(pay, ["-MM_PYAT_AMT"]).select("MM_PYAT_AMT"))]
    assert len(vals) == 18 and vals[0] == 320.0 and vals[-1] == 85.0


def test_group_by_ex1(housing):
    out = A.group_agg(housing["status"], ["BASIS_DY"], [
        A.count_rows("n"), F.sum("GRNT_SPLY_CNT").alias("supply"),
        X.round_to(X.money_sum("APRS_EVAL_AMT"), 1).alias("appraisal")])
    assert rows(O.order_by(out, ["BASIS_DY"])) == [
        ("20200630", 8, 68800, 23.4), ("20210630", 8, 88900, 28.3),
        ("20220630", 8, 80580, 25.7), ("20230630", 8, 85300, 31.1)]


def test_group_by_ex2_ex3(housing):
    out = A.group_agg(housing["status"], ["PNSN_GV_METH_DVCD"], [
        A.count_rows("n"), X.round_to(F.avg("GRNT_SPLY_CNT"), 0).alias("avg"),
        F.max("GRNT_SPLY_CNT").alias("mx"), F.min("GRNT_SPLY_CNT").alias("mn")])
    assert rows(O.order_by(out, ["-avg"])) == [
        ("07", 19, 12184.0, 27500, 1900), ("08", 11, 7144.0, 13200, 980), ("09", 2, 6750.0, 8400, 5100)]
    having = A.having(A.group_agg(housing["status"], ["PNSN_GV_METH_DVCD"], [
        X.round_to(F.avg("GRNT_SPLY_CNT"), 0).alias("avg"), F.avg("GRNT_SPLY_CNT").alias("raw")]),
        F.col("raw") >= 5000)
    assert [r[0] for r in rows(O.order_by(having, ["-avg"]).select("avg"))] == [12184.0, 7144.0, 6750.0]


def test_group_by_ex4_and_practice(housing):
    st = housing["status"]
    out = A.having(A.group_agg(P.where(st, P.compare("BASIS_DY", ">=", "20220101")), ["HS_LOC_ZONE_DVCD"], [
        F.sum("GRNT_SPLY_CNT").alias("supply"), X.round_to(X.money_sum("APRS_EVAL_AMT"), 1).alias("appr")]),
        F.col("supply") >= 30000)
    assert rows(O.order_by(out, ["-supply"])) == [("11", 91200, 28.1), ("41", 57600, 16.7)]
    prac = A.having(A.group_agg(P.where(st, P.between("BASIS_DY", "20210101", "20250630")),
                                ["BASIS_DY", "PNSN_GV_METH_DVCD"], [F.sum("GRNT_SPLY_CNT").alias("s")]),
                    F.col("s") >= 15000)
    assert [r[0] for r in rows(O.order_by(prac, ["-s"]).select("s"))] == [64800, 63000, 62600, 24100, 22300]


def test_joins(housing):
    st, reg = housing["status"], housing["region"]
    inner = J.dim_lookup(st, reg, "HS_LOC_ZONE_DVCD", "CD_ID", dim_filter=group())
    assert count(inner) == 32
    left = J.equi_join(reg, st, "CD_ID", "HS_LOC_ZONE_DVCD", how="left")
    assert count(left) == 32
    three = J.equi_join(st, housing["amount"], ["GRNT_NO", "BASIS_DY"], ["GRNT_NO", "BASIS_DY"])
    three = J.dim_lookup(three, reg, "HS_LOC_ZONE_DVCD", "CD_ID", dim_filter=group())
    assert count(three) == 32
    prac = P.where(inner, P.eq("ZONE_TYPE", H.CAPITAL), P.between("BASIS_DY", "20220101", "20250630"),
                   P.eq("PNSN_GV_METH_DVCD", "07"))
    vals = [r[0] for r in rows(O.order_by(prac, ["-GRNT_SPLY_CNT"]).select("GRNT_SPLY_CNT"))]
    assert vals == [27500, 25000, 19200, 17900, 11800, 10500, 5200]


def test_case_bands(housing):
    band = X.case_bands("GRNT_SPLY_CNT", [(20000, "large"), (10000, "medium")], "small")
    out = A.group_agg(housing["status"], [band.alias("b")], [A.count_rows("n")])
    assert dict(rows(out)) == {"large": 4, "medium": 10, "small": 18}


def test_zone_pivot_composite3(housing):
    out = R.zone_pivot(housing["status"], housing["region"], fact_region="HS_LOC_ZONE_DVCD", dim_key="CD_ID",
                       zone_col="ZONE_TYPE", date_col="BASIS_DY",
                       zones={"capital": H.CAPITAL, "province": H.PROVINCE}, value="GRNT_SPLY_CNT",
                       total="all", dim_filter=group())
    assert rows(out) == [("20200630", 61700, 7100, 68800), ("20210630", 84000, 4900, 88900),
                         ("20220630", 73000, 7580, 80580), ("20230630", 81000, 4300, 85300)]


def test_product_pivot_case_practice(housing):
    out = R.product_pivot(housing["status"], date_col="BASIS_DY", code="PNSN_GV_METH_DVCD",
                          products={"lease": "07", "purchase": "08"}, value="GRNT_SPLY_CNT", total="all")
    assert rows(out) == [("20200630", 41100, 22600, 68800), ("20210630", 64800, 24100, 88900),
                         ("20220630", 62600, 9580, 80580), ("20230630", 63000, 22300, 85300)]


def test_coalesce_examples(housing):
    pay = housing["payment"].select("GRNT_NO", X.coalesce_default("MM_PYAT_AMT", 0).alias("v"))
    assert count(pay) == 24 and count(pay.filter(F.col("v") == 0)) == 6
    price = housing["price"].select(
        (X.coalesce_chain(["KAB_TRD_AVG_PRC", "KB_TRD_AVG_PRC"], 0) * 10000).alias("p"),
        X.case_flag(P.ne("KAB_SISE_RSCH_DY", "0"), H.SOURCE_BOARD, H.SOURCE_KB).alias("src"))
    got = rows(price)
    assert len(got) == 9 and got[0][0] == 51000.0
    assert sum(1 for r in got if r[1] == H.SOURCE_KB) == 3
    txt = housing["amount"].select(X.coalesce_default("LAST_CNCL_DY", H.UNCANCELLED).alias("d"))
    assert count(txt.filter(F.col("d") == H.UNCANCELLED)) == 27


def test_coalesce_practice(housing):
    j = J.equi_join(housing["status"], housing["payment"], "GRNT_NO", how="left")
    out = j.select("GRNT_NO", X.case_map("PNSN_GV_METH_DVCD", H.PRODUCT_LABELS, H.PRODUCT_OTHER).alias("name"),
                   X.coalesce_default("MM_PYAT_AMT", 0).alias("pay"))
    assert count(out) == 32 and count(out.filter(F.col("pay") == 0)) == 14


def test_composite1_status_report(housing):
    out = R.status_report(
        housing["status"], housing["region"], fact_region="HS_LOC_ZONE_DVCD", dim_key="CD_ID",
        dim_cols=["CD_NM", "ZONE_TYPE"], date_col="BASIS_DY", product_code="PNSN_GV_METH_DVCD",
        product_labels=H.PRODUCT_LABELS, other_label=H.PRODUCT_OTHER, dim_filter=group(),
        measures={"supply": Measure(F.sum("GRNT_SPLY_CNT")),
                  "appraisal": Measure(F.sum(X.cents("APRS_EVAL_AMT")), lambda c: X.round_to(X.from_cents(c), 1))},
        sort=["-BASIS_DY", "-supply"])
    got = rows(out)
    assert len(got) == 29
    assert got[0][0] == "20230630" and got[0][1] == "서울" and got[0][3] == "전세" and got[0][4] == 38000


def test_composite2_integrated(housing):
    out = R.integrated_detail(
        housing["status"], housing["amount"], housing["region"], housing["payment"],
        head_keys=["GRNT_NO", "BASIS_DY"], amount_keys=["GRNT_NO", "BASIS_DY"],
        head_region="HS_LOC_ZONE_DVCD", dim_key="CD_ID", detail_key="GRNT_NO", head_detail_key="GRNT_NO",
        since=P.compare("BASIS_DY", ">=", "20230101"), dim_filter=group(),
        select=[], coalesce={"pay": ("MM_PYAT_AMT", 0)}, sort=[])
    # the composite key join keeps both GRNT_NO columns apart; select by position-free names
    assert out.count() == 8
    assert out.filter(F.col("pay") == 0).count() == 3


def test_composite4_price(housing):
    out = R.price_detail(
        housing["price"], housing["age"], key="GRNT_NO", people_key="GRNT_NO",
        chain=[F.col("KAB_TRD_AVG_PRC"), F.col("KB_TRD_AVG_PRC")], default=0, unit=10000,
        flag=P.ne("KAB_SISE_RSCH_DY", "0"), flag_labels=(H.SOURCE_BOARD, H.SOURCE_KB),
        keep=[F.col("BASIS_YM")], person_cols=[F.col("AGE_YRCT")], price_name="price",
        flag_name="source", sort=["price"])
    got = rows(out)
    assert len(got) == 9 and all(r[3] is not None for r in got)


def test_quizzes(housing):
    st, amt = housing["status"], housing["amount"]
    q1 = O.order_by(P.where(st, P.eq("BASIS_DY", "20230630")), ["-GRNT_SPLY_CNT"])
    assert count(q1) == 8
    q2 = O.order_by(P.where(amt, P.is_not_null("LAST_CNCL_DY")), ["LAST_CNCL_DY"]).select(
        "GRNT_NO", X.coalesce_default("LAST_CNCL_DY", H.UNCANCELLED).alias("d"))
    assert [r[1] for r in rows(q2)] == ["20231015", "20240601", "20241201", "20250101", "20250301"]
    q3 = R.label_totals(st, date_col="BASIS_DY", code="PNSN_GV_METH_DVCD", labels=H.PRODUCT_LABELS,
                        other_label=H.PRODUCT_OTHER, aggs=[F.sum("GRNT_SPLY_CNT").alias("s")],
                        sort=["BASIS_DY", "-s"])
    assert count(q3) == 10
    q4 = P.where(J.dim_lookup(st, housing["region"], "HS_LOC_ZONE_DVCD", "CD_ID", dim_filter=group()),
                 P.eq("ZONE_TYPE", H.CAPITAL), P.eq("BASIS_DY", "20230630"))
    assert count(q4) == 6


def test_quiz5_above_average(housing):
    pivot = R.zone_pivot(housing["status"], housing["region"], fact_region="HS_LOC_ZONE_DVCD",
                         dim_key="CD_ID", zone_col="ZONE_TYPE", date_col="BASIS_DY",
                         zones={"capital": H.CAPITAL, "province": H.PROVINCE}, value="GRNT_SPLY_CNT",
                         total="all", dim_filter=group())
    out = R.above_average(pivot, "all", housing["status"], "BASIS_DY", "GRNT_SPLY_CNT")
    assert rows(out) == [("20210630", 84000, 4900, 88900), ("20230630", 81000, 4300, 85300)]
    avg = A.avg_of_group_totals(housing["status"], ["BASIS_DY"], "GRNT_SPLY_CNT")
    assert rows(avg) == [(80895.0,)]


def test_select_arith_alias_display(housing):
    out = PR.project_as(housing["status"], {
        "grnt_no": "GRNT_NO", "cancel_total": X.row_sum("GRNT_GEN_CNCL_CNT", "GRNT_UNEX_CNCL_CNT",
                                                        "GRNT_PRMS_RETR_CNCL_CNT")})
    shown = PR.with_display_names(out, {"grnt_no": "보증번호", "cancel_total": "해지건수합계"})
    assert shown.columns == ["보증번호", "해지건수합계"]
    first = rows(O.order_by(out, ["grnt_no"]))[0]
    assert first == ("G-2020-0001", 160)


def test_table_alias_and_qualified_columns(housing):
    a, b = housing["status"].alias("A"), housing["amount"].alias("B")
    j = J.equi_join(a, b, "GRNT_NO", "GRNT_NO")
    out = O.order_by(j.select(F.col("A.BASIS_DY").alias("basis_dy"), F.col("A.GRNT_NO").alias("grnt_no"),
                              F.col("B.GRNT_AMT").alias("grnt_amt")), ["basis_dy", "-grnt_amt"])
    got = rows(out)
    assert len(got) == 32 and got[0] == ("20200630", "G-2020-0005", 4200.0)

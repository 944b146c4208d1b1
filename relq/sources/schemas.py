"""Declared table schemas.

Two families:

* the six housing-finance tables of the course (snapshot facts keyed by a
  ``YYYYMMDD`` text date, a region code dimension, optional detail tables);
* the driver's Parquet tables the registered queries read.

Schemas are declared, never inferred.  ``nullable=False`` mirrors a
``NOT NULL`` / ``PRIMARY KEY`` column; Parquet reads hand every column back
as nullable, so NOT NULL is enforced by ``operators.checks.null_counts``,
not by the type.  Column meanings ride in ``StructField.metadata["comment"]``.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _f(name: str, dtype: T.DataType, nullable: bool = True, comment: str | None = None) -> T.StructField:
    meta = {"comment": comment} if comment else {}
    return T.StructField(name, dtype, nullable, meta)


S, L, D = T.StringType(), T.LongType(), T.DoubleType()

# --- fixed values: table names, column names and column meanings of the course schema ---
REGION_CODE = "TA_COA311M_CDBSC"
GUARANTEE_STATUS = "TW_RGG102M_GRNTCRST_DD"
GUARANTEE_AMOUNT = "TW_RGG101M_GRNTREQCNSL_DD"
PENSION_PAYMENT = "TB_RGE303M_GRNTRVEWAMT"
SUBSCRIBER_AGE = "TB_RGE301M_GRNTRVEHUMNMAT"
MARKET_PRICE = "TB_RGR011M_HSPRC"

HOUSING_SCHEMAS: dict[str, T.StructType] = {
    REGION_CODE: T.StructType([
        _f("CD_ID", S, False, "지역코드"),
        _f("CD_NM", S, False, "지역명"),
        _f("CD_GRP_ID", S, True, "코드그룹 (COA0083=지역)"),
        _f("ZONE_TYPE", S, True, "권역 구분 (수도권/지방)"),
    ]),
    GUARANTEE_STATUS: T.StructType([
        _f("BASIS_DY", S, False, "기준일자 (YYYYMMDD)"),
        _f("GRNT_NO", S, False, "보증번호"),
        _f("HS_LOC_ZONE_DVCD", S, True, "주택소재지역코드 (CD_ID 참조)"),
        _f("PNSN_GV_METH_DVCD", S, True, "지급방식코드 (07=전세/08=구입/09=중도금)"),
        _f("GRNT_SPLY_CNT", L, True, "공급건수"),
        _f("GRNT_GEN_CNCL_CNT", L, True, "일반해지건수"),
        _f("GRNT_UNEX_CNCL_CNT", L, True, "미실행해지건수"),
        _f("GRNT_PRMS_RETR_CNCL_CNT", L, True, "약정채무상환해지건수"),
        _f("APRS_EVAL_AMT", D, True, "감정평가금액(주택가격, 억원)"),
    ]),
    GUARANTEE_AMOUNT: T.StructType([
        _f("BASIS_DY", S, False, "기준일자"),
        _f("GRNT_NO", S, False, "보증번호"),
        _f("GRNT_AMT", D, True, "보증금액 (억원)"),
        _f("LAST_CNCL_DY", S, True, "최종해지일자"),
    ]),
    PENSION_PAYMENT: T.StructType([
        _f("GRNT_NO", S, False, "보증번호"),
        _f("MM_PYAT_AMT", D, True, "월지급금액 (만원)"),
    ]),
    SUBSCRIBER_AGE: T.StructType([
        _f("GRNT_NO", S, False, "보증번호"),
        _f("AGE_YRCT", L, True, "연령"),
    ]),
    MARKET_PRICE: T.StructType([
        _f("BASIS_YM", S, True, "기준연월 (YYYYMM)"),
        _f("GRNT_NO", S, True, "보증번호"),
        _f("KAB_TRD_AVG_PRC", D, True, "KB거래평균가격"),
        _f("KB_TRD_AVG_PRC", D, True, "KB시세평균가격"),
        _f("KAB_SISE_RSCH_DY", S, True, "KB시세조사일 (0이면 부동산원)"),
    ]),
}

# Primary / NOT NULL keys declared by the course DDL.
HOUSING_PRIMARY_KEYS = {REGION_CODE: ["CD_ID"]}
HOUSING_NOT_NULL = {
    REGION_CODE: ["CD_ID", "CD_NM"],
    GUARANTEE_STATUS: ["BASIS_DY", "GRNT_NO"],
    GUARANTEE_AMOUNT: ["BASIS_DY", "GRNT_NO"],
    PENSION_PAYMENT: ["GRNT_NO"],
    SUBSCRIBER_AGE: ["GRNT_NO"],
}

I = T.IntegerType()
NTZ = T.TimestampNTZType()

DRIVER_SCHEMAS: dict[str, T.StructType] = {
    "region": T.StructType([_f("r_regionkey", I), _f("r_name", S)]),
    "nation": T.StructType([_f("n_nationkey", I), _f("n_name", S), _f("n_regionkey", I)]),
    "customer": T.StructType([
        _f("c_custkey", L), _f("c_name", S), _f("c_nationkey", I),
        _f("c_acctbal", D), _f("c_mktsegment", S),
    ]),
    "supplier": T.StructType([
        _f("s_suppkey", L), _f("s_name", S), _f("s_nationkey", I), _f("s_acctbal", D),
    ]),
    "part": T.StructType([
        _f("p_partkey", L), _f("p_name", S), _f("p_brand", S), _f("p_type", S),
        _f("p_size", I), _f("p_retailprice", D),
    ]),
    "orders": T.StructType([
        _f("o_orderkey", L), _f("o_custkey", L), _f("o_orderstatus", S),
        _f("o_totalprice", D), _f("o_orderdate", NTZ), _f("o_orderpriority", S),
    ]),
    "lineitem": T.StructType([
        _f("l_orderkey", L), _f("l_partkey", L), _f("l_suppkey", L), _f("l_linenumber", I),
        _f("l_quantity", D), _f("l_extendedprice", D), _f("l_discount", D), _f("l_tax", D),
        _f("l_returnflag", S), _f("l_linestatus", S), _f("l_shipdate", NTZ),
    ]),
    "documents": T.StructType([
        _f("doc_id", L), _f("text", S), _f("lang", S), _f("source", S), _f("n_chars", L),
    ]),
    "labels": T.StructType([_f("doc_id", L), _f("quality", I), _f("toxic", I)]),
}

DRIVER_NOT_NULL = {
    "region": ["r_regionkey", "r_name"], "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey"], "orders": ["o_orderkey", "o_custkey", "o_orderdate"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"], "labels": ["doc_id", "quality", "toxic"],
}
DRIVER_KEYS = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"],
               "orders": ["o_orderkey"], "documents": ["doc_id"], "labels": ["doc_id"]}

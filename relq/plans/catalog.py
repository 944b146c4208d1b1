"""Registered queries over the driver's Parquet tables.

Every query reads whole tables (or frames Spark derives from them) and is
expressed with the ``relq`` operators; ``relq.plans.oracle`` holds the
equivalent SQL for an independent engine.  Role mapping from the course's
housing schema (SURVEY §7.3):

  snapshot fact   orders / lineitem, date text from ``o_orderdate`` / ``l_shipdate``
  region code dim nation, zone = its region name
  product code    o_orderstatus, o_orderpriority, l_returnflag
  optional detail labels for documents, per-order lineitem totals for orders

Output columns are snake_case ASCII; money is summed exactly (whole cents)
and returned as DOUBLE.  Dates leave as fixed-width text (``basis_dy``,
``basis_ym``, ``basis_year``), the form the course's schema stores them in;
no query emits a raw TIMESTAMP column.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relq.functions import expressions as X
from relq.operators import aggregates as A
from relq.operators import checks as K
from relq.operators import domains as D
from relq.operators import filters as P
from relq.operators import joins as J
from relq.operators import ordering as O
from relq.operators import projections as PR
from relq.plans import reports as R
from relq.sources.adhoc import run_sql
from relq.sources.schemas import DRIVER_KEYS, DRIVER_NOT_NULL
from relq.sources import tables as TB
from relq.sources.tables import read_table, register_views

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(fn: QueryFn) -> QueryFn:
    REGISTRY[fn.__name__] = fn
    return fn


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, d, name)


# --- shared derived frames ---------------------------------------------------

def nation_dim(spark: SparkSession, d: str) -> DataFrame:
    """Code dimension: nation id, name, region key, zone (= region name)."""
    region = t(spark, d, "region").select("r_regionkey", F.col("r_name").alias("zone"))
    return J.dim_lookup(t(spark, d, "nation"), region, "n_regionkey", "r_regionkey").drop("r_regionkey")


def docs_labels(spark: SparkSession, d: str) -> DataFrame:
    """documents LEFT JOIN labels: the sparse optional detail (601 of 1000 unlabeled at sf0.01).

    labels declares doc_id as its key (``check_not_null`` verifies it), so a
    hot key can only sit on the preserved side, where Spark splits it.
    """
    docs = t(spark, d, "documents")
    return J.left_outer_join(docs, t(spark, d, "labels"), "doc_id", right_unique=DRIVER_KEYS["labels"] == ["doc_id"])


def order_totals(lineitem: DataFrame) -> DataFrame:
    """Per-order lineitem totals: a two-phase aggregate on l_orderkey."""
    return A.group_agg(lineitem, ["l_orderkey"], [
        A.count_rows("line_count"), F.sum("l_quantity").alias("qty_total")])


def basis_dy(c: str) -> Column:
    return X.date_text(c, "yyyyMMdd")


def money_total(c: str, alias: str) -> Column:
    return X.to_double(X.money_sum(c)).alias(alias)


def money_measure(c: str, finish: Callable[[Column], Column]) -> A.Measure:
    """A money total summed in two steps as whole cents."""
    return A.Measure(F.sum(X.cents(c)), lambda total: finish(X.from_cents(total)))


PRIORITY_LABELS = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium"}
STATUS_LABELS = {"F": "finished", "O": "open", "P": "partial"}
LANG_LABELS = {"en": "English", "fr": "French", "de": "German"}
SIZE_BANDS = [(300000, "large"), (100000, "medium")]


def rate_chain() -> list[Column]:
    """Discount if non-zero, else tax if non-zero (the priority chain of C6)."""
    return [F.nullif(F.col("l_discount"), F.lit(0.0)), F.nullif(F.col("l_tax"), F.lit(0.0))]


def flagged() -> Column:
    return P.ne("l_returnflag", "N")


# --- S: sources, sinks, checks -----------------------------------------------

@query
def scan_all(spark, d):
    return TB.scan_all(t(spark, d, "nation"))


@query
def scan_ordered(spark, d):
    return TB.scan_ordered(t(spark, d, "customer"), ["c_nationkey", "c_custkey"])


@query
def snapshot_load(spark, d):
    """All years are loaded, then one of them again with fewer rows; the totals of what is stored."""
    orders = t(spark, d, "orders").withColumn("basis_year", F.date_format("o_orderdate", "yyyy"))
    path = TB.scratch(spark, "snapshots")
    TB.load_snapshots(orders, path, "basis_year", ["o_orderkey"])
    corrected = P.where(orders, P.all_of(P.eq("basis_year", "1997"), P.ne("o_orderstatus", "P")))
    TB.load_snapshots(corrected, path, "basis_year", ["o_orderkey"])
    stored = spark.read.schema(orders.schema).parquet(path)
    return A.group_agg(stored, ["basis_year"], [A.count_rows("n_orders"), money_total("o_totalprice", "total_price")])


@query
def result_sink(spark, d):
    """A result is written; the rows seen on the way and the rows stored."""
    result = docs_labels(spark, d).select("doc_id", "lang", "quality")
    path = TB.scratch(spark, "result")
    seen = TB.write_result(result, path, keys=["quality"])
    stored = spark.read.schema(result.schema).parquet(path)
    return stored.agg(A.count_rows("rows_stored"), F.lit(seen["rows"]).cast("bigint").alias("rows_seen"),
                      F.lit(seen["null_quality"]).cast("bigint").alias("nulls_seen"))


SINKS = ["snapshot_load", "result_sink"]  # what they do is to write, so they run jobs when called

ADHOC_PRESET = (
    "SELECT o_orderstatus, COUNT(*) AS n_orders, "
    "CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price "
    "FROM orders GROUP BY o_orderstatus ORDER BY o_orderstatus;"
)


@query
def adhoc_sql(spark, d):
    register_views(spark, d, ["orders"])
    df, err = run_sql(spark, ADHOC_PRESET)
    if err:
        raise RuntimeError(err)
    return df


@query
def profile_table(spark, d):
    return K.profile(t(spark, d, "orders"))


CODE_COLUMNS = {"orders": ["o_orderstatus", "o_orderpriority"], "lineitem": ["l_returnflag", "l_linestatus", "l_linenumber"],
                "customer": ["c_mktsegment", "c_nationkey"], "documents": ["lang", "source"], "labels": ["quality", "toxic"]}


@query
def profile_domain(spark, d):
    parts = [D.value_domain(t(spark, d, name), cols).withColumn("table_name", F.lit(name)) for name, cols in CODE_COLUMNS.items()]
    return functools.reduce(DataFrame.unionByName, parts).select(
        "table_name", "column_name", "value", "n_rows", "domain_size", "exact")


@query
def profile_snapshots(spark, d):
    # states per year, merged from a year on; the estimated columns are tested by their error bounds
    orders = t(spark, d, "orders").withColumn("basis_year", X.date_key("o_orderdate", "yyyy"))
    states = D.snapshot_states(orders, "basis_year", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice"])
    merged = D.merged_profile(states.filter(F.col("basis_year") >= 1997))
    return merged.select("column_name", "data_type", "row_count", "non_null", "min_whole", "max_whole", "min_num", "max_num",
                         F.substring("min_text", 1, 19).alias("min_text"), F.substring("max_text", 1, 19).alias("max_text"))


CODE_TABLES = ["region", "nation"]  # they do not grow
CHECKED = ["region", "nation", "customer", "orders", "documents", "labels"]


@query
def check_not_null(spark, d):
    # each base table against its declared NOT NULL columns and key
    parts = [K.validate(t(spark, d, name), name, DRIVER_NOT_NULL[name], DRIVER_KEYS[name], TB.read_footers(spark, d, name),
                        compact=False if name in CODE_TABLES else None) for name in CHECKED]
    return functools.reduce(DataFrame.unionByName, parts)


@query
def check_unique(spark, d):
    return K.duplicate_keys(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def check_orphans(spark, d):
    return K.orphans(t(spark, d, "documents"), t(spark, d, "labels"), ["doc_id"]).select(
        "doc_id", "lang", "source", "n_chars")


# --- P: projections ----------------------------------------------------------

@query
def project_cols(spark, d):
    return PR.project(t(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])


@query
def project_alias(spark, d):
    return PR.project_as(t(spark, d, "orders"), {
        "order_no": "o_orderkey", "basis_dy": basis_dy("o_orderdate"),
        "total_price": "o_totalprice", "priority": "o_orderpriority"})


@query
def project_arith(spark, d):
    return PR.project_as(t(spark, d, "lineitem"), {
        "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "l_quantity": "l_quantity",
        "qty_rate_sum": X.row_sum("l_quantity", "l_discount", "l_tax")})


@query
def unit_convert(spark, d):
    return PR.project_as(t(spark, d, "lineitem"), {
        "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "l_discount": "l_discount",
        "discount_pct": X.scale("l_discount", 100)})


@query
def distinct_one(spark, d):
    return PR.distinct_values(t(spark, d, "orders"), [F.col("o_orderstatus").alias("order_status")])


@query
def distinct_multi(spark, d):
    out = PR.distinct_values(t(spark, d, "orders"),
                             ["o_orderpriority", "o_orderstatus", X.date_key("o_orderdate", "yyyy").alias("basis_year")],
                             where=P.like("o_orderpriority", "%H%"))
    return out.withColumn("basis_year", X.key_text("basis_year", "yyyy"))


# --- F: filters --------------------------------------------------------------

def _orders_brief(df: DataFrame) -> DataFrame:
    return df.select("o_orderkey", basis_dy("o_orderdate").alias("basis_dy"), "o_orderstatus",
                     "o_totalprice")


@query
def filter_eq(spark, d):
    return _orders_brief(P.where(t(spark, d, "orders"), P.eq("o_orderdate", X.ts("1998-06-30 00:00:00"))))


@query
def filter_cmp(spark, d):
    return _orders_brief(P.where(t(spark, d, "orders"), P.compare("o_totalprice", ">=", 400000)))


@query
def filter_ne(spark, d):
    return _orders_brief(P.where(t(spark, d, "orders"), P.ne("o_orderpriority", "5-LOW")))


@query
def filter_and(spark, d):
    return _orders_brief(P.where(t(spark, d, "orders"), P.all_of(
        P.eq("o_orderstatus", "F"), P.compare("o_totalprice", ">=", 300000))))


@query
def filter_or_and(spark, d):
    return _orders_brief(P.where(t(spark, d, "orders"), P.all_of(
        P.any_of(P.eq("o_orderpriority", "1-URGENT"), P.eq("o_orderpriority", "2-HIGH")),
        P.compare("o_totalprice", ">=", 300000))))


@query
def filter_not(spark, d):
    return _orders_brief(P.where(t(spark, d, "orders"), P.negate(P.eq("o_orderstatus", "F"))))


@query
def filter_in(spark, d):
    return _orders_brief(P.where(t(spark, d, "orders"), P.in_list("o_orderstatus", ["F", "O"])))


@query
def filter_in_subquery(spark, d):
    sub = P.where(t(spark, d, "nation"), P.eq("n_regionkey", 2))
    return P.in_subquery(t(spark, d, "customer"), "c_nationkey", sub, "n_nationkey").select(
        "c_custkey", "c_name", "c_nationkey")


@query
def filter_between(spark, d):
    return _orders_brief(P.where(t(spark, d, "orders"), P.between(
        "o_orderdate", X.ts("1997-01-01 00:00:00"), X.ts("1998-12-31 00:00:00"))))


@query
def filter_is_null(spark, d):
    return P.where(docs_labels(spark, d), P.is_null("quality")).select("doc_id", "lang", "source", "quality")


@query
def filter_is_not_null(spark, d):
    return P.where(docs_labels(spark, d), P.is_not_null("quality")).select("doc_id", "lang", "source", "quality")


def _parts(df: DataFrame) -> DataFrame:
    return df.select("p_partkey", "p_name", "p_retailprice")


@query
def like_prefix(spark, d):
    return _parts(P.where(t(spark, d, "part"), P.like("p_name", "blue%")))


@query
def like_suffix(spark, d):
    return _parts(P.where(t(spark, d, "part"), P.like("p_name", "%bolt")))


@query
def like_contains(spark, d):
    return P.where(t(spark, d, "documents"), P.like("text", "%license%")).select(
        "doc_id", "lang", "n_chars")


@query
def like_single_char(spark, d):
    return P.where(t(spark, d, "customer"), P.like("c_name", "Customer#_________")).select(
        "c_custkey", "c_name")


@query
def like_or_range(spark, d):
    df = P.where(t(spark, d, "part"), P.all_of(
        P.any_of(P.like("p_name", "blue%"), P.like("p_name", "cold%")),
        P.compare("p_retailprice", ">=", 980)))
    return O.order_by(_parts(df), ["-p_retailprice", "p_partkey"])


@query
def filter_eq_null(spark, d):
    # ``quality = NULL`` holds for no row, however many NULLs there are
    docs = docs_labels(spark, d)
    return A.group_agg(docs, ["lang"], [
        A.count_rows("n_docs"), A.cond_sum(P.eq_null("quality"), F.lit(1)).cast("bigint").alias("n_eq_null"),
        A.cond_sum(P.is_null("quality"), F.lit(1)).cast("bigint").alias("n_is_null")])


@query
def like_ci(spark, d):
    return P.where(t(spark, d, "customer"), P.like("c_mktsegment", "build%", case_sensitive=False)).select(
        "c_custkey", "c_name", "c_mktsegment")


# --- J: joins ----------------------------------------------------------------

@query
def join_inner(spark, d):
    j = J.equi_join(t(spark, d, "orders"), t(spark, d, "customer"), "o_custkey", "c_custkey")
    return j.select("o_orderkey", basis_dy("o_orderdate").alias("basis_dy"), "c_name", "o_totalprice")


@query
def join_inner_on_const(spark, d):
    j = J.dim_lookup(t(spark, d, "customer"), t(spark, d, "nation"), "c_nationkey", "n_nationkey",
                     dim_filter=P.compare("n_regionkey", "<=", 2))
    return O.order_by(j.select("c_custkey", "c_name", "n_name", "c_mktsegment", "c_acctbal"),
                      ["n_name", "c_custkey"])


@query
def join_left(spark, d):
    return O.order_by(docs_labels(spark, d).select("doc_id", "lang", "source", "quality", "toxic"), ["doc_id"])


@query
def join_right(spark, d):
    labels, docs = t(spark, d, "labels"), t(spark, d, "documents")
    j = J.right_outer_join(labels.withColumnRenamed("doc_id", "label_doc_id"), docs, "label_doc_id", "doc_id",
                           left_unique=DRIVER_KEYS["labels"] == ["doc_id"])
    return j.select("doc_id", "lang", "quality", "toxic")


# a customer may have any share of the orders; their own keys are unique
CUSTOMER_ORDERS = {"left_unique": DRIVER_KEYS["customer"] == ["c_custkey"], "left_spread": DRIVER_KEYS["customer"],
                   "right_spread": DRIVER_KEYS["orders"]}


@query
def join_full(spark, d):
    return J.full_outer_join(t(spark, d, "customer"), t(spark, d, "orders"), "c_custkey", "o_custkey", **CUSTOMER_ORDERS).select(
        "c_custkey", "c_name", "o_orderkey", "o_totalprice")


@query
def join_full_dedup(spark, d):
    return J.full_outer_distinct(t(spark, d, "customer"), t(spark, d, "orders"), "c_custkey", "o_custkey",
                                 ["c_name", "o_orderstatus"], **CUSTOMER_ORDERS)


@query
def join_composite(spark, d):
    li = t(spark, d, "lineitem")
    counts = A.group_agg(li, ["l_orderkey", "l_linenumber"], [A.count_rows("n_rows")])
    j = J.aggregated_join(li.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), counts,
                          ["l_orderkey", "l_linenumber"])
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "n_rows")


@query
def join_three(spark, d):
    orders = P.where(t(spark, d, "orders"), P.between(
        "o_orderdate", X.ts("1997-01-01 00:00:00"), X.ts("1997-12-31 00:00:00")))
    j = J.equi_join(t(spark, d, "lineitem"), orders, "l_orderkey", "o_orderkey")
    j = J.equi_join(j, t(spark, d, "customer"), "o_custkey", "c_custkey")
    out = j.select("c_name", X.date_key("o_orderdate").alias("basis_dy"), "o_orderkey", "l_linenumber",
                   "l_quantity", "l_extendedprice", "o_totalprice")
    out = O.order_by(out, ["basis_dy", "c_name", "o_orderkey", "l_linenumber"])
    return out.withColumn("basis_dy", X.key_text("basis_dy"))


def _orders_customer_nation(spark, d):
    j = J.equi_join(t(spark, d, "orders"), t(spark, d, "customer"), "o_custkey", "c_custkey")
    return J.dim_lookup(j, nation_dim(spark, d), "c_nationkey", "n_nationkey")


@query
def join_four_mixed(spark, d):
    j = J.aggregated_join(_orders_customer_nation(spark, d), order_totals(t(spark, d, "lineitem")), "o_orderkey",
                          "l_orderkey", how="left")
    return j.select("o_orderkey", "c_name", "n_name", "line_count", "qty_total", "o_totalprice")


@query
def join_dim_filter(spark, d):
    orders = P.where(t(spark, d, "orders"), P.eq("o_orderstatus", "F"), P.between(
        "o_orderdate", X.ts("1997-01-01 00:00:00"), X.ts("1998-12-31 00:00:00")))
    j = J.equi_join(orders, t(spark, d, "customer"), "o_custkey", "c_custkey")
    j = J.dim_lookup(j, nation_dim(spark, d), "c_nationkey", "n_nationkey", dim_filter=P.eq("zone", "ASIA"))
    out = j.select("n_name", basis_dy("o_orderdate").alias("basis_dy"), "o_orderkey", "o_totalprice")
    return O.order_by(out, ["-o_totalprice", "o_orderkey"])


@query
def join_left_coalesce(spark, d):
    out = docs_labels(spark, d).select(
        "doc_id", X.case_map("lang", LANG_LABELS, "other").alias("lang_name"),
        X.coalesce_default("quality", 0).alias("quality"))
    return O.order_by(out, ["doc_id"])


# --- A: aggregates -----------------------------------------------------------

@query
def agg_basic(spark, d):
    li = t(spark, d, "lineitem").withColumn("basis_ym", X.date_key("l_shipdate", "yyyyMM"))
    out = A.group_agg(li, ["basis_ym"], [
        A.count_rows("n_lines"), F.sum("l_quantity").alias("sum_qty"),
        X.round_to(X.money_sum("l_extendedprice"), 1).alias("total_price")])
    return O.order_by(out.withColumn("basis_ym", X.key_text("basis_ym", "yyyyMM")), ["basis_ym"])


@query
def agg_count_col(spark, d):
    return A.group_agg(docs_labels(spark, d), ["lang"], [
        A.count_rows("n_docs"), A.count_values("quality", "n_labeled")])


@query
def agg_stats(spark, d):
    out = A.group_agg(t(spark, d, "lineitem"), ["l_returnflag"], [
        A.count_rows("n_lines"), X.round_to(F.avg("l_quantity"), 0).alias("avg_qty"),
        F.max("l_quantity").alias("max_qty"), F.min("l_quantity").alias("min_qty")])
    return O.order_by(out, ["-avg_qty", "l_returnflag"])


@query
def agg_round(spark, d):
    li = t(spark, d, "lineitem")
    # cents x hundredths: exact whole numbers, turned into money once per group
    disc_price = X.cents("l_extendedprice") * (F.lit(100).cast("bigint") - X.cents("l_discount"))
    out = A.group_agg(li, ["l_returnflag", "l_linestatus"], [
        X.round_to(X.from_units(F.sum(disc_price), 4), 2).alias("sum_disc_price"),
        X.round_to(X.money_sum("l_extendedprice"), 1).alias("sum_price"),
        X.round_to(F.avg("l_quantity"), 0).alias("avg_qty")])
    return O.order_by(out, ["l_returnflag", "l_linestatus"])


@query
def round_rows(spark, d):
    bal = X.money("c_acctbal")
    return t(spark, d, "customer").select(
        "c_custkey", "c_acctbal", X.round_to(bal, 1).alias("to_tenths"), X.round_to(bal, 0).alias("to_units"),
        X.round_to(bal, -2).alias("to_hundreds"))


@query
def agg_multi_key(spark, d):
    li = P.where(t(spark, d, "lineitem"), P.between(
        "l_shipdate", X.ts("1996-01-01 00:00:00"), X.ts("2000-12-31 00:00:00")))
    li = li.withColumn("basis_year", X.date_key("l_shipdate", "yyyy"))
    out = A.having(A.group_agg(li, ["basis_year", "l_returnflag"], [F.sum("l_quantity").alias("sum_qty")]),
                   F.col("sum_qty") >= 70000)
    out = out.withColumn("basis_year", X.key_text("basis_year", "yyyy"))
    return O.order_by(out, ["-sum_qty", "basis_year", "l_returnflag"])


@query
def having_avg(spark, d):
    out = A.group_agg(t(spark, d, "lineitem"), ["l_linenumber"], [
        X.round_to(F.avg("l_quantity"), 0).alias("avg_qty"), F.avg("l_quantity").alias("__avg")])
    out = A.having(out, F.col("__avg") >= 25.5).drop("__avg")
    return O.order_by(out, ["-avg_qty", "l_linenumber"])


@query
def where_group_having(spark, d):
    orders = P.where(t(spark, d, "orders"), P.compare("o_orderdate", ">=", X.ts("1999-01-01 00:00:00")))
    out = A.group_agg(orders, ["o_custkey"], [X.money_sum("o_totalprice").alias("__total"),
                                              A.count_rows("n_orders")])
    out = A.having(out, F.col("__total") >= 1000000).select(
        "o_custkey", X.to_double(F.col("__total")).alias("total_price"), "n_orders")
    return O.order_by(out, ["-total_price", "o_custkey"])


def _monthly_qty(spark, d):
    return t(spark, d, "lineitem").withColumn("basis_ym", X.date_key("l_shipdate", "yyyyMM"))


@query
def having_scalar_subquery(spark, d):
    li = _monthly_qty(spark, d)
    totals = A.group_agg(li, ["basis_ym"], [F.sum("l_quantity").alias("sum_qty")])
    # The subquery averages the same per-month totals, so it is derived from
    # the same frame and Spark reuses one shuffle of lineitem for both.
    avg = totals.agg(F.avg("sum_qty").alias("avg_total"))
    kept = A.at_least_scalar(totals, "sum_qty", avg).withColumn("basis_ym", X.key_text("basis_ym", "yyyyMM"))
    return O.order_by(kept, ["-sum_qty", "basis_ym"])


@query
def cond_agg_pivot(spark, d):
    li = t(spark, d, "lineitem").withColumn("basis_year", X.date_key("l_shipdate", "yyyy"))
    out = A.pivot_sums(li, ["basis_year"], "l_returnflag",
                       {"returned_qty": "R", "accepted_qty": "A", "none_qty": "N"}, "l_quantity", "total_qty")
    return O.order_by(out.withColumn("basis_year", X.key_text("basis_year", "yyyy")), ["basis_year"])


@query
def group_code_label(spark, d):
    li = t(spark, d, "lineitem").withColumn("basis_year", X.date_key("l_shipdate", "yyyy"))
    label = X.case_map("l_returnflag", {"R": "returned"}, "other")
    out = A.group_then_label(li, ["basis_year"], "l_returnflag", label, "return_name",
                             [F.sum("l_quantity").alias("sum_qty")])
    return O.order_by(out.withColumn("basis_year", X.key_text("basis_year", "yyyy")), ["basis_year", "-sum_qty"])


@query
def agg_of_agg(spark, d):
    return A.avg_of_group_totals(t(spark, d, "lineitem"), ["l_suppkey"], "l_quantity", "avg_total")


@query
def join_agg(spark, d):
    j = J.equi_join(t(spark, d, "orders"), t(spark, d, "customer"), "o_custkey", "c_custkey")
    out = A.aggregate_then_look_up(j, ["c_mktsegment"], "c_nationkey", nation_dim(spark, d), "n_nationkey",
                                   ["n_name", "c_mktsegment"], {
                                       "n_orders": A.counted(),
                                       "total_price": money_measure("o_totalprice", X.to_double)})
    return O.order_by(out, ["n_name", "c_mktsegment"])


# --- O: sorts, limits; U: union --------------------------------------------------

@query
def order_desc(spark, d):
    return O.order_by(t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"),
                      ["-o_totalprice", "o_orderkey"])


@query
def order_mixed(spark, d):
    orders, li = t(spark, d, "orders"), t(spark, d, "lineitem")
    j = J.equi_join(orders, li, "o_orderkey", "l_orderkey")
    out = j.select(X.date_key("o_orderdate").alias("basis_dy"), "o_orderkey", "l_linenumber", "l_extendedprice")
    out = O.order_by(out, ["basis_dy", "-l_extendedprice", "o_orderkey", "l_linenumber"])
    return out.withColumn("basis_dy", X.key_text("basis_dy"))


@query
def order_alias(spark, d):
    orders = t(spark, d, "orders").withColumn("basis_ym", X.date_key("o_orderdate", "yyyyMM"))
    out = A.group_agg(orders, ["basis_ym"], [money_total("o_totalprice", "total_price")])
    return O.order_by(out.withColumn("basis_ym", X.key_text("basis_ym", "yyyyMM")), ["-total_price", "basis_ym"])


@query
def order_hidden_col(spark, d):
    df = P.where(docs_labels(spark, d), P.is_not_null("quality")).select("doc_id", "lang", "quality")
    df = O.order_by(df, ["quality", "doc_id"])   # sorts on a column the output drops (O5)
    return df.select("doc_id", "lang", X.coalesce_default(F.col("quality").cast("string"), "unlabeled").alias("quality_text"))


@query
def limit_n(spark, d):
    return _orders_brief(O.limit_n(t(spark, d, "orders"), 10, ["o_orderkey"]))


@query
def top_k(spark, d):
    return O.top_k(t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), 20,
                   ["-o_totalprice", "o_orderkey"])


@query
def union_distinct(spark, d):
    return O.union_distinct(t(spark, d, "orders").select(F.col("o_custkey").alias("custkey")),
                            t(spark, d, "customer").select("c_custkey"))


# --- C: CASE / COALESCE --------------------------------------------------------

@query
def case_simple(spark, d):
    o = t(spark, d, "orders")
    return o.select("o_orderkey", basis_dy("o_orderdate").alias("basis_dy"), "o_orderpriority",
                    X.case_map("o_orderpriority", PRIORITY_LABELS, "other").alias("priority_name"),
                    "o_totalprice")


@query
def case_searched(spark, d):
    return t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag",
        X.case_flag(flagged(), "flagged", "unflagged").alias("return_status"))


@query
def case_bands(spark, d):
    out = t(spark, d, "orders").select("o_orderkey", "o_totalprice",
                                       X.case_bands("o_totalprice", SIZE_BANDS, "small").alias("size_band"))
    return O.order_by(out, ["-o_totalprice", "o_orderkey"])


@query
def case_no_else(spark, d):
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus",
                                          X.case_map("l_linestatus", {"F": "filled"}).alias("status_name"))


@query
def coalesce_zero(spark, d):
    return docs_labels(spark, d).select("doc_id", F.col("quality").alias("quality_raw"),
                                        X.coalesce_default("quality", 0).alias("quality"))


@query
def coalesce_chain(spark, d):
    return t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_discount", "l_tax",
        (X.coalesce_chain(rate_chain(), 0.0) * F.lit(100)).alias("rate_pct"))


@query
def coalesce_text(spark, d):
    return docs_labels(spark, d).select(
        "doc_id", X.coalesce_default(F.col("quality").cast("string"), "unlabeled").alias("quality_text"))


@query
def case_in_clauses(spark, d):
    o = t(spark, d, "orders")
    band = X.case_bands("o_totalprice", SIZE_BANDS, "small")
    finished = X.case_when([(P.eq("o_orderstatus", "F"), 1)], 0) == F.lit(1)
    out = A.group_agg(o.filter(finished), [band.alias("size_band")], [A.count_rows("n_orders")])
    rank = X.case_map("size_band", {"large": "1", "medium": "2"}, "3")
    return O.order_by(out, [rank])


@query
def coalesce_case(spark, d):
    return t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (X.coalesce_chain(rate_chain(), 0.0) * F.lit(100)).alias("rate_pct"),
        X.case_flag(flagged(), "flagged", "unflagged").alias("return_status"))


# --- R: composite reports --------------------------------------------------------

def _orders_with_nation(spark, d):
    """orders JOIN customer: the snapshot fact with its region code attached."""
    orders = t(spark, d, "orders").withColumn("basis_year", X.date_key("o_orderdate", "yyyy"))
    return J.equi_join(orders, t(spark, d, "customer").select("c_custkey", "c_nationkey"),
                       "o_custkey", "c_custkey")


def _year_text(df: DataFrame) -> DataFrame:
    """The integer year key of a (small) result back as ``YYYY`` text; order is kept."""
    return df.withColumn("basis_year", X.key_text("basis_year", "yyyy"))


@query
def report_status(spark, d):
    return _year_text(R.status_report(
        _orders_with_nation(spark, d), nation_dim(spark, d),
        fact_region="c_nationkey", dim_key="n_nationkey", dim_cols=["n_name", "zone"],
        date_col="basis_year", product_code="o_orderstatus", product_labels=STATUS_LABELS,
        other_label="other", label_name="status_name",
        measures={"n_orders": A.counted(), "total_price": money_measure("o_totalprice", lambda c: X.round_to(c, 1))},
        sort=["-basis_year", "-n_orders", "n_name", "status_name"]))


@query
def report_integrated(spark, d):
    orders = t(spark, d, "orders")
    since = P.compare("o_orderdate", ">=", X.ts("2000-01-01 00:00:00"))
    return R.integrated_detail(
        orders, t(spark, d, "customer"), nation_dim(spark, d), order_totals(t(spark, d, "lineitem")),
        head_keys=["o_custkey"], amount_keys=["c_custkey"], head_region="c_nationkey",
        dim_key="n_nationkey", detail_key="l_orderkey", head_detail_key="o_orderkey",
        since=since, head_unique=DRIVER_KEYS["orders"] == ["o_orderkey"],
        select=[F.col("o_orderkey"), F.col("n_name"), F.col("c_acctbal"), F.col("o_totalprice")],
        coalesce={"qty_total": ("qty_total", 0.0), "line_count": ("line_count", 0)},
        sort=["o_orderkey"])


ZONES = {"africa_price": "AFRICA", "america_price": "AMERICA", "asia_price": "ASIA",
         "europe_price": "EUROPE", "middle_east_price": "MIDDLE EAST"}


def _zone_pivot(spark, d):
    fact = _orders_with_nation(spark, d).withColumn("price", X.cents("o_totalprice"))
    return R.zone_pivot(fact, nation_dim(spark, d), fact_region="c_nationkey", dim_key="n_nationkey",
                        zone_col="zone", date_col="basis_year", zones=ZONES, value="price",
                        total="total_price")


def _cents_as_money(df: DataFrame, keep: list[str]) -> DataFrame:
    """Whole-cent totals (every column but ``keep``) as money, returned as DOUBLE."""
    return df.select(*keep, *[X.to_double(X.from_cents(F.col(c))).alias(c) for c in df.columns if c not in keep])


@query
def report_zone_pivot(spark, d):
    return _year_text(_cents_as_money(_zone_pivot(spark, d), ["basis_year"]))


@query
def report_price(spark, d):
    li = t(spark, d, "lineitem")
    people = t(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return R.price_detail(
        li, people, key="l_orderkey", people_key="o_orderkey", chain=rate_chain(), default=0.0, unit=100,
        flag=flagged(), flag_labels=("flagged", "unflagged"),
        keep=[F.col("l_orderkey"), F.col("l_linenumber")], person_cols=[F.col("o_orderpriority")],
        price_name="rate_pct", flag_name="return_status", sort=["l_orderkey", "l_linenumber"])


@query
def report_above_average(spark, d):
    base = t(spark, d, "orders").withColumn("basis_year", X.date_key("o_orderdate", "yyyy")).withColumn(
        "price", X.cents("o_totalprice"))
    kept = R.above_average(_zone_pivot(spark, d), "total_price", base, "basis_year", "price")
    return _year_text(_cents_as_money(kept, ["basis_year"]))


@query
def report_label_totals(spark, d):
    orders = t(spark, d, "orders").withColumn("basis_year", X.date_key("o_orderdate", "yyyy"))
    return _year_text(R.label_totals(orders, date_col="basis_year", code="o_orderpriority", labels=PRIORITY_LABELS,
                                     other_label="other", label_name="priority_name",
                                     aggs=[A.count_rows("n_orders"), money_total("o_totalprice", "total_price")],
                                     sort=["basis_year", "-total_price"]))


@query
def report_product_pivot(spark, d):
    orders = t(spark, d, "orders").withColumn("basis_year", X.date_key("o_orderdate", "yyyy")).withColumn(
        "price", X.cents("o_totalprice"))
    out = R.product_pivot(orders, date_col="basis_year", code="o_orderstatus",
                          products={"finished_price": "F", "open_price": "O"}, value="price",
                          total="total_price")
    return _year_text(_cents_as_money(out, ["basis_year"]))

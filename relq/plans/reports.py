"""Composite reports (R1-R7) built from the operators.

Each report takes DataFrames and column roles, so the same code runs on the
course's housing tables (unit tests) and on any fact/dimension pair with the
same shape (the driver queries in ``relq.plans.catalog``).

Roles:
  fact          snapshot fact with a date text column and a region code
  dim           code dimension: id, name, zone (bounded by its code domain)
  product code  a code column labelled by a simple CASE
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relq.functions.expressions import case_map, coalesce_default
from relq.operators.aggregates import (
    Measure, aggregate_then_look_up, at_least_scalar, avg_of_group_totals, group_then_label, pivot_sums)
from relq.operators.joins import aggregated_join, dim_lookup, equi_join
from relq.operators.ordering import order_by


def status_report(fact: DataFrame, dim: DataFrame, *, fact_region: str, dim_key: str,
                  dim_cols: Sequence[str], date_col: str, product_code: str,
                  product_labels: Mapping[str, str], other_label: str, measures: Mapping[str, Measure],
                  sort: Sequence[str | Column], dim_filter: Column | None = None,
                  label_name: str = "product_name") -> DataFrame:
    """Totals by date x region x zone x product label.

    Summed by date, region code and raw product code first, so the dimension
    is looked up for the few sums, not for every fact row.  The raw product
    code stays a key so unknown codes stay separate rows (M14); then the
    label, then the final sort.
    """
    dim = dim if dim_filter is None else dim.filter(dim_filter)
    out = aggregate_then_look_up(fact, [date_col, product_code], fact_region, dim, dim_key,
                                 [date_col, *dim_cols, product_code], measures)
    label = case_map(product_code, product_labels, other_label).alias(label_name)
    return order_by(out.select(date_col, *dim_cols, label, *measures), sort)


def zone_pivot(fact: DataFrame, dim: DataFrame, *, fact_region: str, dim_key: str, zone_col: str,
               date_col: str, zones: Mapping[str, str], value: str, total: str,
               dim_filter: Column | None = None, cast=None) -> DataFrame:
    """One row per date, one column per zone plus the all-zone total.

    ``zones`` maps output column -> zone value.  Sums by date and region code,
    then the zone of each code, then conditional sums; an empty zone gives 0,
    not NULL.
    """
    dim = dim if dim_filter is None else dim.filter(dim_filter)
    by_zone = aggregate_then_look_up(fact, [date_col], fact_region, dim, dim_key, [date_col, zone_col],
                                     {value: Measure(F.sum(value))})
    return order_by(pivot_sums(by_zone, [date_col], zone_col, zones, value, total, cast), [date_col])


def above_average(pivot: DataFrame, total: str, base: DataFrame, base_date: str,
                  base_value: str) -> DataFrame:
    """Pivot rows whose total is at least the average per-date total.

    The average is taken over ``base`` -- the unjoined fact -- grouped by
    date, exactly as the course's subquery does; it may differ from the
    joined totals when codes are missing from the dimension.  It is an
    uncorrelated scalar subquery evaluated once inside the plan.
    """
    avg = avg_of_group_totals(base, [base_date], base_value)
    return order_by(at_least_scalar(pivot, total, avg), [f"-{total}"])


def integrated_detail(head: DataFrame, amount: DataFrame, dim: DataFrame, detail: DataFrame, *,
                      head_keys: Sequence[str], amount_keys: Sequence[str], head_region: str,
                      dim_key: str, detail_key: str, head_detail_key: str, since: Column,
                      select: Sequence[Column], coalesce: Mapping[str, tuple[str, object]],
                      sort: Sequence[str | Column], dim_filter: Column | None = None, head_unique: bool = False) -> DataFrame:
    """R2: head JOIN amount (composite key) JOIN dim LEFT JOIN detail, since a date.

    ``since`` is a predicate on the head table, applied before the joins so
    it reaches the scan.  ``coalesce`` maps output name -> (detail column,
    default) for the optional side, which has a row for each key.

    ``head_unique``: the head's ``head_detail_key`` is declared unique.  Then no
    key is hot on either side of the last join, the detail's own partitioning
    by that key serves it, and only the head is shuffled.  Where few enough
    head rows are kept, Spark builds a Bloom filter of their keys at run time
    (``session.RUNTIME_FILTER``) and pushes it below the detail's aggregate
    into its scan; a saturated filter would keep everything, so beyond its size
    Spark leaves it out.
    """
    base = head.filter(since)
    same = list(head_keys) == list(amount_keys)
    joined = equi_join(base, amount, list(head_keys), None if same else list(amount_keys))
    joined = dim_lookup(joined, dim, head_region, dim_key, dim_filter=dim_filter)
    with_detail = equi_join if head_unique else aggregated_join
    joined = with_detail(joined, detail, head_detail_key, None if head_detail_key == detail_key else detail_key, how="left")
    extra = [coalesce_default(src, default).alias(name) for name, (src, default) in coalesce.items()]
    return order_by(joined.select(*select, *extra), sort)


def label_totals(fact: DataFrame, *, date_col: str, code: str, labels: Mapping[str, str],
                 other_label: str, aggs: Sequence[Column], sort: Sequence[str | Column],
                 label_name: str = "product_name") -> DataFrame:
    """Date x product-label totals, grouped by the raw code."""
    grouped = group_then_label(fact, [date_col], code, case_map(code, labels, other_label),
                               label_name, aggs)
    return order_by(grouped, sort)


def product_pivot(fact: DataFrame, *, date_col: str, code: str, products: Mapping[str, str],
                  value: str, total: str, cast=None) -> DataFrame:
    """Per date, one conditional-sum column per product code plus the total."""
    return order_by(pivot_sums(fact, [date_col], code, products, value, total, cast), [date_col])


def price_detail(prices: DataFrame, people: DataFrame, *, key: str, people_key: str,
                 chain: Sequence[Column], default, unit: float, flag: Column,
                 flag_labels: tuple[str, str], keep: Sequence[Column], person_cols: Sequence[Column],
                 price_name: str, flag_name: str, sort: Sequence[str | Column]) -> DataFrame:
    """Price by priority chain x unit, source label, LEFT JOIN person attributes."""
    price = (F.coalesce(*chain, F.lit(default)) * F.lit(unit)).alias(price_name)
    source = F.when(flag, F.lit(flag_labels[0])).otherwise(F.lit(flag_labels[1])).alias(flag_name)
    joined = equi_join(prices, people, key, None if key == people_key else people_key, how="left")
    return order_by(joined.select(*keep, price, source, *person_cols), sort)

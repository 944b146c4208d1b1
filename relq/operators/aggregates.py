"""Aggregations.

Every grouped aggregate is planned as a partial aggregate in each task,
a shuffle of one row per (task, group), and a final aggregate.  A group
holding a third of all rows therefore costs one partial row per task, not a
third of the data in one task.  Nothing is collected on the driver: even the
scalar subquery of A12 stays inside the plan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relq.functions.expressions import ColumnOrName, col


@dataclass(frozen=True)
class Measure:
    """A total that can be summed in two steps: ``partial`` (an aggregate) by
    fine keys, then the sum of the partials by coarse keys, then ``finish``."""

    partial: Column
    finish: Callable[[Column], Column] = lambda total: total


def counted() -> Measure:
    """``COUNT(*)`` as a two-step total."""
    return Measure(F.count(F.lit(1)))


def aggregate_then_look_up(df: DataFrame, keys: Sequence[str], code: str, dim: DataFrame, dim_key: str,
                           out_keys: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    """``df JOIN dim ON code = dim_key GROUP BY out_keys``, aggregated first.

    The rows are summed by ``keys`` and the code, so that only a row for each
    of these meets the dimension; names are looked up there, and the sums are
    added up by ``out_keys`` (names may repeat).
    """
    fine = df.groupBy(*keys, code).agg(*[m.partial.alias(f"__{n}") for n, m in measures.items()])
    named = fine.join(dim, fine[code] == dim[dim_key], "inner")
    return named.groupBy(*out_keys).agg(*[m.finish(F.sum(f"__{n}")).alias(n) for n, m in measures.items()])


def group_agg(df: DataFrame, keys: Sequence[ColumnOrName], aggs: Sequence[Column]) -> DataFrame:
    """``SELECT keys, aggs FROM df GROUP BY keys`` (A1-A9); no keys = one global row."""
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def having(df: DataFrame, pred: Column) -> DataFrame:
    """``HAVING pred`` on an aggregated frame (A10)."""
    return df.filter(pred)


def count_rows(alias: str = "n_rows") -> Column:
    """``COUNT(*)`` (A1): counts rows, NULLs included."""
    return F.count(F.lit(1)).alias(alias)


def count_values(c: ColumnOrName, alias: str) -> Column:
    """``COUNT(c)`` (A2): non-NULL values only."""
    return F.count(col(c)).alias(alias)


def cond_sum(cond: Column, value: ColumnOrName, otherwise=0) -> Column:
    """``SUM(CASE WHEN cond THEN value ELSE 0 END)``.

    The ELSE 0 makes an empty category 0 rather than NULL, unlike
    ``groupBy().pivot()``.
    """
    return F.sum(F.when(cond, col(value)).otherwise(F.lit(otherwise)))


def pivot_sums(df: DataFrame, keys: Sequence[ColumnOrName], category: ColumnOrName,
               categories: Mapping[str, object], value: ColumnOrName, total: str | None,
               cast: Callable[[Column], Column] | None = None) -> DataFrame:
    """One-pass pivot by conditional sums.

    ``categories`` maps an output column to the category value it sums.
    All columns come from a single scan and a single aggregate.
    """
    cat = col(category)
    wrap = cast or (lambda c: c)
    aggs = [wrap(cond_sum(cat == F.lit(v), value)).alias(name) for name, v in categories.items()]
    if total:
        aggs.append(wrap(F.sum(col(value))).alias(total))
    return group_agg(df, keys, aggs)


def group_then_label(df: DataFrame, keys: Sequence[str], code: str, label: Column,
                     label_name: str, aggs: Sequence[Column]) -> DataFrame:
    """Group by the raw code, then label it.

    Grouping by the label would merge two unknown codes into one "other"
    row; grouping by the code keeps them apart, as ``GROUP BY code`` with a
    ``CASE code ..`` in the SELECT list does.  ``label`` must be an
    expression over ``code``.
    """
    grouped = df.groupBy(*keys, code).agg(*aggs)
    agg_names = [c for c in grouped.columns if c not in set(keys) | {code}]
    return grouped.select(*keys, label.alias(label_name), *agg_names)


def avg_of_group_totals(df: DataFrame, keys: Sequence[ColumnOrName], value: ColumnOrName,
                        alias: str = "avg_total") -> DataFrame:
    """``SELECT AVG(t) FROM (SELECT SUM(value) AS t .. GROUP BY keys)`` (A15): one row."""
    totals = df.groupBy(*keys).agg(F.sum(col(value)).alias("__total"))
    return totals.agg(F.avg("__total").alias(alias))


def at_least_scalar(df: DataFrame, c: ColumnOrName, scalar: DataFrame) -> DataFrame:
    """``HAVING c >= (SELECT <one value> ..)``.

    ``scalar`` is a one-row, one-column frame used as an uncorrelated scalar
    subquery: it runs once and its value is compared in place, with no join.
    """
    return df.filter(col(c) >= scalar.scalar())

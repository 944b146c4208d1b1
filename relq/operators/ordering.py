"""Sorts, limits, top-k (O1-O7) and UNION.

A global ``ORDER BY`` range-partitions rows by sampled sort-key bounds and
sorts each range; it is the last step of a query.  Rows that are equal in all
keys share a range partition: end the keys with a unique one, or ask
``order_by`` for tiebreakers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sort_key(spec: str | Column) -> Column:
    """``"c"`` ascending, ``"-c"`` descending, or a ready ``Column``.

    Defaults follow the course engine: NULLs first ascending, last descending.
    """
    if isinstance(spec, Column):
        return spec
    if spec.startswith("-"):
        return F.col(spec[1:]).desc_nulls_last()
    return F.col(spec).asc_nulls_first()


# Never used as tiebreakers: types Spark cannot sort by, and values of any
# length, whose samples would go to the driver as range bounds.
_UNORDERED = (T.StringType, T.BinaryType, T.ArrayType, T.StructType) + tuple(t for t in (T.MapType, getattr(T, "VariantType", None), T.CalendarIntervalType) if t)


def _named(spec: str | Column) -> str | None:
    return (spec[1:] if spec.startswith("-") else spec) if isinstance(spec, str) else None


def order_by(df: DataFrame, specs: Sequence[str | Column], tiebreak: bool = False) -> DataFrame:
    """``ORDER BY k1 [ASC|DESC], k2 ...``.

    Output aliases (O4) and source columns absent from the final projection
    (O5) are both sortable as long as the sort runs before that projection.

    With ``tiebreak`` the remaining number, date and boolean columns are
    appended as ascending keys.  SQL leaves the order of ties open, so the result is the
    same ORDER BY; but rows that share a hot sort value no longer all fall
    into one range partition, they are split wherever they differ.
    """
    if not specs:
        return df
    keys = [sort_key(s) for s in specs]
    if tiebreak:
        used = {_named(s) for s in specs}
        keys += [F.col(f"`{f.name}`").asc_nulls_first() for f in df.schema.fields
                 if f.name not in used and not isinstance(f.dataType, _UNORDERED)]
    return df.orderBy(*keys)


def top_k(df: DataFrame, k: int, specs: Sequence[str | Column]) -> DataFrame:
    """``ORDER BY .. LIMIT k`` (O7): each task keeps its best ``k`` rows, one
    task merges them (``TakeOrderedAndProject``); no full sort or shuffle."""
    return order_by(df, specs).limit(k)


def limit_n(df: DataFrame, n: int, specs: Sequence[str | Column] | None = None) -> DataFrame:
    """``LIMIT n`` (O6).  Without ``specs`` which rows come back is unspecified;
    with them it is a top-k by those keys."""
    return top_k(df, n, specs) if specs else df.limit(n)


def union_distinct(first: DataFrame, second: DataFrame) -> DataFrame:
    """``q1 UNION q2`` (U1): columns matched by position, duplicates removed."""
    return first.union(second).distinct()

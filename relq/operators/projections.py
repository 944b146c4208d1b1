"""Projections.

Projections are narrow: no shuffle, and Catalyst prunes the Parquet scan to
the referenced columns (``ReadSchema`` shows only them).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def project(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    """``SELECT a, b, c`` (P1) or ``SELECT *`` with ``["*"]``."""
    return df.select(*cols)


def project_as(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """``SELECT expr AS alias, ...`` (P3, P5, P6): output name -> source column/expression."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in mapping.items()])


def with_display_names(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Final renaming to display labels (e.g. Korean or ``감정가(억)``).

    Operators work on snake_case names; labels that Spark SQL text cannot
    hold unquoted are applied last through the DataFrame API.
    """
    return df.withColumnsRenamed(dict(names))


def distinct_values(df: DataFrame, cols: Sequence[str | Column], where: Column | None = None) -> DataFrame:
    """``SELECT DISTINCT a[, b ..] [WHERE p]``.

    Planned as a two-phase hash aggregate: each task dedups its rows before
    the shuffle, so a value held by many rows costs one row per task.
    """
    if where is not None:
        df = df.filter(where)
    return df.select(*cols).distinct()


def label_codes(df: DataFrame, code: str, labels: dict[str, str], out: str,
                default: str | None = None) -> DataFrame:
    """Add ``out`` = label of ``code`` (C1): ``CASE code WHEN .. THEN .. ELSE default END``.

    The list is a constant map looked up in the projection, one hash probe a
    row at any length, with its keys in the column's type.  Codes missing from
    the list get ``default``, NULL codes too.
    """
    kind = df.schema[code].dataType
    pairs = [x for key, label in labels.items() for x in (F.lit(key).cast(kind), F.lit(label))]
    label = F.try_element_at(F.create_map(*pairs), F.col(code)) if pairs else F.lit(None).cast(T.StringType())
    return df.withColumn(out, label if default is None else F.coalesce(label, F.lit(default)))

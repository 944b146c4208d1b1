"""Table sources and sinks.

* ``read_table``  -- declared-schema Parquet scan (S1, S3).  The scan is lazy;
  column pruning and filter pushdown reach it through Catalyst.
* ``read_footers`` -- the same table for counts taken from its footers (S8).
* ``register_views`` -- temp views for the SQL entry (S5).
* ``scan_all`` / ``scan_ordered`` -- full scan and ordered scan (S3, S4).
* ``write_snapshots`` -- persist a snapshot fact partitioned by its date
  column so date predicates prune whole folders (S2).
* ``load_snapshots`` -- load or reload single dates of it, checked first (S2).
* ``write_bucketed`` -- persist facts bucketed by their join key so
  repeated fact-to-fact joins run without a shuffle.
* ``preview`` / ``write_result`` -- result sinks, the latter with the row count
  observed while it writes (S6).
"""

from __future__ import annotations

import atexit
import os
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relq.operators.checks import duplicate_keys
from relq.session import shared_folder
from relq.sources.schemas import DRIVER_SCHEMAS, HOUSING_SCHEMAS


def table_path(base_dir: str, name: str) -> str:
    return os.path.join(base_dir, f"{name}.parquet")


def read_table(spark: SparkSession, base_dir: str, name: str,
               schema: T.StructType | None = None) -> DataFrame:
    """Scan ``<base_dir>/<name>.parquet`` with its declared schema."""
    schema = schema or DRIVER_SCHEMAS.get(name) or HOUSING_SCHEMAS.get(name)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(table_path(base_dir, name))


_V1 = "spark.sql.sources.useV1SourceList"


def read_footers(spark: SparkSession, base_dir: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """The same table for counts that Parquet footers hold.

    Planned by Spark's second file reader, which pushes ungrouped COUNT, MIN
    and MAX into the scan where ``spark.sql.parquet.aggregatePushdown`` is on
    (``session.configure`` sets it): the executors then read footers only.
    Anything else -- a filter, a grouping -- is an ordinary scan.  Footers
    without NULL counts (written with statistics switched off) make Spark
    refuse the query; use ``read_table`` there.
    """
    old = spark.conf.get(_V1)
    spark.conf.set(_V1, ",".join(x for x in old.split(",") if x != "parquet"))
    try:
        return read_table(spark, base_dir, name, schema)
    finally:
        spark.conf.set(_V1, old)


def register_views(spark: SparkSession, base_dir: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Register each table as a temp view of the same name; return the frames."""
    frames = {}
    for name in names:
        df = read_table(spark, base_dir, name)
        df.createOrReplaceTempView(name)
        frames[name] = df
    return frames


def from_rows(spark: SparkSession, name: str, rows: Sequence[tuple]) -> DataFrame:
    """Literal rows with a declared schema (unit fixtures only)."""
    return spark.createDataFrame(list(rows), HOUSING_SCHEMAS.get(name) or DRIVER_SCHEMAS[name])


def scan_all(df: DataFrame) -> DataFrame:
    """``SELECT * FROM t``."""
    return df.select("*")


def _sort_col(spec: str | Column) -> Column:
    if isinstance(spec, Column):
        return spec
    if spec.startswith("-"):
        return F.col(spec[1:]).desc()
    return F.col(spec).asc()


def scan_ordered(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """``SELECT * FROM t ORDER BY k1, k2, ...``.

    A global sort range-partitions the rows; end ``keys`` with a unique key
    so that no single sort value (a hot date, say) must land in one range
    partition and the order is total.
    """
    return df.orderBy(*[_sort_col(k) for k in keys])


def write_snapshots(df: DataFrame, path: str, date_col: str, mode: str = "overwrite", code_cols: Sequence[str] = ()) -> None:
    """Persist a snapshot fact laid out by its date column.

    ``code_cols``: code columns of few values that follow the date in the
    layout.  A join with a dimension filtered by an attribute (J10) then reads
    only the folders of the codes that are left: Spark filters the dimension
    first and prunes the fact's partitions at run time.

    The ``rebalance`` hint clusters each snapshot's rows before the write so
    tasks write few files, and lets AQE split a partition that outgrows the
    advisory size: a date holding a third of all rows is written by many
    tasks, not one.  A later ``WHERE date_col BETWEEN ..`` prunes folders
    instead of reading them.
    """
    layout = [date_col, *code_cols]
    df.hint("rebalance", *layout).write.mode(mode).partitionBy(*layout).parquet(path)


class SnapshotRefused(ValueError):
    """A snapshot load that failed its checks; the stored table is as it was."""


def load_snapshots(df: DataFrame, path: str, date_col: str, keys: Sequence[str],
                   expected: Mapping[str, int] | None = None) -> dict[str, int]:
    """Load whole snapshot dates into a stored fact; other dates stay as they are.

    Each date that ``df`` holds replaces that date's folder; the folders of
    other dates are not touched, so loading a date again is the same as loading
    it once.  Nothing is replaced before all of this holds:

    * no date is NULL, and none of the ``keys`` columns is NULL in any row;
    * no key value occurs twice within a date (``checks.duplicate_keys``);
    * where ``expected`` names a date, ``df`` has exactly so many rows of it,
      and every date named is there.

    The rows are written once to a folder beside the table that readers do not
    see, checked there -- so that what was checked is what is stored, even if
    the source changes or an executor is lost meanwhile -- and moved in by
    Spark's dynamic partition overwrite, whose commit is per date.  The rows are
    laid out as by ``write_snapshots``.  Returns the number of rows of each date
    (one small entry for each date loaded).
    """
    spark = df.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    incoming = f"{path.rstrip('/')}/_incoming-{uuid.uuid4().hex}"
    try:
        df.hint("rebalance", date_col).write.parquet(incoming)
        staged = spark.read.schema(df.schema).parquet(incoming)
        nulls = [F.sum(F.when(F.col(f"`{k}`").isNull(), 1).otherwise(0)).alias(f"null_{i}") for i, k in enumerate(keys)]
        found = {r[date_col]: r for r in staged.groupBy(date_col).agg(F.count(F.lit(1)).alias("rows"), *nulls).collect()}
        counts = {d: r["rows"] for d, r in found.items()}
        faults = ["rows without a date"] if None in found else []
        faults += [f"{r[f'null_{i}']} rows of {d} without {k}" for d, r in found.items() for i, k in enumerate(keys) if r[f"null_{i}"]]
        faults += [f"{counts.get(d, 0)} rows of {d}, {n} expected" for d, n in (expected or {}).items() if counts.get(d, 0) != n]
        twice = duplicate_keys(staged, [date_col, *[k for k in keys if k != date_col]])
        faults += [f"key {tuple(r)[:-1]} on {tuple(r)[-1]} rows" for r in twice.limit(5).collect()]
        if faults:
            raise SnapshotRefused("; ".join(faults))
        clustered = staged.hint("rebalance", date_col).write.partitionBy(date_col)
        clustered.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
        return counts
    finally:
        remove(spark, incoming)


_scratch: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the application ends."""
    path = f"{shared_folder(spark)}/relq-{name}-{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path


@atexit.register
def _clear() -> None:
    while _scratch:
        spark, path = _scratch.pop()
        try:
            remove(spark, path)
        except Exception:  # the session has already ended: nothing left to ask
            return


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage, if it is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int,
                   sort: bool = True, mode: str = "overwrite") -> DataFrame:
    """Save ``df`` as a catalog table bucketed (and sorted) by ``keys``.

    Two facts saved with the same keys and bucket count join on those keys
    without shuffling either side: every bucket of one meets the matching
    bucket of the other (the course's fact pair, joined on
    ``(BASIS_DY, GRNT_NO)``, is the case in point).  The table lives in the
    session's warehouse (``spark.sql.warehouse.dir``), the shared location
    the cluster configures.  Pick ``buckets`` so one bucket of the larger
    table is a few hundred MB.  The rows are shuffled by the bucket keys first,
    so a bucket is written by one task (a hot one by several) and the number
    of files stays near the number of buckets.  A join of bucketed tables has
    no shuffle for AQE to split, so a key holding a large share of the rows
    makes its bucket's task long; for such keys the shuffled join with AQE
    skew splitting is the safer plan.
    """
    writer = df.hint("rebalance", buckets, *keys).write.mode(mode).bucketBy(buckets, *keys)
    if sort:
        writer = writer.sortBy(*keys)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows of a result for display (the row cap is the feature)."""
    return df.limit(n)


def write_result(df: DataFrame, path: str, mode: str = "overwrite", keys: Sequence[str] = ()) -> dict[str, int]:
    """Persist a full result as Parquet and say how many rows it has.

    Executors write in parallel; the row count, and for each of ``keys`` the
    number of rows without it (``null_<key>``), are observed while the rows pass
    to the writer, so there is no second run of the query.
    """
    seen = Observation("result")
    nulls = [F.sum(F.when(F.col(f"`{k}`").isNull(), 1).otherwise(0)).alias(f"null_{k}") for k in keys]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls).write.mode(mode).parquet(path)
    return {name: value or 0 for name, value in seen.get.items()}

"""Tables written midway, in the folder that the whole cluster shares.

A stage whose rows are read several times is written once as Parquet below
``spark.checkpoint.dir``: later stages then survive lost executors without
running the earlier ones again, and all of them read the same rows.  The
files stay as long as a result that reads them may still be evaluated; they
are removed when the application ends (``atexit``) or by ``release``.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.  Unset, a new temporary folder in
    local mode, as in tests; on a cluster that is refused."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        # executors elsewhere could not see a folder of this machine
        raise RuntimeError("spark.checkpoint.dir must name a folder that the whole cluster shares")
    folder = tempfile.mkdtemp(prefix="relq-shared-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    ``compression="uncompressed"`` spares small tables that are written often
    the codec's buffers outside of the heap, which live until they are collected."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/relq-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Delete all staged tables; results that still read them become invalid."""
    while _written:
        spark, path = _written.pop()
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session has already ended: nothing left to ask
            return


atexit.register(release)

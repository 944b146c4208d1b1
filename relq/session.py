"""Session settings the operators rely on.

Every operator is a lazy DataFrame transformation; nothing here runs a job.
``configure`` only fills in settings the launcher left unset, so a
production session keeps whatever its administrators chose (shuffle
partitions, broadcast thresholds, checkpoint folder).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Adaptive execution re-plans joins and aggregations from runtime sizes:
# it coalesces small shuffle partitions, splits skewed join partitions
# (a hot key holding a large share of rows) and turns a sort-merge join
# into a broadcast join once a side is measured to be small.
# Which sides are broadcast is Spark's own size check, and how wide a shuffle
# starts is the launcher's choice; neither is set here.
ADAPTIVE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # COUNT, MIN and MAX from Parquet footers, for tables read by ``read_footers``.
    "spark.sql.parquet.aggregatePushdown": "true",
    # ANSI semantics: text/number mixes fail loudly instead of turning NULL.
    "spark.sql.ansi.enabled": "true",
}

# A join whose one side is filtered can spare rows of the other side before
# they are shuffled: Spark builds a Bloom filter of the kept keys at run time and
# pushes it into the other scan.  The filter never exceeds 8 MB (4 million keys);
# the side that it is built from may be this large by Spark's estimate, about
# what 4 million keys with a few columns come to.
RUNTIME_FILTER = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "128MB",
}

_CONFIGURED = "spark.relq.configured"


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``ADAPTIVE_DEFAULTS`` and ``RUNTIME_FILTER`` once, where neither the launcher nor the
    session's user has set a value; later changes of theirs stay."""
    if spark.conf.get(_CONFIGURED, None) == "true":
        return spark
    for key, value in (ADAPTIVE_DEFAULTS | RUNTIME_FILTER).items():
        if not spark.conf.isModifiable(key):
            continue
        if key not in _chosen(spark):
            spark.conf.set(key, value)
    spark.conf.set(_CONFIGURED, "true")
    return spark


def _chosen(spark: SparkSession) -> set[str]:
    """Names of the settings made at launch or on the session."""
    return set(spark.conf.getAll)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is.  Only when it is unset (local tests) is ``fallback`` set.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


_temporary: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that the whole cluster shares: ``spark.checkpoint.dir``.  Unset,
    a new temporary folder in local mode; on a cluster that is refused."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the whole cluster shares")
    if not _temporary:
        _temporary.append(tempfile.mkdtemp(prefix="relq-shared-"))
    return _temporary[0]


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local benchmark (one JVM, ``cores`` threads)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("relq")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)

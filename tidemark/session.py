"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that results or skew handling depend on. All of them can be set on a
# running session, so a session made by the caller can be brought in line.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot user is split even where the join feeds an aggregation on the same
    # key and splitting it costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Aggregates whose state has no fixed width (medians, latest rows) combine this
    # many keys per task in memory before they fall back to sorting; the default is
    # 128. A state here takes a few kilobytes, so a task needs up to about 100 MB.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "16384",
}

# For jobs over words, whose aggregates hold many times what a task reads: AQE merges
# partitions to this size and cannot split them outside joins, so there are many to
# begin with, and a scan deals stored counts out as finely. A side whose partitions are
# all small is hashed, so that joins by term don't sort the counts.
WORD_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m",
}

# Settings fixed when a session starts.
START_SETTINGS = {
    # Recording the Python call site of every column costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app: str = "tidemark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the defaults of this package.

    On a cluster leave ``shuffle_partitions`` unset or set it to a few times the
    number of cores: AQE merges small partitions but cannot split large ones
    outside joins.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**START_SETTINGS, **RUNTIME_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession, settings: dict[str, str] | None = None) -> SparkSession:
    """Apply the runtime settings, and others, to a session the caller made."""
    for key, value in {**RUNTIME_SETTINGS, **(settings or {})}.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    Only a local session that names none gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tidemark/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in this application's part of the shared folder; never reused between calls."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def discard(spark: SparkSession, path: str) -> bool:
    """Delete a scratch path that nothing reads any more; whether it was there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release_scratch(spark: SparkSession) -> bool:
    """Delete what this application has stored on the way; whether there was anything.

    For the end of a job, when its results are written: tables that were returned and
    not yet written read from there.
    """
    return discard(spark, _own_folder(spark))

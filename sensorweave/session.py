"""Session construction and lineage-cut helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library is written against. AQE is what turns a
# sort-merge join against a small per-recording table into a broadcast at run
# time (after measuring the real size) and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "sensorweave",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``master`` is only set when given, so on a cluster the launcher's master
    wins. Tests pass ``local[*]`` and a small ``shuffle_partitions``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    """``spark.sql.shuffle.partitions`` as a number (falls back to the
    default parallelism when the setting is not an integer)."""
    value = spark.conf.get("spark.sql.shuffle.partitions", None)
    try:
        return max(1, int(value))
    except (TypeError, ValueError):
        return max(1, spark.sparkContext.defaultParallelism)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    It must be storage that the driver and all executors share. Where it is
    unset, a cluster session is refused; only a ``local[...]`` session, whose
    executors are threads of the driver, gets a private folder, which is
    removed when the process ends.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not master.startswith("local[") and master != "local":
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share "
                               "(intermediate tables and stream progress are kept there)")
        current = tempfile.mkdtemp(prefix="sensorweave-local-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table, below :func:`scratch_root`."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def scratch_root(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables: one folder, so
    that :func:`clear_scratch` or the folder's owner can remove them at once."""
    return f"{checkpoint_dir(spark).rstrip('/')}/sensorweave-{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; frames that still read
    from them can't be used afterwards."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes made inside are removed as each write ends;
    else they take disk until the driver's JVM happens to collect garbage."""
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup)
    spark.conf.set(cleanup, "true")
    try:
        yield
    finally:
        spark.conf.set(cleanup, before)


def materialize(df: DataFrame, name: str, sort_by: list[str] | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet into the shared scratch folder and read it
    back: later branches scan the written table (with column pruning and
    statistics) instead of recomputing the lineage, and a lost executor only
    costs re-reading files. ``codec``: another one than the session's."""
    path = scratch_path(df.sparkSession, name)
    out = df
    if sort_by:
        n = shuffle_partitions(df.sparkSession)
        out = df.repartitionByRange(n, *sort_by).sortWithinPartitions(*sort_by)
    out.write.mode("overwrite").options(**({"compression": codec} if codec else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

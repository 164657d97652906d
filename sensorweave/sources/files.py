"""Expected-versus-found input reports, and what changed since the last run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.functions.paths import decoded_path


def expected_range(spark: SparkSession, name: str, first: int, last: int) -> DataFrame:
    """The enumerated subjects a layout promises (e.g. 1..30), as a frame."""
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias(name))


def missing_inputs(expected: DataFrame, found: DataFrame, on: str) -> DataFrame:
    """Expected keys with no input at all (left anti join on ``on``)."""
    return expected.join(found.select(on).distinct(), on=on, how="left_anti")


# ---------------------------------------------------------------- changed files

NEW, CHANGED, REMOVED, SAME = "new", "changed", "removed", "same"


def file_listing(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """``(path, length, modified)`` of the files below ``root``, from their
    listing: no file is opened. Files of length zero hold nothing and are not
    listed."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    path = decoded_path(F.col("_metadata.file_path")).alias("path")
    return reader.load(root).select(path, "length", F.unix_micros("modificationTime").alias("modified"))


def write_manifest(listing: DataFrame, path: str) -> DataFrame:
    """Store a listing for the next run's comparison. Each run writes a manifest
    of its own (a new ``path``): after a failed run the older one still holds."""
    listing.write.mode("errorifexists").parquet(path)
    return listing.sparkSession.read.schema(listing.schema).parquet(path)


def changed_files(listing: DataFrame, stored: DataFrame) -> DataFrame:
    """``(path, status)`` of all files of a listing and an earlier one: new,
    changed (another length or time), removed or the same."""
    now, then = listing.alias("now"), stored.select("path", F.col("length").alias("_length"), F.col("modified").alias("_modified"))
    both = now.join(then, "path", "full")
    status = (F.when(F.col("_length").isNull(), NEW).when(F.col("length").isNull(), REMOVED)
              .when((F.col("length") != F.col("_length")) | (F.col("modified") != F.col("_modified")), CHANGED).otherwise(SAME))
    return both.select("path", status.alias("status"))


def paths_to_read(changes: DataFrame) -> list[str]:
    """The new and changed files, as a root for the readers. Their names are
    collected: a scan's list of files is kept by the driver in any case."""
    return [r.path for r in changes.where(F.col("status").isin(NEW, CHANGED)).orderBy("path").collect()]

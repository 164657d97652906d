"""Writing harmonised tables: Parquet (main) and CSV (compatibility), appends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from sensorweave.operators.stack import align_to_schema
from sensorweave.session import materialize, shuffle_partitions


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """NaN cells become null, so CSV writes them as empty fields."""
    return df.withColumns({f.name: F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType))
                           for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))})


#: Partition folders carry the key's text under this name, and the key itself
#: stays in the files: a folder name would not say whether it is text or a number.
FOLDER = "part_{}"


def _with_folders(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumns({FOLDER.format(k): F.coalesce(F.col(k).cast("string"), F.lit("none")) for k in keys})


#: The folder of a row in an output of a fixed number of folders.
BUCKET = "part_bucket"


def _bucket(df: DataFrame, key: str, buckets: int) -> Column:
    """Like the folders, by the key's text, whatever its type."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("none"))), F.lit(buckets)).cast("int")


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ("sid",),
                  sort_by: Sequence[str] = ("time_ms",), mode: str = "overwrite",
                  files: int | None = None, buckets: int | None = None) -> None:
    """Partitioned Parquet, rows sorted by time inside every file so time
    ranges get tight column statistics. :func:`read_output` gives the rows
    back as they were, subject ids such as ``01`` and ``1`` included.

    Rows are range-partitioned on (partition keys, time): a subject with a
    huge share of the rows is split by time over many writer tasks instead
    of landing in one, and each task writes few, sorted files.

    A folder for each subject suits few subjects. With ``buckets`` there are so
    many folders however many subjects come, a subject's rows all in the folder
    of its hash; :func:`read_subjects` opens only that one."""
    keys = [c for c in partition_by if c in df.columns]
    order = keys + [c for c in sort_by if c in df.columns]
    if buckets and keys:
        out = df.withColumn(BUCKET, _bucket(df, keys[0], buckets))
        folders, order = [BUCKET], [BUCKET, *order]
    else:
        out, folders = _with_folders(df, keys), [FOLDER.format(k) for k in keys]
    if order:
        n = files or shuffle_partitions(df.sparkSession)
        out = out.repartitionByRange(n, *order).sortWithinPartitions(*order)
    writer = out.write.mode(mode)
    if folders:
        writer = writer.partitionBy(*folders)
    if buckets and keys:
        writer = writer.option("parquet.block.size", 32 << 20)  # small row groups: more statistics to skip by
    writer.parquet(path)


def read_output(spark: SparkSession, path: str) -> DataFrame:
    """An output of :func:`write_parquet`, without its folder columns."""
    df = spark.read.parquet(path)
    return df.drop(BUCKET, *[c for c in df.columns if c in {FOLDER.format(k) for k in df.columns}])


def read_subjects(spark: SparkSession, path: str, subjects: Sequence, key: str = "sid", buckets: int | None = None) -> DataFrame:
    """The rows of some subjects; only their folders are listed for the scan,
    and row groups without them are skipped by their statistics. ``buckets`` is
    the number that the output was written with, if it was."""
    df = spark.read.parquet(path)
    wanted = F.col(key).isin(list(subjects))
    texts = spark.createDataFrame([(s,) for s in subjects], df.select(key).schema)
    if buckets:
        wanted &= F.col(BUCKET).isin([r[0] for r in texts.select(_bucket(texts, key, buckets)).distinct().collect()])
    elif FOLDER.format(key) in df.columns:
        wanted &= F.col(FOLDER.format(key)).cast("string").isin([r[0] for r in texts.select(F.col(key).cast("string")).collect()])
    return df.where(wanted).drop(BUCKET, *[c for c in df.columns if c in {FOLDER.format(k) for k in df.columns}])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Headed CSV, missing values as empty fields, no index column; with
    ``partition_by`` in folders named like those of :func:`write_parquet`."""
    out = nan_to_null_all(df)
    writer = _with_folders(out, partition_by).repartition(*partition_by).write if partition_by else out.write
    if partition_by:
        writer = writer.partitionBy(*[FOLDER.format(k) for k in partition_by])
    writer.mode(mode).option("header", True).option("nullValue", "").csv(path)


def read_csv_output(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """An output of :func:`write_csv` with the given columns."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path).select(*schema.fieldNames())


def read_target_schema(spark: SparkSession, path: str, fmt: str = "parquet"):
    """Schema of an existing output (Parquet footers or CSV header only)."""
    if fmt == "parquet":
        return read_output(spark, path).schema
    names = spark.read.option("header", True).csv(path)
    return names.drop(*[FOLDER.format(k) for k in names.columns]).schema


def partition_keys(spark: SparkSession, path: str, fmt: str = "parquet") -> list[str]:
    """The keys whose folders an existing output is divided by."""
    names = (spark.read.option("header", True).format(fmt).load(path)).columns
    return [k for k in names if FOLDER.format(k) in names]


def append_aligned(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Append ``df`` to an existing output after matching its layout: target
    column order, missing columns null, extra columns dropped, the same
    partition folders; every CSV part has a header. Returns the aligned frame
    that was written. A repeated append repeats its rows; see
    :func:`replace_subjects`."""
    spark = df.sparkSession
    aligned = align_to_schema(df, read_target_schema(spark, path, fmt))
    if fmt == "parquet":
        write_parquet(aligned, path, partition_by=partition_keys(spark, path), mode="append")
    else:
        write_csv(aligned, path, mode="append", partition_by=partition_keys(spark, path, fmt))
    return aligned


def replace_subjects(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Append ``df``, matched to the layout as :func:`append_aligned` does, so
    that it may be repeated: the folders that its rows belong to are replaced
    as a whole, all others stay. The same batch twice leaves its rows once, and
    a changed batch takes the place of its subjects' earlier rows.

    The output must be divided by folders of the subject (``partition_by``).
    The batch is written before its folders are replaced, so a job that fails
    on the way leaves the output as it was."""
    spark = df.sparkSession
    keys = partition_keys(spark, path, fmt)
    if not keys:
        raise ValueError(f"{path} has no folders of subjects to replace")
    aligned = materialize(align_to_schema(df, read_target_schema(spark, path, fmt)), "batch")
    folders = [FOLDER.format(k) for k in keys]
    out = _with_folders(nan_to_null_all(aligned) if fmt == "csv" else aligned, keys)
    order = [*keys, *(["time_ms"] if "time_ms" in aligned.columns else [])]
    writer = (out.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders))
    if fmt == "csv":
        writer.option("header", True).option("nullValue", "").csv(path)
    else:
        writer.parquet(path)
    return aligned

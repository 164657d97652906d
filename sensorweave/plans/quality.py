"""Data-quality reports over a harmonised table, as DataFrames.

* :func:`column_listing`, :func:`sensor_locations`, :func:`metric_names` read
  only the schema (no data scan).
* :func:`linearity` checks a constant sampling step per recording.
* :func:`null_profile` counts missing cells per column in one aggregation.
* :func:`null_examples` returns the first few incomplete rows of every
  recording with the rows around them.
* :func:`quality_report` stacks all of them in one long table;
  :func:`quality_report_all` does so for any number of datasets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from sensorweave.catalog import METADATA_COLUMNS, SAMPLING_RATE_HZ
from sensorweave.functions.names import location_of_name, metric_of_name
from sensorweave.operators import sequence as seq
from sensorweave.session import materialize
from sensorweave.sources.sinks import read_output

#: Rows that a task of the joint report sorts, about.
TASK_ROWS = 2 * seq.TARGET_ROWS


def _missing(df: DataFrame, c: str) -> Column:
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


# ---------------------------------------------------------------- schema only

def column_listing(df: DataFrame, dataset: str) -> DataFrame:
    """``(dataset, ordinal, column_name, data_type)`` from the schema."""
    rows = [(dataset, i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "dataset string, ordinal int, column_name string, data_type string")


def _sensor_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in METADATA_COLUMNS and not c.startswith("_")]


def sensor_locations(df: DataFrame, dataset: str) -> DataFrame:
    """Distinct sensor locations named by the columns (``left_thigh`` ...)."""
    found = sorted({location_of_name(c) for c in _sensor_names(df)})
    return df.sparkSession.createDataFrame(
        [(dataset, v) for v in found], "dataset string, location string")


def metric_names(df: DataFrame, dataset: str) -> DataFrame:
    """Distinct metrics named by the columns (``acc``, ``gyr`` ...)."""
    found = sorted({metric_of_name(c) for c in _sensor_names(df)})
    return df.sparkSession.createDataFrame(
        [(dataset, v) for v in found], "dataset string, metric string")


# ---------------------------------------------------------------- linearity

def linearity(df: DataFrame, keys: Sequence[str], t: str, fs: float | Column,
              tolerance: float = 1.0, sort_first: bool = True, order: str | None = None,
              width: float | None = None) -> DataFrame:
    """Per recording: is every step ``1000/fs`` ms within ``tolerance``?

    Output ``(keys..., n_points, has_negative, out_of_tolerance, linear)``.
    Null and NaN times are ignored; fewer than two points count as linear; a
    step exactly ``tolerance`` away still passes. Steps are taken in time
    order (``sort_first``) or in the order of column ``order``.
    """
    keys = list(keys)
    d = df.filter(F.col(t).isNotNull() & ~F.isnan(F.col(t).cast("double")))
    order_cols = [t] if sort_first else [order, t]
    if width is None and not isinstance(fs, Column) and sort_first:
        # a regular axis: segments of a fixed number of expected steps
        width = 1000.0 / float(fs) * seq.GRID_SEGMENT_STEPS
    d = seq.seq_shift(d, keys, order_cols, t, "_prev", offset=-1, width=width)
    fs_col = fs if isinstance(fs, Column) else F.lit(float(fs))
    diff = (F.col(t) - F.col("_prev")).cast("double")
    expected = F.lit(1.0) / fs_col * F.lit(1000.0)
    out = d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.coalesce(F.min(diff) < 0, F.lit(False)).alias("has_negative"),
        F.coalesce(F.max(F.abs(diff - expected)) > F.lit(float(tolerance)), F.lit(False))
        .alias("out_of_tolerance"))
    return out.withColumn("linear", ~F.col("has_negative") & ~F.col("out_of_tolerance"))


# ---------------------------------------------------------------- nulls

def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, null_count, total_rows)`` for columns with missing cells
    (null, or NaN in floating columns); one pass over the data."""
    columns = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("_total"),
                    *[F.count_if(_missing(df, c)).alias(c) for c in columns])
    long = counts.unpivot(["_total"], columns, "column_name", "null_count")
    return (long.filter(F.col("null_count") > 0)
            .select("column_name", "null_count", F.col("_total").alias("total_rows")))


def null_columns(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Comma list of the columns missing in a row ('' when complete)."""
    columns = list(columns or df.columns)
    return F.concat_ws(",", *[F.when(_missing(df, c), F.lit(c)) for c in columns])


def null_examples(df: DataFrame, keys: Sequence[str], order: str, max_examples: int = 3,
                  context: int = 2, width: float | None = None,
                  grid_step: int | None = None) -> DataFrame:
    """The first ``max_examples`` incomplete rows of each recording, each with
    ``context`` rows before and after it.

    Output: ``keys``, ``example_no`` (1-based), ``ctx_offset`` (-context..context),
    the context row's columns, ``null_columns`` of that row and
    ``more_flagged`` (incomplete rows of the recording beyond the examples).
    Rows and positions come from bounded segments; contexts are fetched with
    an equi-join on (recording, position), so no recording is ever gathered.

    ``grid_step``: ``order`` is a gap-free grid starting at 0 in every
    recording (``time_ms`` of a harmonised table), so a row's position is
    ``order / grid_step`` and no numbering pass is needed.
    """
    keys = list(keys)
    data_cols = [c for c in df.columns if c not in keys]
    rows = df.withColumn("null_columns", null_columns(df, data_cols))
    return _examples(rows, keys, data_cols, order, max_examples, context, width, grid_step)


def _examples(rows: DataFrame, keys: list[str], data_cols: list[str], order: str, max_examples: int, context: int,
              width: float | None = None, grid_step: int | None = None) -> DataFrame:
    """:func:`null_examples` of rows that have their ``null_columns``."""
    if grid_step is not None:
        rows = rows.withColumn("_pos", F.floor(F.col(order) / F.lit(grid_step)).cast("long"))
    else:
        rows = seq.seq_index(rows, keys, [order], "_pos", width=width)
    flagged = rows.filter(F.col("null_columns") != "").select(*keys, "_pos")
    totals = flagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nflag"))
    # positions are dense row numbers: segments of TARGET_ROWS positions; the first
    # of a recording are among the first of its segments
    first = seq.with_segments(flagged, keys, "_pos", width=float(seq.TARGET_ROWS))
    for part in ([*keys, seq.SEG], keys):
        first = (first.withColumn("_rank", F.row_number().over(Window.partitionBy(*part).orderBy("_pos")))
                 .filter(F.col("_rank") <= max_examples))
    anchors = (first.join(totals, on=keys, how="left")
               .withColumn("ctx_offset", F.explode(F.sequence(F.lit(-context), F.lit(context))))
               .select(*keys, F.col("_rank").cast("long").alias("example_no"), "ctx_offset",
                       (F.col("_pos") + F.col("ctx_offset")).alias("_pos"),
                       F.greatest(F.col("_nflag") - F.lit(max_examples), F.lit(0))
                       .cast("long").alias("more_flagged")))
    # a stored table of empty cells is tiny on disk and large in memory: never
    # broadcast the rows for their size; the few contexts are hashed in each task
    out = anchors.hint("shuffle_hash").join(rows, on=[*keys, "_pos"], how="inner")
    return out.select(*keys, "example_no", "ctx_offset", *data_cols, "null_columns", "more_flagged")


# ---------------------------------------------------------------- combined

def quality_report(df: DataFrame, dataset: str, keys: Sequence[str], fs: float | None = None,
                   t: str = "time_ms", tolerance: float = 1.0, grid_step: int | None = None) -> DataFrame:
    """All checks for one harmonised table:
    ``(dataset, check, key, status, detail)``, the first incomplete rows of
    every recording with the rows around them included (``grid_step`` as in
    :func:`null_examples`). ``fs`` defaults to the
    dataset's configured sampling rate (unknown datasets raise)."""
    if fs is None:
        if dataset not in SAMPLING_RATE_HZ:
            raise ValueError(f"no sampling rate configured for dataset {dataset!r}")
        fs = SAMPLING_RATE_HZ[dataset]
    parts = []
    cols = column_listing(df, dataset)
    parts.append(cols.select(F.lit(dataset).alias("dataset"), F.lit("column").alias("check"),
                             F.col("column_name").alias("key"), F.lit("info").alias("status"),
                             F.col("data_type").alias("detail")))
    locs = sensor_locations(df, dataset)
    parts.append(locs.select(F.lit(dataset), F.lit("location"), F.col("location"),
                             F.lit("info"), F.lit(None).cast("string")))
    mets = metric_names(df, dataset)
    parts.append(mets.select(F.lit(dataset), F.lit("metric"), F.col("metric"),
                             F.lit("info"), F.lit(None).cast("string")))
    lin = linearity(df, keys, t, fs, tolerance)
    key_text = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    parts.append(lin.select(
        F.lit(dataset), F.lit("linearity"), key_text,
        F.when(F.col("linear"), F.lit("pass")).otherwise(F.lit("fail")),
        F.concat(F.lit("points="), F.col("n_points").cast("string"),
                 F.lit(" negative="), F.col("has_negative").cast("string"),
                 F.lit(" out_of_tolerance="), F.col("out_of_tolerance").cast("string"))))
    examples = null_examples(df, keys, t, grid_step=grid_step)
    place = F.concat_ws("/", *[F.col(k).cast("string") for k in keys], F.col("example_no").cast("string"), F.col("ctx_offset").cast("string"))
    parts.append(examples.select(
        F.lit(dataset), F.lit("null_example"), place,
        F.when(F.col("null_columns") != "", F.lit("warn")).otherwise(F.lit("info")),
        F.concat(F.col(t).cast("string"), F.lit(": "), F.col("null_columns"))))
    nulls = null_profile(df)
    parts.append(nulls.select(
        F.lit(dataset), F.lit("nulls"), F.col("column_name"), F.lit("warn"),
        F.concat(F.col("null_count").cast("string"), F.lit("/"),
                 F.col("total_rows").cast("string"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p.toDF(*out.columns))
    return out


# ---------------------------------------------------------------- all datasets

def quality_report_all(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], fs: Mapping[str, float] | None = None,
                       t: str = "time_ms", tolerance: float = 1.0, max_examples: int = 3, context: int = 2) -> DataFrame:
    """All checks over all datasets, as :func:`quality_report` gives them for one.

    ``tables`` has each dataset's harmonised table and recording keys by name;
    sampling rates come from the configuration unless ``fs`` names them. The
    tables may have any columns: what a check needs of them (a recording's key
    as text, its time, which cells are missing) goes into one stream of all
    datasets, and every check is one plan over that stream, however many
    datasets there are. Missing cells are counted where they are read, so no
    row is multiplied by its columns."""
    rates = {**SAMPLING_RATE_HZ, **(fs or {})}
    if unknown := sorted(set(tables) - set(rates)):
        raise ValueError(f"no sampling rate configured for datasets {unknown}")
    first = next(iter(tables.values()))[0]
    names, streams, counts = [], [], []
    for dataset, (df, keys) in tables.items():
        sensors = _sensor_names(df)
        names += [(dataset, "column", f.name, f.dataType.simpleString()) for f in df.schema.fields]
        names += [(dataset, "location", v, None) for v in sorted({location_of_name(c) for c in sensors})]
        names += [(dataset, "metric", v, None) for v in sorted({metric_of_name(c) for c in sensors})]
        key = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
        streams.append(df.select(F.lit(dataset).alias("dataset"), key.alias("recording"), F.col(t).cast("long").alias(t), F.lit(float(rates[dataset])).alias("fs"),
                                 null_columns(df, [c for c in df.columns if c not in keys]).alias("null_columns")))
        counts.append(null_profile(df).select(F.lit(dataset).alias("dataset"), "column_name", "null_count", "total_rows"))
    stream = reduce(DataFrame.unionByName, streams)
    report = first.sparkSession.createDataFrame(names, "dataset string, check string, key string, detail string")
    report = report.select("dataset", "check", "key", F.lit("info").alias("status"), "detail")
    steps, found = _steps_and_examples(stream, ["dataset", "recording"], t, tolerance, max_examples, context)
    report = report.union(steps.select(
        "dataset", F.lit("linearity"), "recording", F.when(F.col("linear"), F.lit("pass")).otherwise(F.lit("fail")),
        F.concat(F.lit("points="), F.col("n_points").cast("string"), F.lit(" negative="), F.col("has_negative").cast("string"),
                 F.lit(" out_of_tolerance="), F.col("out_of_tolerance").cast("string"))))
    report = report.union(reduce(DataFrame.unionByName, counts).select(
        "dataset", F.lit("nulls"), "column_name", F.lit("warn"), F.concat_ws("/", F.col("null_count").cast("string"), F.col("total_rows").cast("string"))))
    return report.union(found.select(
        "dataset", F.lit("null_example"), F.concat_ws("/", "recording", F.col("example_no").cast("string"), F.col("ctx_offset").cast("string")),
        F.when(F.col("null_columns") != "", F.lit("warn")).otherwise(F.lit("info")), F.concat(F.col(t).cast("string"), F.lit(": "), F.col("null_columns"))))


def _steps_and_examples(stream: DataFrame, keys: list[str], t: str, tolerance: float, max_examples: int, context: int) -> tuple[DataFrame, DataFrame]:
    """:func:`linearity` and the rows of :func:`null_examples` of a stream with
    a whole-numbered ``t``, ``fs`` and ``null_columns``, by one sort of its
    segments. Each segment keeps the rows around its first incomplete ones, its
    first and last ones, and in its last row what its steps are like; the rest
    is worked out on those few. Rows are dealt to as many tasks as their number
    asks for: empty cells pack so well that the bytes of a shuffle say little
    about the memory its rows take."""
    stats = materialize(seq.recording_stats(stream, keys, t), "recordings")
    rows = stats.agg(F.sum("_rec_rows")).first()[0] or 0
    seg = seq.with_segments(stream, keys, t, stats=stats).repartition(max(1, -(-rows // TASK_ROWS)), *keys, seq.SEG)
    w = Window.partitionBy(*keys, seq.SEG).orderBy(t)
    so_far, edge = w.rowsBetween(Window.unboundedPreceding, Window.currentRow), max(context, 1)
    flag = F.when(F.col("null_columns") != "", 1).otherwise(0)
    before = F.sum(flag).over(w.rowsBetween(Window.unboundedPreceding, -context - 1))
    step = (F.col(t) - F.col("_prev")).cast("double")
    off = F.abs(step - F.lit(1.0) / F.col("fs") * F.lit(1000.0))
    seg = seg.withColumns({
        "_local": F.row_number().over(w), "_prev": F.lag(t).over(w), "_last": F.lead(F.lit(1)).over(w).isNull(),
        "_near": (F.sum(flag).over(w.rowsBetween(-context, context)) > 0) & (F.coalesce(before, F.lit(0)) < max_examples),
        "_edge": (F.row_number().over(w) <= edge) | F.lead(F.lit(1), edge).over(w).isNull()})
    seg = seg.withColumns({"_n": F.count(t).over(so_far), "_least": F.min(step).over(so_far), "_off": F.max(off).over(so_far)})
    kept = materialize(seg.where(F.col("_near") | F.col("_edge")).drop("_prev", "_near", "_edge"), "examples")

    along = Window.partitionBy(*keys).orderBy(seq.SEG, "_local")
    kept = kept.withColumns({"_prev": F.lag(t).over(along), "example_no": F.sum(flag).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    first, last = F.col("_local") == 1, F.col("_last")
    steps = kept.groupBy(*keys).agg(
        F.sum(F.when(last, F.col("_n"))).alias("n_points"),
        F.coalesce(F.least(F.min(F.when(last, F.col("_least"))), F.min(F.when(first, step))) < 0, F.lit(False)).alias("has_negative"),
        F.coalesce(F.greatest(F.max(F.when(last, F.col("_off"))), F.max(F.when(first, off))) > F.lit(float(tolerance)), F.lit(False)).alias("out_of_tolerance"))
    steps = steps.where(F.col("n_points") > 0).withColumn("linear", ~F.col("has_negative") & ~F.col("out_of_tolerance"))
    row = F.struct(t, "null_columns")
    around = F.array(*[F.struct(F.lit(k).alias("ctx_offset"), (F.lead(row, k) if k >= 0 else F.lag(row, -k)).over(along).alias("row")) for k in range(-context, context + 1)])
    found = kept.withColumn("_around", around).where((flag == 1) & (F.col("example_no") <= max_examples))
    found = found.select(*keys, "example_no", F.inline("_around")).where(F.col("row").isNotNull())
    return steps, found.select(*keys, "example_no", "ctx_offset", "row.*")


def stored_datasets(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The outputs below ``root`` by the name of their folder."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    names = sorted(f.getPath().getName() for f in found if f.isDirectory())
    return {n: read_output(spark, f"{root.rstrip('/')}/{n}") for n in names if not n.startswith(("_", "."))}

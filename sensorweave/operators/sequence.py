"""Ordered per-recording operations that stay bounded when a recording is huge.

A window ``PARTITION BY recording ORDER BY t`` sends a whole recording to one
task; if one recording holds a third of all rows, that task sorts a third of
the data. Every ordered operation here instead runs inside *segments*
``(recording, segment)``, where the segment is a monotone function of the
order key holding a bounded number of rows. The few values that cross a
segment border (rows before it, the next or previous value, the last non-null
value) are computed on a per-segment summary with one row per segment and
joined back (by a forward fill: put before the segment's rows). A recording of N rows then costs N/segment_rows summary rows, not
one N-row task.

Segments come from one of:

* ``width``: a fixed width on a numeric order key (e.g. ``step * 65536`` on a
  time grid: at most 65536 grid points per segment);
* ``segment``: an existing monotone column (e.g. the file split offset of a
  text scan, bounded by ``spark.sql.files.maxPartitionBytes``);
* neither: a per-recording width from ``(min, max, count)`` so that an evenly
  spaced recording has about ``target_rows`` rows per segment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorweave.operators.joins import null_safe_join
from sensorweave.session import materialize, shuffle_partitions

SEG = "_sw_seg"
TARGET_ROWS = 1 << 17
GRID_SEGMENT_STEPS = 1 << 16


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def with_segments(df: DataFrame, keys: Sequence[str], order: str,
                  width: float | None = None, segment: str | None = None,
                  target_rows: int = TARGET_ROWS, stats: DataFrame | None = None) -> DataFrame:
    """Add the segment column ``SEG`` (kept if already present). ``stats``: the
    :func:`recording_stats` of ``df``, if they are at hand."""
    if SEG in df.columns:
        return df
    if segment is not None:
        return df.withColumn(SEG, F.col(segment))
    if width is not None:
        return df.withColumn(SEG, F.floor(F.col(order) / F.lit(float(width))).cast("long"))
    keys = list(keys)
    stats = stats if stats is not None else recording_stats(df, keys, order)
    stats = stats.withColumn(
        "_sw_w",
        F.greatest(F.lit(1.0), (F.col("_rec_max") - F.col("_rec_min") + F.lit(1)).cast("double")
                   * F.lit(float(target_rows)) / F.col("_rec_rows"))).withColumnRenamed("_rec_min", "_sw_lo")
    if not keys:
        lo, w = stats.select("_sw_lo", "_sw_w").first() or (0, 1.0)
        joined = df.withColumn("_sw_lo", F.lit(lo)).withColumn("_sw_w", F.lit(w))
        return (joined
                .withColumn(SEG, F.floor((F.col(order) - F.col("_sw_lo")) / F.col("_sw_w")).cast("long"))
                .drop("_sw_lo", "_sw_w"))
    # a recording of up to target_rows rows is one segment; only the longer ones, at most
    # one for every target_rows rows, are joined, so the rows themselves stay where they are
    longer = stats.filter(F.col("_rec_rows") > F.lit(target_rows)).select(*keys, "_sw_lo", "_sw_w")
    joined = null_safe_join(df, F.broadcast(longer), keys)
    seg = F.floor((F.col(order) - F.col("_sw_lo")) / F.col("_sw_w")).cast("long")
    return (joined
            .withColumn(SEG, F.when(F.col("_sw_w").isNull(), F.lit(0).cast("long")).otherwise(seg))
            .drop("_sw_lo", "_sw_w"))


def _local_window(keys, order_cols):
    return Window.partitionBy(*keys, SEG).orderBy(*order_cols)


def _seg_window(keys):
    return Window.partitionBy(*keys).orderBy(SEG)


def _summary(windowed: DataFrame, keys: Sequence[str], pick: Column, cols: dict[str, Column]) -> DataFrame:
    """One row per segment taken from the windowed rows (``pick`` is true on
    exactly one row per segment). Column pruning leaves this branch only the
    key and order columns, so it re-reads little: on columnar input just
    those columns."""
    return windowed.filter(pick).select(*keys, SEG, *[c.alias(n) for n, c in cols.items()])


def seq_index(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str,
              width: float | None = None, segment: str | None = None,
              target_rows: int = TARGET_ROWS, keep_segment: bool = False) -> DataFrame:
    """0-based position of each row within its recording in ``order``.

    ``order[0]`` defines the segments; the remaining names break ties. The
    order should be total (unique within a recording) for a reproducible
    numbering.
    """
    keys, order = list(keys), list(order)
    seg = with_segments(df, keys, order[0], width, segment, target_rows)
    w = _local_window(keys, _cols(order))
    seg = (seg.withColumn("_sw_local", F.row_number().over(w) - F.lit(1))
           .withColumn("_sw_cnt", F.count(F.lit(1)).over(Window.partitionBy(*keys, SEG))))
    counts = _summary(seg, keys, F.col("_sw_local") == 0, {"_sw_cnt": F.col("_sw_cnt")})
    offsets = counts.select(
        *keys, SEG,
        F.coalesce(F.sum("_sw_cnt").over(
            _seg_window(keys).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_sw_off"))
    res = (null_safe_join(seg, offsets, [*keys, SEG])
           .withColumn(out, (F.col("_sw_off") + F.col("_sw_local")).cast("long"))
           .drop("_sw_off", "_sw_local", "_sw_cnt"))
    return res if keep_segment else res.drop(SEG)


def seq_shift(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
              out: str, offset: int = 1, width: float | None = None,
              segment: str | None = None, target_rows: int = TARGET_ROWS,
              keep_segment: bool = False, first_out: str | None = None) -> DataFrame:
    """``lead(value)`` (offset=+1) or ``lag(value)`` (offset=-1) within the
    recording in ``order``; null past the recording's ends.

    ``first_out`` (lead only) also attaches the recording's first ``value``,
    read off the same per-segment summary at no extra pass.
    """
    if first_out is not None and offset != 1:
        raise ValueError("first_out needs offset=+1")
    if offset not in (1, -1):
        raise ValueError("offset must be +1 or -1")
    keys, order = list(keys), list(order)
    seg = with_segments(df, keys, order[0], width, segment, target_rows)
    w = _local_window(keys, _cols(order))
    if offset == 1:
        # the next row of the last row of a segment is the first row of the
        # next non-empty segment
        seg = (seg.withColumn("_sw_at_edge", F.lead(F.lit(1)).over(w).isNull())
               .withColumn("_sw_local", F.lead(value).over(w))
               .withColumn("_sw_first", F.lag(F.lit(1)).over(w).isNull()))
        edges = _summary(seg, keys, F.col("_sw_first"), {"_sw_edge": F.col(value)})
        carry = F.lead("_sw_edge").over(_seg_window(keys))
    else:
        seg = (seg.withColumn("_sw_at_edge", F.lag(F.lit(1)).over(w).isNull())
               .withColumn("_sw_local", F.lag(value).over(w))
               .withColumn("_sw_first", F.lead(F.lit(1)).over(w).isNull()))
        edges = _summary(seg, keys, F.col("_sw_first"), {"_sw_edge": F.col(value)})
        carry = F.lag("_sw_edge").over(_seg_window(keys))
    extra = []
    if first_out is not None:
        extra.append(F.first("_sw_edge").over(_seg_window(keys).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)).alias(first_out))
    edges = edges.select(*keys, SEG, carry.alias("_sw_carry"), *extra)
    res = (null_safe_join(seg, edges, [*keys, SEG])
           .withColumn(out, F.when(F.col("_sw_at_edge"), F.col("_sw_carry"))
                       .otherwise(F.col("_sw_local")))
           .drop("_sw_at_edge", "_sw_local", "_sw_carry", "_sw_first"))
    return res if keep_segment else res.drop(SEG)


def seq_ffill(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
              out: str | None = None, width: float | None = None,
              segment: str | None = None, target_rows: int = TARGET_ROWS,
              keep_segment: bool = False) -> DataFrame:
    """Forward fill: each null takes the last non-null earlier value of the
    recording (leading nulls stay null).

    The value that a segment begins with is put before its rows as one more
    row, so that the rows are dealt out once, and not again to be joined."""
    keys, order = list(keys), list(order)
    out = out or value
    seg = with_segments(df, keys, order[0], width, segment, target_rows)
    # the last non-null value of each segment, from few columns and reduced before it is dealt out
    edges = (seg.groupBy(*keys, SEG).agg(F.max_by(
        F.col(value), F.when(F.col(value).isNotNull(), F.struct(*_cols(order)))).alias("_sw_edge")))
    carry = F.last("_sw_edge", ignorenulls=True).over(
        _seg_window(keys).rowsBetween(Window.unboundedPreceding, -1))
    before = edges.select(*keys, SEG, carry.alias("_sw_carry")).where(F.col("_sw_carry").isNotNull())
    filled = F.last(F.coalesce("_sw_carry", value), ignorenulls=True).over(
        _local_window(keys, _cols(["_sw_row", *order])).rowsBetween(Window.unboundedPreceding, 0))
    res = (seg.withColumn("_sw_row", F.lit(True))
           .unionByName(before.withColumn("_sw_row", F.lit(False)), allowMissingColumns=True)
           .withColumn(out, filled).where("_sw_row").drop("_sw_row", "_sw_carry"))
    return res if keep_segment else res.drop(SEG)


def recording_stats(df: DataFrame, keys: Sequence[str], order: str,
                    prefix: str = "_rec") -> DataFrame:
    """``min``/``max``/``count`` of ``order`` per recording (partial aggregation,
    so a hot recording is pre-reduced on every map task)."""
    return df.groupBy(*keys).agg(
        F.min(order).alias(f"{prefix}_min"), F.max(order).alias(f"{prefix}_max"),
        F.count(F.lit(1)).alias(f"{prefix}_rows"))


def with_recording_stats(df: DataFrame, keys: Sequence[str], order: str,
                         prefix: str = "_rec") -> DataFrame:
    """Attach :func:`recording_stats` to every row (equi-join on the keys)."""
    keys = list(keys)
    stats = recording_stats(df, keys, order, prefix)
    if not keys:
        row = stats.first()
        return df.withColumns({f"{prefix}_min": F.lit(row[0]), f"{prefix}_max": F.lit(row[1]),
                               f"{prefix}_rows": F.lit(row[2])})
    return null_safe_join(df, stats, keys)


def global_index(df: DataFrame, order: Sequence[str], out: str,
                 partitions: int | None = None) -> DataFrame:
    """0-based position of each row in a total ``order`` over the whole frame.

    Works for any orderable key (strings too): rows are range-partitioned and
    sorted on ``order`` and written once, so that counts and numbers come from
    the same ranges whatever else is selected; each row's place in its range is
    offset by the row counts of the earlier ranges. The offset table has one
    row per range partition, a bound fixed by ``partitions``, so broadcasting
    it is safe.
    """
    order = list(order)
    n = partitions or shuffle_partitions(df.sparkSession)
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_sw_id", F.monotonically_increasing_id()))
    ranged = materialize(ranged, "ranges").withColumn("_sw_part", F.shiftright("_sw_id", 33))
    counts = ranged.groupBy("_sw_part").agg(F.count(F.lit(1)).alias("_sw_cnt"))
    offsets = counts.select("_sw_part", (F.coalesce(F.sum("_sw_cnt").over(
        Window.orderBy("_sw_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        - F.shiftleft(F.col("_sw_part"), 33)).alias("_sw_shift"))
    return (ranged.join(F.broadcast(offsets), "_sw_part")
            .withColumn(out, F.col("_sw_id") + F.col("_sw_shift"))
            .drop("_sw_part", "_sw_id", "_sw_shift"))

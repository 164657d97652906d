"""Time-axis operators: rounding to a grid, gap filling, rebasing, numbering.

All are ``DataFrame -> DataFrame`` and partition work by (recording, segment)
through :mod:`sensorweave.operators.sequence`, never by recording alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.functions import timegrid
from sensorweave.operators import sequence as seq
from sensorweave.operators.joins import null_safe_join

# Grid points per segment in gap filling: bounds both the rows of one window
# partition and the rows generated from one source row per explode level.
GRID_SEGMENT_STEPS = seq.GRID_SEGMENT_STEPS
EXPLODE_CHUNK = 4096


def round_to_grid(df: DataFrame, t: str, step: int, out: str | None = None) -> DataFrame:
    """Round integer axis ``t`` to the nearest multiple of ``step`` (ties to even)."""
    return df.withColumn(out or t, timegrid.round_half_even(F.col(t), step))


def fill_grid(df: DataFrame, keys: Sequence[str], t: str, step: int,
              anchor: str = "epoch", carry: Sequence[str] = (),
              segment_steps: int = GRID_SEGMENT_STEPS, start_out: str | None = None) -> DataFrame:
    """Give every grid point of each recording a row (reindex over a full range).

    The grid runs from the recording's first sample to its last in ``step``
    units. Samples on the grid keep their values (duplicates stay duplicated,
    as in a left join of the grid with the samples); grid points with no
    sample get a row whose value columns are null while ``keys`` and
    ``carry`` columns (constant per recording) are copied.

    ``anchor="epoch"``: the grid is the multiples of ``step`` (input already
    rounded to the grid); other samples are dropped.
    ``anchor="min"``: the grid starts at the recording's smallest ``t`` and
    ends at the last grid point not after its largest ``t``; samples off that
    grid are dropped.

    Every gap is filled, however long; :func:`grid_gaps` reports them (a
    counter reset shows as a very long one).

    ``start_out`` adds the recording's first grid point to every output row
    (for rebasing time to the start without another pass).

    No join with a generated grid is used: each sample's next sample
    (``lead``, computed per segment) tells how many empty grid points follow
    it, and those are generated from the sample row itself.
    """
    keys, carry = list(keys), list(carry)
    fixed = set(keys) | set(carry) | {t}
    values = [c for c in df.columns if c not in fixed]
    tcol = F.col(t)
    if anchor == "min":
        df = seq.with_recording_stats(df, keys, t, "_fg")
        on_grid = F.pmod(tcol - F.col("_fg_min"), F.lit(step)) == 0
        last_point = F.col("_fg_min") + timegrid.floor_div(F.col("_fg_max") - F.col("_fg_min"), step) * F.lit(step)
    elif anchor == "epoch":
        on_grid = F.pmod(tcol, F.lit(step)) == 0
        last_point = tcol
    else:
        raise ValueError(f"unknown anchor {anchor!r}")
    on = df.filter(on_grid)
    on = seq.seq_shift(on, keys, [t], t, "_fg_next", offset=1,
                       width=float(step) * segment_steps, first_out=start_out)
    end = F.when(F.col("_fg_next").isNull(), last_point).otherwise(
        F.greatest(tcol, F.col("_fg_next") - F.lit(step)))
    on = on.withColumn("_fg_end", end)
    chunk = step * EXPLODE_CHUNK
    # two-level generation keeps every generated array at most EXPLODE_CHUNK long
    on = on.withColumn("_fg_c", F.explode(F.sequence(tcol, F.col("_fg_end"), F.lit(chunk))))
    on = on.withColumn("_fg_g", F.explode(F.sequence(
        F.col("_fg_c"), F.least(F.col("_fg_c") + F.lit(chunk - step), F.col("_fg_end")), F.lit(step))))
    is_source = F.col("_fg_g") == tcol
    out = on.select(
        *[F.col(k) for k in keys],
        F.col("_fg_g").alias(t),
        *([F.col(start_out)] if start_out else []),
        *[F.col(c) for c in carry],
        *[F.when(is_source, F.col(c)).alias(c) for c in values],
    )
    return out


def grid_gaps(df: DataFrame, keys: Sequence[str], t: str, step: int,
              min_gap_steps: int = 1) -> DataFrame:
    """Gaps of at least ``min_gap_steps`` missing grid points: one row per gap
    ``(keys, gap_start, gap_end, missing)``."""
    keys = list(keys)
    d = seq.seq_shift(df.select(*keys, t), keys, [t], t, "_next", offset=1,
                      width=float(step) * GRID_SEGMENT_STEPS)
    missing = timegrid.floor_div(F.col("_next") - F.col(t), step) - F.lit(1)
    return (d.withColumn("missing", missing)
            .filter(F.col("missing") >= F.lit(min_gap_steps))
            .select(*keys, F.col(t).alias("gap_after"), F.col("_next").alias("gap_before"), "missing"))


def elapsed_since_start(df: DataFrame, keys: Sequence[str], t: str, out: str,
                        unit: int = 1, scale: int = 1) -> DataFrame:
    """``out = floor((t - min(t) over recording) / unit) * scale``.

    ``unit=1000`` turns microseconds into milliseconds; ``scale=10`` turns
    packets into milliseconds at 100 Hz. The minimum comes from a partial
    aggregation joined back, not from a recording-wide window.
    """
    keys = list(keys)
    stats = df.groupBy(*keys).agg(F.min(t).alias("_t0"))
    joined = null_safe_join(df, stats, keys) if keys else df.withColumn(
        "_t0", F.lit(stats.first()[0]))
    delta = F.col(t) - F.col("_t0")
    val = timegrid.floor_div(delta, unit) if unit != 1 else delta
    return joined.withColumn(out, (val * F.lit(scale)).cast("long")).drop("_t0")


def sample_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "sample_no",
                  width: float | None = None, segment: str | None = None) -> DataFrame:
    """0-based sample number within the recording (row position as time axis)."""
    return seq.seq_index(df, keys, order, out, width=width, segment=segment)


def forward_fill(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str,
                 width: float | None = None) -> DataFrame:
    return seq.seq_ffill(df, keys, order, column, column, width=width)

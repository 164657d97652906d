"""Time-axis arithmetic on integer microseconds / milliseconds.

Grid arithmetic is done on integers so that rounding and truncation are exact
and independent of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

MICROS_PER_MS = 1000
MS = 1000  # micros in one millisecond


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Microseconds since 1970-01-01 for a timestamp column.

    ``timestamp_ntz`` (wall clock, what Parquet files usually hold) is measured
    against the wall-clock epoch, so the session time zone never enters;
    ``timestamp`` (an instant) uses ``unix_micros``. Integral columns pass.
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, TimestampNTZType):
        return F.expr(
            f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")
    if isinstance(dtype, TimestampType):
        return F.unix_micros(F.col(col))
    return F.col(col).cast("long")


def floor_div(a: Column, b: int) -> Column:
    """Floor division for integral columns (rounds toward minus infinity)."""
    return ((a - F.pmod(a, F.lit(b))) / F.lit(b)).cast("long")


def round_half_even(u: Column, step: int) -> Column:
    """Round an integer axis to the nearest multiple of ``step``, ties to even.

    Matches a datetime rounded to a fixed frequency (e.g. 10 ms): on ties the
    multiple with an even quotient wins.
    """
    r = F.pmod(u, F.lit(step))
    q = ((u - r) / F.lit(step)).cast("long")
    up = (F.lit(2) * r > F.lit(step)) | ((F.lit(2) * r == F.lit(step)) & (F.pmod(q, F.lit(2)) == 1))
    return (q + F.when(up, 1).otherwise(0)) * F.lit(step)


def seconds_to_ms(seconds: Column, mode: str = "truncate") -> Column:
    """Seconds (float) to whole milliseconds, truncating like ``astype(int)``.

    The product of a float can fall just below a whole millisecond (2.009 s
    gives 2008 or 2009 by its rounding error); ``mode="exact"`` goes through
    the decimal value instead, to the microsecond.
    """
    if mode == "exact":
        return (seconds.cast("decimal(18,6)") * F.lit(1000)).cast("long")
    if mode != "truncate":
        raise ValueError(f"unknown mode {mode!r}")
    return (seconds * F.lit(1000.0)).cast("long")


def ms_from_rate(index: Column, fs: float) -> Column:
    """Time of sample ``index`` at ``fs`` Hz: ``trunc(index * (1000 / fs))``.

    The period is computed first, exactly as the sample period constant of the
    32 Hz recordings; for fs=32 this gives 0, 31, 62, 93, 125, ...
    """
    return (index * F.lit(1000.0 / fs)).cast("long")


def ms_from_step(index: Column, step_ms: int) -> Column:
    """Time of sample ``index`` on an integer millisecond grid."""
    return index.cast("long") * F.lit(step_ms)


def elapsed_ms(u: Column, u_start: Column) -> Column:
    """Whole milliseconds from ``u_start`` to ``u`` (both micros), truncated."""
    return floor_div(u - u_start, MS)

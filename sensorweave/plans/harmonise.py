"""Harmonising a long table of sensor readings (one row per sensor sample).

Order of operations: round the clock to the grid, average samples sharing a
slot per sensor, align all sensors in one aggregation, give every grid point
of the subject a row, express time as ms since the subject's first slot,
convert g to m/s^2, attach subject and surface.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.functions import timegrid, units
from sensorweave.operators import align, timeline

T = "_slot_us"


def harmonise_long(df: DataFrame, sid: str, sensor: str, ts: str, sensors: Sequence[str],
                   values: Sequence[str], step_us: int = 10_000, metric: str = "acc",
                   surface: str = "flat", convert=units.g_to_ms2) -> DataFrame:
    """``(sid, sensor, ts, values...)`` -> ``time_ms, sid, surface, {sensor}_{metric}_{value}...``.

    ``step_us`` is the grid step in microseconds (10 ms for 100 Hz). Samples
    with a null clock are dropped (they belong to no slot), and so are those of
    sensors not listed (they make no slot). ``convert`` is
    applied to every sensor column after alignment (g -> m/s^2 by default).
    """
    names = {(s, v): f"{s}_{metric}_{v}".lower() for s in sensors for v in values}
    slotted = (df.withColumn(T, timegrid.round_half_even(timegrid.epoch_micros(df, ts), step_us))
               .filter(F.col(T).isNotNull()))
    wide = align.widen(slotted, [sid], T, sensor, sensors, values,
                       name=lambda s, v: names[(s, v)], dedupe=align.MEAN)
    filled = timeline.fill_grid(wide, [sid], T, step_us, anchor="epoch", start_out="_t0")
    timed = filled.withColumn("time_ms", timegrid.elapsed_ms(F.col(T), F.col("_t0")))
    sensor_cols = list(names.values())
    return timed.select(
        "time_ms", F.col(sid).alias("sid"), F.lit(surface).alias("surface"),
        *[convert(F.col(c)).alias(c) for c in sensor_cols])

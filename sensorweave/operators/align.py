"""Sensor alignment: long (recording, t, sensor, values) -> one wide row per (recording, t).

A chain of full outer joins (one per sensor) shuffles once per sensor and
grows with the sensor count. Conditional aggregation aligns every sensor in a
single aggregation keyed by ``(recording, t)``; because ``t`` is part of the
key, a huge recording spreads over all tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorweave.functions.units import nan_to_null
from sensorweave.operators.joins import null_safe_join
from sensorweave.session import materialize

MEAN, MAX, FIRST, ERROR = "mean", "max", "first", "error"


def default_name(sensor: str, value: str) -> str:
    return f"{sensor}_{value}".lower()


def duplicate_keys(df: DataFrame, keys: Sequence[str], t: str, sensor: str) -> DataFrame:
    """Recordings in which one sensor has two samples at the same ``t``:
    ``(keys..., duplicate_samples)``."""
    keys = list(keys)
    return (df.groupBy(*keys, t, sensor).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > 1)
            .groupBy(*keys).agg(F.sum(F.col("_n") - F.lit(1)).alias("duplicate_samples")))


def widen(df: DataFrame, keys: Sequence[str], t: str, sensor: str,
          sensors: Sequence[str], values: Sequence[str],
          name: Callable[[str, str], str] = default_name,
          dedupe: str = MEAN, order: str | None = None) -> DataFrame:
    """Align ``sensors`` on ``t``: columns ``name(sensor, value)`` per pair.

    ``dedupe`` decides what happens to two samples of one sensor at one ``t``:
    ``mean`` averages them (nulls and NaN skipped), ``max`` keeps the largest,
    ``first`` the one smallest in ``order``, ``error`` drops the whole
    recording (see :func:`widen_or_set_aside` for those). Sensors absent at a
    ``t`` give nulls there; samples of other sensors make no row.
    """
    keys = list(keys)
    if dedupe == ERROR:
        return widen_or_set_aside(df, keys, t, sensor, sensors, values, name)[0]
    df = df.filter(F.col(sensor).isin(list(sensors)))
    if dedupe == MEAN:
        aggs = [F.avg(F.when(F.col(sensor) == F.lit(s), nan_to_null(F.col(v)))).alias(name(s, v))
                for s in sensors for v in values]
        return df.groupBy(*keys, t).agg(*aggs)
    if dedupe not in (MAX, FIRST) or (dedupe == FIRST) != (order is not None):
        raise ValueError(f"unknown dedupe policy {dedupe!r}, or an order without 'first'")
    # one struct aggregate per sensor keeps the aggregation narrow even when a
    # sensor carries dozens of metrics
    wide = df.groupBy(*keys, t).agg(*[_one_sample(sensor, s, values, order).alias(f"_w_{s}") for s in sensors])
    return wide.select(*keys, t, *_spread(sensors, values, name))


def _one_sample(sensor: str, s: str, values: Sequence[str], order: str | None) -> Column:
    sample = F.when(F.col(sensor) == F.lit(s), F.struct(*[F.col(v).alias(v) for v in values]))
    return F.max(sample) if order is None else F.min_by(sample, F.when(F.col(sensor) == F.lit(s), F.col(order)))


def _spread(sensors: Sequence[str], values: Sequence[str], name: Callable[[str, str], str]) -> list[Column]:
    return [F.col(f"_w_{s}.{v}").alias(name(s, v)) for s in sensors for v in values]


def widen_or_set_aside(df: DataFrame, keys: Sequence[str], t: str, sensor: str,
                       sensors: Sequence[str], values: Sequence[str],
                       name: Callable[[str, str], str] = default_name) -> tuple[DataFrame, DataFrame]:
    """The wide table of the recordings in which no sensor has two samples at
    one ``t``, and the keys of the others. Samples are counted in the same
    aggregation that aligns them; its result is written once, as both outputs
    read it. A kept cell has one sample, so its values are taken one by one:
    that aggregation is hashed, one of structs would sort all samples."""
    keys = list(keys)
    df = df.filter(F.col(sensor).isin(list(sensors)))
    aggs = [F.max(F.when(F.col(sensor) == F.lit(s), F.col(v))).alias(name(s, v)) for s in sensors for v in values]
    repeated = [F.count_if(F.col(sensor) == F.lit(s)) > 1 for s in sensors]
    wide = materialize(df.groupBy(*keys, t).agg(*aggs, reduce(or_, repeated).alias("_repeated")), "aligned")
    bad = wide.filter("_repeated").select(*keys).distinct()
    good = null_safe_join(wide, bad, keys, "left_anti")
    return good.select(*keys, t, *[name(s, v) for s in sensors for v in values]), bad

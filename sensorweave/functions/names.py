"""Sensor-name token rules used by the location and metric reports.

Names follow ``{side}_{location}_{metric}_{axis}``. The location is the first
token, or the first two when the first is a side. The metric is the last
token, or the one before it when the last is an axis. A one-token name is its
own location and metric.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorweave.catalog import AXIS_TOKENS

SIDES = ["left", "right"]


def location_of(name: Column) -> Column:
    tok = F.split(name, "_")
    first = F.try_element_at(tok, F.lit(1))
    second = F.try_element_at(tok, F.lit(2))
    return (F.when(F.size(tok) < 2, name)
            .when(first.isin(*SIDES), F.concat_ws("_", first, second))
            .otherwise(first))


def metric_of(name: Column) -> Column:
    tok = F.split(name, "_")
    last = F.try_element_at(tok, F.lit(-1))
    before = F.try_element_at(tok, F.lit(-2))
    return (F.when(F.size(tok) < 2, name)
            .when(last.isin(*AXIS_TOKENS), before)
            .otherwise(last))


def location_of_name(name: str) -> str:
    """Python twin of :func:`location_of` for schema-only reports."""
    tok = name.split("_")
    if len(tok) < 2:
        return name
    return f"{tok[0]}_{tok[1]}" if tok[0] in SIDES else tok[0]


def metric_of_name(name: str) -> str:
    tok = name.split("_")
    if len(tok) < 2:
        return name
    return tok[-2] if tok[-1] in AXIS_TOKENS else tok[-1]

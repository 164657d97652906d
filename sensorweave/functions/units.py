"""Unit conversions to m/s^2 and rad/s, and numeric coercion."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorweave.catalog import STANDARD_GRAVITY

# Scales of the int16 full-range encodings (+-2 g and +-2000 deg/s).
INT16_ACC_SCALE = (2.0 * STANDARD_GRAVITY) / 32768.0
INT16_GYR_SCALE = (2000.0 * math.pi / 180.0) / 32768.0
DEG_TO_RAD = math.pi / 180.0

def six_bit_to_ms2(code: Column) -> Column:
    """6-bit accelerometer code (0..63 spans -1.5 g..+1.5 g) to m/s^2."""
    return (F.lit(-1.5) + (code / F.lit(63.0)) * F.lit(3.0)) * F.lit(STANDARD_GRAVITY)


def g_to_ms2(value: Column) -> Column:
    return value * F.lit(STANDARD_GRAVITY)


def int16_acc_to_ms2(raw: Column) -> Column:
    return raw * F.lit(INT16_ACC_SCALE)


def int16_gyr_to_rads(raw: Column) -> Column:
    return raw * F.lit(INT16_GYR_SCALE)


def deg_to_rad(value: Column) -> Column:
    return value * F.lit(DEG_TO_RAD)


def coerce_numeric(text: Column) -> Column:
    """Parse text as a double; anything that is not a number becomes null.

    A number is an optional sign, digits with an optional fraction and an
    optional exponent, or inf/infinity, with blanks around it. The cast alone
    also takes Java's type suffixes (``1d``) and hexadecimal digits: these are
    told by one letter. Numeric columns pass through; NaN becomes null so that
    a missing value has one representation.
    """
    as_text = F.trim(text.cast("string"))
    typed = F.right(as_text, F.lit(1)).isin("d", "f", "D", "F")
    hexadecimal = F.contains(as_text, F.lit("x")) | F.contains(as_text, F.lit("X"))
    plain = F.when(typed, F.lower(as_text).endswith("inf")).otherwise(~hexadecimal)
    return F.nanvl(F.when(plain, as_text.try_cast("double")), F.lit(None).cast("double"))


def nan_to_null(value: Column) -> Column:
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))

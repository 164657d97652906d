"""Property tests: the column functions agree with plain Python arithmetic."""

import math
from decimal import ROUND_HALF_EVEN, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorweave import catalog
from sensorweave.plans.oracle import NUMBER
from sensorweave.functions import timegrid, units

FEW = settings(max_examples=15, deadline=None)


def _eval(spark, values, schema, expr):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr.alias("v")).collect()]


@FEW
@given(st.lists(st.integers(-10**15, 10**15), min_size=1, max_size=50),
       st.sampled_from([10, 17, 20, 10_000, 3_600_000_000]))
def test_round_half_even_matches_decimal(spark, us, step):
    got = _eval(spark, us, "u long", timegrid.round_half_even(F.col("u"), step))
    want = [int((Decimal(u) / step).quantize(Decimal(1), rounding=ROUND_HALF_EVEN)) * step for u in us]
    assert got == want


@FEW
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=50))
def test_seconds_to_ms_matches_python_truncation(spark, secs):
    got = _eval(spark, secs, "s double", timegrid.seconds_to_ms(F.col("s")))
    assert got == [int(s * 1000.0) for s in secs]


@FEW
@given(st.lists(st.integers(0, 10**9), min_size=1, max_size=50),
       st.sampled_from([32, 50, 58.8, 100]))
def test_ms_from_rate_matches_python(spark, idx, fs):
    got = _eval(spark, idx, "i long", timegrid.ms_from_rate(F.col("i"), fs))
    assert got == [int(i * (1000 / fs)) for i in idx]


@FEW
@given(st.lists(st.floats(-1e4, 1e4, allow_nan=False), min_size=1, max_size=50))
def test_unit_conversions_invert(spark, xs):
    g = catalog.STANDARD_GRAVITY
    back = _eval(spark, xs, "x double", units.g_to_ms2(F.col("x")) / F.lit(g))
    assert all(math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12) for a, b in zip(back, xs))
    rad = _eval(spark, xs, "x double", units.deg_to_rad(F.col("x")) * F.lit(180.0 / math.pi))
    assert all(math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9) for a, b in zip(rad, xs))
    six = _eval(spark, xs, "x double", units.six_bit_to_ms2(F.col("x")))
    assert all(math.isclose(a, (-1.5 + (x / 63.0) * 3.0) * g) for a, x in zip(six, xs))


@FEW
@given(st.lists(st.one_of(st.floats(allow_nan=False, allow_infinity=False).map(repr),
                          st.integers(-10**12, 10**12).map(str),
                          st.text(alphabet="0123456789.eE+-dfx ", max_size=8)),
                min_size=1, max_size=50))
def test_coerce_numeric_accepts_exactly_plain_numbers(spark, texts):
    import re
    got = _eval(spark, texts, "t string", units.coerce_numeric(F.col("t")))
    for t, v in zip(texts, got):
        if re.fullmatch(NUMBER.strip("^$"), t):
            assert v == float(t)
        else:
            assert v is None

import pytest

from pyspark.sql.types import StructType

from sensorweave.operators import align, stack


def _long(spark):
    data = [("s1", 0, "a", 1.0, 10.0), ("s1", 0, "a", 3.0, float("nan")), ("s1", 0, "b", 5.0, 50.0),
            ("s1", 10, "b", 6.0, 60.0), ("s2", 0, "a", None, 1.0)]
    return spark.createDataFrame(data, "sid string, t long, sensor string, x double, y double")


def test_widen_mean_skips_nan_and_null(spark):
    out = align.widen(_long(spark), ["sid"], "t", "sensor", ["a", "b", "c"], ["x", "y"])
    got = {(r.sid, r.t): r.asDict() for r in out.collect()}
    assert got[("s1", 0)]["a_x"] == 2.0 and got[("s1", 0)]["a_y"] == 10.0
    assert got[("s1", 0)]["b_x"] == 5.0 and got[("s1", 0)]["c_x"] is None
    assert got[("s1", 10)]["a_x"] is None and got[("s1", 10)]["b_y"] == 60.0
    assert got[("s2", 0)]["a_x"] is None and got[("s2", 0)]["a_y"] == 1.0


def test_widen_error_policy_drops_recording_with_duplicates(spark):
    df = _long(spark)
    out = align.widen(df, ["sid"], "t", "sensor", ["a", "b"], ["x"], dedupe=align.ERROR)
    assert {r.sid for r in out.collect()} == {"s2"}
    dup = align.duplicate_keys(df, ["sid"], "t", "sensor").collect()
    assert [(r.sid, r.duplicate_samples) for r in dup] == [("s1", 1)]


def test_widen_max_policy(spark):
    out = align.widen(_long(spark), ["sid"], "t", "sensor", ["a"], ["x"], dedupe=align.MAX)
    got = {(r.sid, r.t): r.a_x for r in out.collect()}
    assert got[("s1", 0)] == 3.0


def test_widen_rejects_unknown_policy(spark):
    with pytest.raises(ValueError):
        align.widen(_long(spark), ["sid"], "t", "sensor", ["a"], ["x"], dedupe="first")


def test_stack_and_align(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2, 3.0)], "b string, k int, c double")
    st = stack.stack_by_name([a, b])
    assert st.columns == ["k", "a", "b", "c"]
    assert sorted(tuple(r) for r in st.collect()) == [(1, "x", None, None), (2, None, "y", 3.0)]
    target = StructType.fromDDL("c double, k long, z string")
    al = stack.align_to_schema(b, target)
    assert al.columns == ["c", "k", "z"] and al.schema["k"].dataType.simpleString() == "bigint"
    assert tuple(al.first()) == (3.0, 2, None)

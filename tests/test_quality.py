import pandas as pd

from sensorweave.plans import quality


def test_linearity_fixture(spark):
    cases = {"a": [0, 10, 20], "b": [0, 9, 20], "c": [0, 10, 30], "d": [0, 10, 5], "e": [7]}
    expect = {"a": True, "b": True, "c": False, "d": False, "e": True}
    data = [(k, t, i) for k, ts in cases.items() for i, t in enumerate(ts)]
    df = spark.createDataFrame(data, "sid string, time_ms long, pos long")
    by_time = {r.sid: r.linear for r in quality.linearity(df, ["sid"], "time_ms", 100).collect()}
    assert by_time == {**expect, "d": False}
    in_order = quality.linearity(df, ["sid"], "time_ms", 100, sort_first=False, order="pos").collect()
    got = {r.sid: (r.linear, r.has_negative) for r in in_order}
    assert got["d"] == (False, True) and got["a"] == (True, False) and got["e"] == (True, False)


def test_linearity_ignores_null_and_nan(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", None), ("a", float("nan")), ("a", 10.0)],
                               "sid string, time_ms double")
    r = quality.linearity(df, ["sid"], "time_ms", 100).first()
    assert (r.n_points, r.linear) == (2, True)


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, "x", float("nan")), (None, "y", 2.0)],
                               "a int, b string, c double")
    got = sorted(tuple(r) for r in quality.null_profile(df).collect())
    assert got == [("a", 1, 3), ("b", 1, 3), ("c", 1, 3)]


def test_null_examples_match_brute_force(spark):
    rows = []
    for sid in ("s1", "s2"):
        for i in range(40):
            v = None if (i % 7 == 3 or (sid == "s2" and i > 30)) else float(i)
            rows.append((sid, i * 10, v))
    df = spark.createDataFrame(rows, "sid string, time_ms long, x double")
    ex = quality.null_examples(df, ["sid"], "time_ms", max_examples=3, context=2, width=50.0)
    got = sorted((r.sid, r.example_no, r.ctx_offset, r.time_ms, r.more_flagged) for r in ex.collect())
    on_grid = quality.null_examples(df, ["sid"], "time_ms", max_examples=3, context=2, grid_step=10)
    assert sorted((r.sid, r.example_no, r.ctx_offset, r.time_ms, r.more_flagged)
                  for r in on_grid.collect()) == got
    want = []
    pdf = pd.DataFrame(rows, columns=["sid", "time_ms", "x"])
    for sid, g in pdf.groupby("sid"):
        g = g.sort_values("time_ms").reset_index(drop=True)
        flagged = list(g.index[g.x.isna()])
        for n, pos in enumerate(flagged[:3]):
            for off in range(-2, 3):
                if 0 <= pos + off < len(g):
                    want.append((sid, n + 1, off, int(g.time_ms[pos + off]), max(len(flagged) - 3, 0)))
    assert got == sorted(want)


def test_example_rows_are_never_broadcast_whole(spark, tmpdir_path):
    path = f"{tmpdir_path}/h"  # empty cells: a few bytes on disk, however many rows
    spark.range(5000).selectExpr("concat('s', id % 5) sid", "id DIV 5 * 10 time_ms", "CAST(NULL AS DOUBLE) x").write.parquet(path)
    ex = quality.null_examples(spark.read.parquet(path), ["sid"], "time_ms", grid_step=10)
    plan = ex._jdf.queryExecution().executedPlan().toString()
    join = next(line for line in plan.splitlines() if "_pos" in line and "Join [" in line)
    assert "ShuffledHashJoin" in join and "BuildLeft" in join
    assert ex.count() == 5 * (3 + 4 + 5) and {r.more_flagged for r in ex.collect()} == {997}


def test_schema_reports(spark):
    df = spark.createDataFrame([], "time_ms long, sid string, surface string, left_thigh_acc_x double, "
                                   "trunk_oriinc_q0 double, chest_ecg_1 double")
    cols = [tuple(r) for r in quality.column_listing(df, "luo").orderBy("ordinal").collect()]
    assert cols[0] == ("luo", 0, "time_ms", "bigint") and len(cols) == 6
    locs = sorted(r.location for r in quality.sensor_locations(df, "luo").collect())
    assert locs == ["chest", "left_thigh", "trunk"]
    mets = sorted(r.metric for r in quality.metric_names(df, "luo").collect())
    assert mets == ["1", "acc", "oriinc"]


def test_quality_report(spark):
    df = spark.createDataFrame([(0, "1", "flat", 1.0), (10, "1", "flat", None), (25, "1", "flat", 2.0)],
                               "time_ms long, sid string, surface string, chest_acc_x double")
    rep = {(r.check, r.key): (r.status, r.detail) for r in quality.quality_report(df, "x", ["sid"], 100).collect()}
    assert rep[("linearity", "1")][0] == "fail"
    assert rep[("nulls", "chest_acc_x")] == ("warn", "1/3")
    assert rep[("location", "chest")][0] == "info" and rep[("metric", "acc")][0] == "info"
    assert rep[("column", "time_ms")] == ("info", "bigint")


def test_quality_report_fs_from_config(spark):
    import pytest
    df = spark.createDataFrame([(0, "1", 1.0), (20, "1", 2.0)], "time_ms long, sid string, chest_acc_x double")
    rep = {(r.check, r.key): r.status for r in quality.quality_report(df, "mhealth", ["sid"]).collect()}
    assert rep[("linearity", "1")] == "pass"
    with pytest.raises(ValueError):
        quality.quality_report(df, "unknown", ["sid"])

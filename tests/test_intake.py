"""Repeatable appends, outputs in a fixed number of folders, and the joint report."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sensorweave.plans import quality, recordings
from sensorweave.sources import files, sinks, text
from tests import raw_layouts


def _rows(df):
    return sorted(map(str, df.collect()))


def _table(spark, sids, value=1.0):
    rows = [(str(s) if s is not None else None, t * 10, value * t) for s in sids for t in range(5)]
    return spark.createDataFrame(rows, "sid string, time_ms long, x double")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_repeated_batch_leaves_its_rows_once(spark, tmpdir_path, fmt):
    out = os.path.join(tmpdir_path, "out")
    first = _table(spark, ["01", "1", "a/b"])
    write = (lambda df: sinks.write_parquet(df, out)) if fmt == "parquet" else (lambda df: sinks.write_csv(df, out, partition_by=["sid"]))
    read = (lambda: sinks.read_output(spark, out)) if fmt == "parquet" else (lambda: sinks.read_csv_output(spark, out, first.schema))
    write(first)
    batch = _table(spark, ["2", "3"]).withColumn("extra", F.lit(1))
    for _ in range(2):
        sinks.replace_subjects(batch, out, fmt)
        assert _rows(read()) == _rows(first.unionByName(_table(spark, ["2", "3"])))
    changed = _table(spark, ["1", "3"], -2.0)
    sinks.replace_subjects(changed, out, fmt)
    assert _rows(read()) == _rows(_table(spark, ["01", "a/b", "2"]).unionByName(changed))


def test_csv_appends_keep_every_row(spark, tmpdir_path):
    out, rows = os.path.join(tmpdir_path, "flat"), _table(spark, ["1", "2"])
    sinks.write_csv(rows.repartition(3), out)
    sinks.append_aligned(_table(spark, ["7"]).repartition(4).withColumn("y", F.lit(0)), out, "csv")
    back = sinks.read_csv_output(spark, out, rows.schema)
    assert _rows(back) == _rows(rows.unionByName(_table(spark, ["7"])))
    with pytest.raises(ValueError):
        sinks.replace_subjects(rows, out, "csv")


def test_luo_subjects_can_be_appended_again(spark, tmpdir_path):
    root, out = raw_layouts.luo(tmpdir_path), os.path.join(tmpdir_path, "out", "luo")
    full = recordings.harmonise_luo(spark, root, sids=[1]).data
    sinks.write_parquet(full, out)
    for _ in range(2):
        recordings.append_luo_subjects(spark, root, [2], out, replace=True)
    assert sinks.read_output(spark, out).count() == full.count() + 1


def test_folders_do_not_grow_with_subjects(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "buckets")
    rows = _table(spark, [*range(60), "01", None, "a/b"])
    sinks.write_parquet(rows, out, buckets=4)
    folders = [f for f in os.listdir(out) if f.startswith("part_bucket=")]
    assert len(folders) <= 4
    assert sinks.read_output(spark, out).schema == rows.schema and _rows(sinks.read_output(spark, out)) == _rows(rows)
    some = sinks.read_subjects(spark, out, ["7", "01"], buckets=4)
    assert _rows(some) == _rows(rows.where("sid IN ('7', '01')"))
    # the subjects' folders are chosen before the scan, rows by their statistics
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "part_bucket" in plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "PushedFilters: [In(sid" in plan or "PushedFilters: [IsNotNull(sid), In(sid" in plan or "Or(EqualTo(sid" in plan
    files = some.select(F.input_file_name().alias("f")).distinct().collect()
    assert {f.f.split("part_bucket=")[1].split("/")[0] for f in files} <= {f.split("=")[1] for f in folders}
    single = os.path.join(tmpdir_path, "folders")
    sinks.write_parquet(rows, single)
    assert _rows(sinks.read_subjects(spark, single, ["1", "01"])) == _rows(rows.where("sid IN ('1', '01')"))


def test_the_joint_report_says_what_single_reports_say(spark, tmpdir_path):
    a = spark.createDataFrame([("s", t * 20, "flat", None if t in (2, 5, 9, 11) else 1.0) for t in range(14)], "sid string, time_ms long, surface string, chest_acc_x double")
    b = spark.createDataFrame([(1, 2, t * 10 if t < 6 else t * 11, float("nan") if t == 3 else 2.0, None) for t in range(9)],
                              "sid int, trial_no int, time_ms long, left_wrist_gyr_y double, trunk_roll double")
    empty = a.where("false")
    tables = {"mhealth": (a, ["sid"]), "luo": (b, ["sid", "trial_no"]), "karas": (empty, ["sid"])}
    got = quality.quality_report_all(tables)
    want = [row for name, (df, keys) in tables.items() for row in _rows(quality.quality_report(df, name, keys))]
    assert _rows(got) == sorted(want)
    with pytest.raises(ValueError):
        quality.quality_report_all({"nope": (a, ["sid"])})


def test_the_joint_report_sorts_bounded_tasks_and_crosses_segments(spark, monkeypatch):
    gone = {2, 3, 4, 17, 18, 40}
    a = spark.createDataFrame([("s", t * 20 + (900 if t > 30 else 0), 1.0 if t not in gone else None) for t in range(45)]
                              + [("u", None, 1.0), ("u", 5, None), ("v", None, None), ("w", 0, 1.0), (None, 1, None)], "sid string, time_ms long, chest_acc_x double")
    b = spark.createDataFrame([(1, t * 20, None if t == 7 else 2.0) for t in range(9)], "sid int, time_ms long, left_wrist_gyr_y double")
    # what single reports say, but that a recording without a key is one here too
    want = [row for name, df in (("mhealth", a.where("sid IS NOT NULL")), ("luo", b)) for row in _rows(quality.quality_report(df, name, ["sid"], 50)) if "'nulls'" not in row]
    dealt, plain, write = {}, quality.seq.with_segments, quality.materialize
    monkeypatch.setattr(quality, "TASK_ROWS", 10)
    monkeypatch.setattr(quality.seq, "with_segments", lambda *x, **y: plain(*x, **y, target_rows=3))
    monkeypatch.setattr(quality, "materialize", lambda df, name: dealt.update({name: df.rdd.getNumPartitions()}) or write(df, name))
    got = quality.quality_report_all({"mhealth": (a, ["sid"]), "luo": (b, ["sid"])}, {"mhealth": 50, "luo": 50})
    assert _rows(got.where("check <> 'nulls' AND NOT (check IN ('linearity', 'null_example') AND (key = '' OR key LIKE '/%'))")) == sorted(want)
    assert dealt["examples"] == 6  # 59 rows, 10 a task


def test_segments_leave_the_rows_where_they_are(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100).selectExpr("id % 3 AS sid", "id AS t")
        seg = quality.seq.with_segments(df, ["sid"], "t", target_rows=20)
        assert "SortMergeJoin" not in seg._jdf.queryExecution().executedPlan().toString()
        sizes = [r["count"] for r in seg.groupBy("sid", quality.seq.SEG).count().collect()]
        assert sum(sizes) == 100 and max(sizes) <= 21
        assert {r[0] for r in quality.seq.with_segments(df, ["sid"], "t", target_rows=40).select(quality.seq.SEG).distinct().collect()} == {0}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_datasets_are_found_by_folder(spark, tmpdir_path):
    for name in ("beach", "luo"):
        sinks.write_parquet(_table(spark, ["1"]), os.path.join(tmpdir_path, "all", name))
    found = quality.stored_datasets(spark, os.path.join(tmpdir_path, "all"))
    assert sorted(found) == ["beach", "luo"] and found["luo"].columns == ["sid", "time_ms", "x"]


def _sensor_file(spark, root, sid, sensor, columns, rows):
    spark.createDataFrame(rows, columns).coalesce(1).write.mode("append").parquet(f"{root}/sid={sid}/sensor={sensor}")


def test_sensor_folders(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "folders")
    _sensor_file(spark, root, "01", "left_wrist", "datetime timestamp_ntz, x double, y double", [(datetime(2020, 1, 1), 1.0, 2.0)])
    _sensor_file(spark, root, "1", "left_wrist", "` DateTime` timestamp_ntz, X double, z double, battery int", [(datetime(2020, 1, 1), 3.0, 4.0, 9)])
    _sensor_file(spark, root, "1", "forehead", "datetime timestamp_ntz, x double", [(datetime(2020, 1, 1), 7.0)])
    _sensor_file(spark, root, "7", "right_foot", "datetime timestamp_ntz, x double", [(datetime(2020, 1, 1), 5.0)])
    wanted = ["left_wrist", "right_foot"]
    long, absent = text.read_sensor_folders(spark, root, wanted)
    assert long.columns == ["sid", "sensor", "datetime", "x", "y", "z"]
    assert sorted((r.sid, r.sensor, r.x, r.y, r.z) for r in long.collect()) == [
        ("01", "left_wrist", 1.0, 2.0, None), ("1", "left_wrist", 3.0, None, 4.0), ("7", "right_foot", 5.0, None, None)]
    assert sorted(map(tuple, absent.collect())) == [("01", "right_foot"), ("1", "right_foot"), ("7", "left_wrist")]
    table = spark.createDataFrame([("1",), ("99",)], "sid string")
    for subjects in (["1", "99"], table):
        some, gone = text.read_sensor_folders(spark, root, wanted, subjects)
        assert [r.sid for r in some.collect()] == ["1"] and list(map(tuple, gone.collect())) == [("1", "right_foot")]
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert ("dynamicpruning" if subjects is table else "PartitionFilters: [sid") in plan
    h = recordings.harmonise_beach_folders(spark, root, ["01"])
    assert [(r.sid, r.time_ms) for r in h.data.collect()] == [("01", 0)] and h.rejects.count() == 7


def test_only_new_and_changed_files_are_read(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "in")

    def put(name, body):
        os.makedirs(os.path.join(root, os.path.dirname(name)), exist_ok=True)
        with open(os.path.join(root, name), "w") as out:
            out.write(body)

    for name in ("a b/1.csv", "2.csv", "3.csv", "4.csv"):
        put(name, "x\n1\n")
    first = files.write_manifest(files.file_listing(spark, root, "*.csv"), os.path.join(tmpdir_path, "manifest-1"))
    put("2.csv", "x\n1\n2\n")
    put("5+.csv", "x\n9\n")
    os.remove(os.path.join(root, "3.csv"))
    changes = files.changed_files(files.file_listing(spark, root, "*.csv"), first)
    assert {os.path.basename(r.path): r.status for r in changes.collect()} == {"1.csv": "same", "2.csv": "changed", "3.csv": "removed", "4.csv": "same", "5+.csv": "new"}
    scan = text.read_headed(spark, files.paths_to_read(changes))
    assert sorted((r["name"], r.x) for r in scan.rows.collect()) == [("2.csv", "1"), ("2.csv", "2"), ("5+.csv", "9")]
    assert sorted(os.path.basename(r.path) for r in scan.files.collect()) == ["2.csv", "5+.csv"] and scan.rejects.count() == 0
    assert files.paths_to_read(files.changed_files(first, first)) == []

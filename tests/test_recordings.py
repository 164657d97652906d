import math
import os

from sensorweave import catalog
from sensorweave.plans import recordings
from sensorweave.sources import sinks, text
from tests import raw_layouts

G = catalog.STANDARD_GRAVITY


def test_mhealth(spark, tmpdir_path):
    root = raw_layouts.mhealth(tmpdir_path)
    h = recordings.harmonise_mhealth(spark, root)
    rows = sorted(h.data.collect(), key=lambda r: (r.sid, r.time_ms))
    assert h.data.columns[:3] == ["time_ms", "sid", "surface"] and len(h.data.columns) == 26
    s1 = [r for r in rows if r.sid == 1]
    assert [r.time_ms for r in s1] == [0, 20, 40, 60, 80]
    assert [r.surface for r in s1] == ["non-study activity", "flat", "flat", "flat", "jump_front_back"]
    s2 = [r for r in rows if r.sid == 2]
    assert [r.surface for r in s2] == [None, "standing", "standing"]
    assert math.isclose(s1[0].left_ankle_gyr_x, math.pi) and s1[1].chest_acc_x == 1.0
    assert sorted(r.sid for r in h.missing.collect()) == list(range(3, 11))


def test_hugadb(spark, tmpdir_path):
    root = raw_layouts.hugadb(tmpdir_path)
    h = recordings.harmonise_hugadb(spark, root)
    all_rows = h.data.collect()
    assert h.data.columns[:4] == ["time_ms", "sid", "surface", "trial_no"]
    assert len(all_rows) == 7
    # two activity files share (sid 3, trial 5): both kept
    walk = sorted((r.time_ms, r.surface) for r in all_rows if (r.sid, r.trial_no) == (3, 5))
    assert walk == [(0, "flat"), (0, "flat"), (17, "flat"), (34, "other")]
    r = [x for x in all_rows if x.surface == "other"][0]
    assert math.isclose(r.right_foot_acc_x, (32767 - 40) * (2 * G) / 32768)
    assert r.right_thigh_emg == 32767 - 40 + 36
    assert [x.reason for x in h.rejects.collect()] == ["more than 39 fields"]


def test_bruno(spark, tmpdir_path):
    root = raw_layouts.bruno(tmpdir_path)
    h = recordings.harmonise_bruno(spark, root)
    rows = h.data.collect()
    assert h.data.columns == ["time_ms", "sid", "surface", "trial_no",
                              "right_wrist_acc_x", "right_wrist_acc_y", "right_wrist_acc_z"]
    by_trial = {}
    for r in rows:
        by_trial.setdefault(r.trial_no, []).append(r)
    # trials in sorted path order: Brush_teeth, Climb_stairs, Walk(m2, 03-24), Walk(f1, 03-25)
    assert sorted(by_trial) == [1, 2, 3, 4]
    climb = sorted(by_trial[2], key=lambda r: r.time_ms)
    assert [r.time_ms for r in climb] == [0, 31, 62, 93, 125]
    assert climb[0].surface == "stairs_up" and math.isclose(climb[0].right_wrist_acc_x, -1.5 * G)
    assert math.isclose(climb[0].right_wrist_acc_y, 1.5 * G)
    assert {r.sid for r in by_trial[1]} == {1} and {r.sid for r in by_trial[3]} == {2}
    assert {r.sid for r in by_trial[4]} == {1}
    walk_m2 = sorted(by_trial[3], key=lambda r: r.time_ms)
    assert [r.time_ms for r in walk_m2] == [0, 31] and walk_m2[0].surface == "flat"
    reasons = sorted(r.reason for r in h.rejects.collect())
    assert reasons == ["empty file", "file name has fewer than 9 parts", "more than 3 fields"]


def test_karas(spark, tmpdir_path):
    root = raw_layouts.karas(tmpdir_path)
    h = recordings.harmonise_karas(spark, root)
    got = {(r.sid, r.time_ms): r for r in h.data.collect()}
    assert h.data.columns == ["time_ms", "sid", "surface", "lw_x", "lw_y", "lw_z", "la_x"]
    r = got[("id00b70b13", 2009)]
    assert r.surface == "stairs_up" and r.lw_y is None and math.isclose(r.lw_x, G)
    assert got[("id00b70b13", 3000)].surface is None
    other = got[("id0a", 1000)]
    assert other.surface == "non-study activity"
    assert (other.lw_x, other.lw_z, other.la_x, other.lw_y) == (3 * G, 2 * G, 4 * G, None)


def test_luo(spark, tmpdir_path):
    root = raw_layouts.luo(tmpdir_path)
    h = recordings.harmonise_luo(spark, root)
    d = h.data
    assert d.columns[:5] == ["time_ms", "sid", "surface", "trial_no", "packetcounter"]
    assert "trunk_acc_x" in d.columns and "right_wrist_acc_z" in d.columns
    rows = sorted(d.collect(), key=lambda r: (r.sid, r.trial_no, r.packetcounter))
    t4 = [r for r in rows if (r.sid, r.trial_no) == (1, 4)]
    assert [(r.packetcounter, r.time_ms) for r in t4] == [(10, 0), (11, 10), (12, 20), (13, 30)]
    assert all(r.surface == "flat" for r in t4)
    assert t4[0].trunk_acc_x == 1.0 and t4[0].right_wrist_acc_x == 7.0 and t4[0].right_wrist_acc_z == 9.0
    assert t4[1].right_wrist_acc_x is None and t4[1].right_wrist_acc_z == 9.1
    assert t4[2].trunk_acc_x is None and t4[2].right_wrist_acc_x == 7.2
    assert t4[3].trunk_acc_z == 3.3 and t4[3].right_wrist_acc_x is None
    assert {r.surface for r in rows if r.trial_no == 60} == {"unknown"}
    assert {(r.sid, r.trial_no) for r in rows} == {(1, 4), (1, 60), (2, 18)}
    reasons = sorted((os.path.basename(r.path), r.reason) for r in h.rejects.collect())
    assert ("16-000_00B432ZZ.csv", "unknown sensor code") in reasons
    assert ("17-000_00B4329B.csv", "sensor repeats a packet in its trial") in reasons
    assert ("4-000_00B432CC.csv", "more fields than header") in reasons


def test_luo_append_aligns_to_target(spark, tmpdir_path):
    root = raw_layouts.luo(tmpdir_path)
    out = os.path.join(tmpdir_path, "out", "luo")
    full = recordings.harmonise_luo(spark, root, sids=[1]).data
    target = full.drop("right_wrist_acc_y").withColumn("extra", full.time_ms * 0)
    sinks.write_parquet(target, out)  # partitioned by subject, as by default
    appended = recordings.append_luo_subjects(spark, root, [2], out)
    assert appended.columns == target.columns
    back = sinks.read_output(spark, out)
    assert back.columns == target.columns and back.count() == full.count() + 1
    assert back.filter("sid = 2").first().extra is None


def test_beach_long(spark):
    from datetime import datetime
    data = [("s1", "left_wrist", datetime(2020, 1, 1, 0, 0, 0, 4000), 1.0, 0.0, 0.0),
            ("s1", "left_wrist", datetime(2020, 1, 1, 0, 0, 0, 3000), 3.0, 0.0, 0.0),
            ("s1", "right_foot", datetime(2020, 1, 1, 0, 0, 0, 35000), 2.0, 1.0, 1.0),
            ("s1", "right_foot", datetime(2020, 1, 1, 0, 0, 2, 15000), 1.0, 1.0, 1.0),
            ("s1", "left_wrist", None, 9.0, 9.0, 9.0)]
    df = spark.createDataFrame(data, "SID string, Sensor string, DateTime timestamp_ntz, x double, y double, z double")
    h = recordings.harmonise_beach(df)
    rows = sorted(h.data.collect(), key=lambda r: r.time_ms)
    assert h.data.columns[:3] == ["time_ms", "sid", "surface"] and len(h.data.columns) == 3 + 24
    assert rows[0].time_ms == 0 and math.isclose(rows[0].left_wrist_acc_x, 2.0 * G)
    # 35 ms rounds half-even to 40; 2.015 s to 2.02 s -> 2020 ms after the 0 ms start
    assert rows[4].time_ms == 40 and math.isclose(rows[4].right_foot_acc_x, 2.0 * G)
    assert rows[-1].time_ms == 2020 and len(rows) == 203
    assert rows[1].left_wrist_acc_x is None


def test_text_readers_handle_split_files(spark, tmpdir_path):
    # a file larger than the split size is read in several splits; numbering stays global
    path = os.path.join(tmpdir_path, "big", "mHealth_subject1.log")
    os.makedirs(os.path.dirname(path))
    n = 20000
    with open(path, "w") as fh:
        for i in range(n):
            fh.write("\t".join([str(i)] * 23 + ["1"]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        scan = text.read_delimited(spark, os.path.dirname(path), catalog.MHEALTH_COLUMNS)
        assert spark.read.text(path).rdd.getNumPartitions() > 4
        got = {r.line_no: r.chest_acc_x for r in scan.rows.select("line_no", "chest_acc_x").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == n and all(got[i] == str(i) for i in range(n))


def test_csv_sink_writes_empty_for_missing(spark, tmpdir_path):
    df = spark.createDataFrame([(0, 1.0), (10, float("nan")), (20, None)], "time_ms long, x double")
    out = os.path.join(tmpdir_path, "csv")
    sinks.write_csv(df.coalesce(1), out)
    body = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out)) if f.endswith(".csv"))
    assert body.splitlines() == ["time_ms,x", "0,1.0", "10,", "20,"]


def test_reports_and_dispatch(spark, tmpdir_path):
    root = raw_layouts.luo(tmpdir_path)
    scan = text.read_headed(spark, root, glob="*.csv", recursive=True)
    from pyspark.sql import functions as F
    from sensorweave.functions import paths
    lines = scan.rows.withColumns({"sid": paths.dir_below(F.col("path"), root).try_cast("int"),
                                   "trial_no": paths.trial_prefix(F.col("name")).try_cast("int")})
    man = {(r.sid, r.trial_no): r.n_files for r in recordings.trial_manifest(lines).collect()}
    assert man[(1, 4)] == 2 and man[(2, 17)] == 1
    h = recordings.harmonise("luo", spark, root)
    tot = recordings.run_totals(h.data, scan.rows).first()
    assert (tot.subjects, tot.trials, tot.rows, tot.files) == (2, 3, 7, 7)
    import pytest
    with pytest.raises(ValueError):
        recordings.harmonise("nope", spark, root)


def test_read_long_normalises_names(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "long")
    spark.createDataFrame([("1", "left_foot", 1.0)], "` SID` string, Sensor string, X double") \
        .write.parquet(out)
    assert text.read_long(spark, out).columns == ["sid", "sensor", "x"]


def test_delimited_bad_line_takes_no_slot(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "tsv")
    os.makedirs(d)
    with open(os.path.join(d, "mHealth_subject1.log"), "w") as fh:
        fh.write("1\t2\n1\t2\t3\n5\t6\n")
    scan = text.read_delimited(spark, d, ["a", "b"])
    assert sorted((r.line_no, r.a) for r in scan.rows.collect()) == [(0, "1"), (1, "5")]
    assert [r.reason for r in scan.rejects.collect()] == ["more than 2 fields"]


def test_numbering_with_packed_splits_of_several_files(spark, tmpdir_path):
    # two large files split at the same offsets and small files packed with
    # their last splits: every line must still get its position in its file
    d = os.path.join(tmpdir_path, "many")
    os.makedirs(d)
    sizes = {"a.log": 6000, "b.log": 6000, "c.log": 3, "d.log": 1, "e.log": 700}
    for name, n in sizes.items():
        with open(os.path.join(d, name), "w") as fh:
            for i in range(n):
                fh.write(f"{name}\t{i}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        scan = text.read_delimited(spark, d, ["f", "i"], glob="*.log", recursive=False)
        got = [(r.f, r.line_no, r.i) for r in scan.rows.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == sum(sizes.values())
    assert all(str(line_no) == i for _, line_no, i in got)


def _write(path, text_):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text_)


def test_text_ids_survive_the_sink(spark, tmpdir_path):
    df = spark.createDataFrame([("01", 0, 1.0), ("1", 0, 2.0), (None, 0, 3.0), ("a/b", 0, 4.0)], "sid string, time_ms long, x double")
    out = os.path.join(tmpdir_path, "ids")
    sinks.write_parquet(df, out)
    back = sinks.read_output(spark, out)
    assert back.schema == df.schema
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_luo_reports_everything_it_leaves_out(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "luo")
    head = "PacketCounter,Acc_X\n"
    _write(f"{root}/1/4-000_CC.csv", head + "1,1.0\nx,2.0\n3,3.0\n1,2,3\n")
    _write(f"{root}/1/notes-000_CC.csv", head + "1,1.0\n")
    _write(f"{root}/1/5-000_ZZ.csv", head + "1,1.0\n")
    _write(f"{root}/99/4-000_CC.csv", head + "1,1.0\n")
    _write(f"{root}/x/4-000_CC.csv", head + "1,1.0\n")
    _write(f"{root}/2/6-000_CC.csv", head + "1,1.0\n1,2.0\n")
    h = recordings.harmonise_luo(spark, root)
    rows = sorted((r.sid, r.trial_no, r.time_ms) for r in h.data.collect())
    assert rows == [(1, 4, 0), (1, 4, 10), (1, 4, 20)]
    got = [("/".join(r.path.split("/")[-2:]), r.line_no, r.reason) for r in h.rejects.collect()]
    assert set(got) == {
        ("1/4-000_CC.csv", 1, "unreadable packet counter"), ("1/4-000_CC.csv", 3, "more fields than header"),
        ("1/notes-000_CC.csv", None, "no trial number"), ("1/5-000_ZZ.csv", None, "unknown sensor code"),
        ("99/4-000_CC.csv", None, "subject outside the layout's range"), ("x/4-000_CC.csv", None, "no subject number"),
        ("2/6-000_CC.csv", None, "sensor repeats a packet in its trial")} and len(got) == 7


def test_asking_for_subjects_opens_only_their_files(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "luo")
    for sid in range(1, 7):
        _write(f"{root}/{sid}/4-000_CC.csv", "PacketCounter,Acc_X\n1,1.0\n2,2.0\n")
    scan = text.read_headed(spark, root, columns=["packetcounter", "acc_x"], glob="*.csv",
                            where=lambda p: p.contains("/luo/3/"))
    assert [r.path.split("/")[-2] for r in scan.files.collect()] == ["3"]
    # the rule on the path is part of the scan itself, which lists files by it
    lines = text.scan_lines(spark, root, glob="*.csv", where=lambda p: p.contains("/luo/3/"))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "/luo/3/" in plan[plan.index("FileScan text"):]
    h = recordings.harmonise_luo(spark, root, sids=[3])
    assert {r.sid for r in h.data.collect()} == {3} and h.rejects.count() == 0


def test_hugadb_numbers_kept_lines_and_reports_names(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "huga")
    good = " ".join(["1"] * 39)
    _write(f"{root}/HGD_v1_walking_03_05.txt", f"# c\nhead line\n{good}\n{good} 7\n{good}\n")
    _write(f"{root}/odd.txt", f"head\n{good}\n")
    wide_head = " ".join(["h"] * 45)  # a header of any width is a header
    _write(f"{root}/HGD_v1_walking_04_01.txt", f"{wide_head}\n{good}\n{wide_head}\n{good}\n")
    h = recordings.harmonise_hugadb(spark, root)
    assert sorted((r.sid, r.time_ms) for r in h.data.collect()) == [(3, 0), (3, 17), (4, 0), (4, 17)]
    got = sorted((os.path.basename(r.path), r.reason) for r in h.rejects.collect())
    assert got == [("HGD_v1_walking_03_05.txt", "more than 39 fields"), ("HGD_v1_walking_04_01.txt", "more than 39 fields"),
                   ("odd.txt", "no subject and trial number in the file name")]


def test_mhealth_reports_subjects_outside_the_range(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "mh")
    line = "\t".join(["1"] * 24) + "\n"
    _write(f"{root}/mHealth_subject1.log", line)
    _write(f"{root}/mHealth_subject11.log", line)
    _write(f"{root}/mHealth_subjectX.log", line)
    h = recordings.harmonise_mhealth(spark, root)
    assert [r.sid for r in h.data.collect()] == [1] and sorted(r.sid for r in h.missing.collect()) == list(range(2, 11))
    assert sorted((os.path.basename(r.path), r.reason) for r in h.rejects.collect()) == [
        ("mHealth_subject11.log", "subject outside the layout's range"), ("mHealth_subjectX.log", "no subject in the file name")]


def test_karas_quoted_fields_and_numeric_label_text(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "karas")
    _write(f"{root}/a.csv", '"activity","time_s","lw_x"\n"1.0","0.5","2"\n2,"1,5",3\n"2",2.5,"say ""x"", y"\n')
    rows = sorted(recordings.harmonise_karas(spark, root).data.collect(), key=lambda r: (r.time_ms is None, r.time_ms))
    assert [c for c in rows[0].asDict()] == ["time_ms", "sid", "surface", "lw_x"]
    assert [(r.time_ms, r.surface) for r in rows] == [(500, catalog.KARAS_SURFACES[1]), (2500, catalog.KARAS_SURFACES[2]), (None, catalog.KARAS_SURFACES[2])]
    assert math.isclose(rows[0].lw_x, 2 * G) and rows[1].lw_x is None
    fields = spark.createDataFrame([('a,"b,c","d""e",,"",f',), ("x, y",), ('"q" , "r"',)], "line string")
    got = [r.f for r in fields.select(text.split_csv(fields.line, ",", True).alias("f")).collect()]
    assert got == [["a", "b,c", 'd"e', "", "", "f"], ["x", "y"], ["q", "r"]]


def test_other_sensors_make_no_slots(spark):
    from datetime import datetime
    at = lambda ms: datetime(2020, 1, 1, 0, 0, 0, ms * 1000)
    df = spark.createDataFrame([("s", "forehead", at(0), 1.0), ("s", "left_wrist", at(50), 1.0)], "sid string, sensor string, datetime timestamp_ntz, x double")
    df = df.selectExpr("*", "x as y", "x as z")
    assert [r.time_ms for r in recordings.harmonise_beach(df).data.collect()] == [0]


def test_line_data_is_not_shuffled(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "t", "a.log"), "1\t2\n")
    rows = text.read_delimited(spark, os.path.join(tmpdir_path, "t"), ["a", "b"]).rows
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Sort" not in plan and "BroadcastHashJoin" in plan

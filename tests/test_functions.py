import math
from pathlib import PurePath

import pytest
from pyspark.sql import functions as F

from sensorweave import catalog
from sensorweave.functions import labels, names, paths, timegrid, units


def col_values(spark, data, schema, expr):
    df = spark.createDataFrame(data, schema)
    return [r[0] for r in df.select(expr.alias("v")).collect()]


def test_round_half_even_on_integer_axis(spark):
    # 10 ms grid in micros: exact halves go to the even multiple
    us = [0, 4999, 5000, 15000, 25000, 25001, -5000, -15000, 123456]
    got = col_values(spark, [(u,) for u in us], "u long", timegrid.round_half_even(F.col("u"), 10000))
    assert got == [0, 0, 0, 20000, 20000, 30000, 0, -20000, 120000]


def test_seconds_to_ms_truncates_like_astype_int(spark):
    got = col_values(spark, [(2.01,), (0.5,), (6.55,), (-1.5,)], "s double",
                     timegrid.seconds_to_ms(F.col("s")))
    assert got == [int(2.01 * 1000), 500, int(6.55 * 1000), -1500]
    assert got[0] == 2009  # the float trap is kept for parity


def test_ms_from_rate_32hz(spark):
    got = col_values(spark, [(i,) for i in range(6)], "i long", timegrid.ms_from_rate(F.col("i"), 32))
    assert got == [0, 31, 62, 93, 125, 156]


def test_elapsed_ms_floor(spark):
    got = col_values(spark, [(5_000_999, 1_000_000)], "u long, s long",
                     timegrid.elapsed_ms(F.col("u"), F.col("s")))
    assert got == [4000]


def test_epoch_micros_ignores_session_time_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:01.5' AS ts")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        v = df.select(timegrid.epoch_micros(df, "ts")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert v == 1704067201500000


def test_units(spark):
    g = catalog.STANDARD_GRAVITY
    six = col_values(spark, [(0.0,), (63.0,)], "c double", units.six_bit_to_ms2(F.col("c")))
    assert math.isclose(six[0], -1.5 * g) and math.isclose(six[1], 1.5 * g)
    acc = col_values(spark, [(32768.0,)], "c double", units.int16_acc_to_ms2(F.col("c")))
    assert math.isclose(acc[0], 2 * g)
    gyr = col_values(spark, [(32768.0,)], "c double", units.int16_gyr_to_rads(F.col("c")))
    assert math.isclose(gyr[0], 2000 * math.pi / 180)
    rad = col_values(spark, [(180.0,)], "c double", units.deg_to_rad(F.col("c")))
    assert math.isclose(rad[0], math.pi)
    assert col_values(spark, [(1.0,)], "c double", units.g_to_ms2(F.col("c"))) == [g]


def test_coerce_numeric(spark):
    texts = ["1", " 3.5 ", "-2e3", ".5", "1d", "1.5f", "abc", "", None, "inf", "nan", "0x10"]
    got = col_values(spark, [(t,) for t in texts], "t string", units.coerce_numeric(F.col("t")))
    assert got[:4] == [1.0, 3.5, -2000.0, 0.5]
    assert got[4:9] == [None] * 5
    assert got[9] == float("inf")
    assert got[10] is None and got[11] is None


def test_label_policies(spark):
    data = [("walk",), ("climb_stairs",), ("comb_hair",), (None,)]
    ident = col_values(spark, data, "a string",
                       labels.map_label(F.col("a"), catalog.BRUNO_SURFACES, labels.IDENTITY))
    assert ident == ["flat", "stairs_up", "comb_hair", None]
    codes = [(1,), (77,), (5,), (None,)]
    assert col_values(spark, codes, "c int", labels.map_label(F.col("c"), catalog.KARAS_SURFACES)) == \
        ["flat", "clapping", None, None]
    assert col_values(spark, [(2,), (99,)], "c int",
                      labels.map_label(F.col("c"), catalog.HUGADB_SURFACES, "other")) == ["flat", "other"]
    trial = labels.expand_lists(catalog.LUO_TRIAL_SURFACES)
    assert len(trial) == 57
    assert col_values(spark, [("16",), ("57",), ("60",), ("x",)], "c string",
                      labels.map_label(F.col("c"), trial, "unknown")) == \
        ["stairs_up", "grass", "unknown", "unknown"]


def test_stem_matches_pathlib(spark):
    names_ = ["a.b", ".bashrc", "a.", "a.b.c", "noext", "..", "a..b", ".a.b", "x/y/HGD_v2_w_03_05.txt"]
    got = col_values(spark, [(n,) for n in names_], "p string", paths.file_stem(F.col("p")))
    assert got == [PurePath(n).stem for n in names_]


def test_path_parsing(spark):
    p = "/data/bruno/Walk/Accelerometer-2011-03-24-10-25-44-walk-m2.txt"
    df = spark.createDataFrame([(p,)], "p string")
    ok, act, vol = paths.dashed_metadata(paths.file_name(F.col("p")))
    r = df.select(ok, act, vol, paths.parent_dir(F.col("p")), paths.dir_below(F.col("p"), "file:///data/bruno")).first()
    assert tuple(r) == (True, "walk", "m2", "Walk", "Walk")
    sid, trial = paths.underscored_ids(F.lit("HGD_v2_walking_03_05"))
    assert tuple(df.select(sid, trial).first()) == (3, 5)
    codes = col_values(spark, [("4-000_00B432CC.csv",), ("x.95.csv",), ("C.txt",)], "n string",
                       paths.suffix_code(F.col("n")))
    assert codes == [n.split(".")[0][-2:] for n in ("4-000_00B432CC.csv", "x.95.csv", "C.txt")]
    assert col_values(spark, [("12-abc",), ("nodash",)], "n string", paths.trial_prefix(F.col("n"))) == \
        ["12", "nodash"]
    enc = col_values(spark, [("file:/a%20b/c+d.txt",)], "p string", paths.decoded_path(F.col("p")))
    assert enc == ["file:/a b/c+d.txt"]


def test_name_rules_fixture(spark):
    fixture = [("left_thigh_acc_x", "left_thigh", "acc"), ("trunk_oriinc_q0", "trunk", "oriinc"),
               ("left_thigh_emg", "left_thigh", "emg"), ("right_lower_leg_acc_z", "right_lower", "acc"),
               ("chest_ecg_1", "chest", "1"), ("lw_x", "lw", "lw"), ("single", "single", "single")]
    df = spark.createDataFrame([(n,) for n, _, _ in fixture], "n string")
    got = [tuple(r) for r in df.select("n", names.location_of(F.col("n")), names.metric_of(F.col("n"))).collect()]
    assert got == fixture
    assert [(n, names.location_of_name(n), names.metric_of_name(n)) for n, _, _ in fixture] == fixture


def test_exact_seconds(spark):
    df = spark.createDataFrame([(2.009,), (0.29,), (-0.29,), (None,), (1e-6,), (12345.678901,)], "s double")
    got = [r.m for r in df.select(timegrid.seconds_to_ms(df.s, "exact").alias("m")).collect()]
    assert got == [2009, 290, -290, None, 0, 12345678]
    assert df.select(timegrid.seconds_to_ms(df.s).alias("m")).collect()[1].m == int(0.29 * 1000)


def test_error_policy_and_whole_number_text(spark):
    df = spark.createDataFrame([("1.0",), ("2",), (None,), ("1.5",), ("x",)], "c string")
    mapping = {1: "flat", 2: "stairs"}
    assert [r.v for r in df.select(labels.map_label(df.c, mapping).alias("v")).collect()] == ["flat", "stairs", None, None, None]
    known = spark.createDataFrame([("1.0",), ("2",), (None,)], "c string")
    known = known.select(labels.map_label(known.c, mapping, labels.ERROR).alias("v"))
    assert [r.v for r in known.collect()] == ["flat", "stairs", None]
    with pytest.raises(Exception, match="no label for code"):
        df.select(labels.map_label(df.c, mapping, labels.ERROR)).collect()


def test_first_policy_takes_the_earliest_sample(spark):
    from sensorweave.operators import align
    df = spark.createDataFrame([(1, 0, "a", 5.0, 2), (1, 0, "a", 9.0, 1), (1, 0, "b", 3.0, 9), (1, 1, "c", 1.0, 0)], "rec int, t int, s string, x double, n int")
    rows = align.widen(df, ["rec"], "t", "s", ["a", "b"], ["x"], dedupe="first", order="n").collect()
    assert [tuple(r) for r in rows] == [(1, 0, 9.0, 3.0)]

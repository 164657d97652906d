import random

import pandas as pd
from pyspark.sql import functions as F
import pytest

from sensorweave.operators import sequence as seq
from sensorweave.operators import timeline


def _data(seed=7, recs=4, n=120):
    rnd = random.Random(seed)
    out = []
    for r in range(recs):
        t = rnd.randint(-50, 50)
        for _ in range(n if r else n * 5):  # recording 0 dominates (skew)
            t += rnd.choice([1, 1, 1, 2, 3, 7])
            v = None if rnd.random() < 0.3 else rnd.randint(0, 9)
            out.append((r, t, v))
    return out


@pytest.mark.parametrize("width", [3.0, 50.0, None])
def test_index_shift_ffill_match_brute_force(spark, width):
    data = _data()
    df = spark.createDataFrame(data, "rec int, t long, v int")
    pdf = pd.DataFrame(data, columns=["rec", "t", "v"]).sort_values(["rec", "t"])
    pdf["idx"] = pdf.groupby("rec").cumcount()
    pdf["nxt"] = pdf.groupby("rec")["t"].shift(-1)
    pdf["prv"] = pdf.groupby("rec")["t"].shift(1)
    pdf["ff"] = pdf.groupby("rec")["v"].ffill()
    want = {(r.rec, r.t): r for r in pdf.itertuples()}

    got = seq.seq_index(df, ["rec"], ["t"], "idx", width=width)
    got = seq.seq_shift(got, ["rec"], ["t"], "t", "nxt", 1, width=width, first_out="first")
    got = seq.seq_shift(got, ["rec"], ["t"], "t", "prv", -1, width=width)
    got = seq.seq_ffill(got, ["rec"], ["t"], "v", "ff", width=width)
    first = pdf.groupby("rec")["t"].min().to_dict()
    for r in got.collect():
        w = want[(r.rec, r.t)]
        assert r.idx == w.idx
        assert (r.nxt is None and pd.isna(w.nxt)) or r.nxt == w.nxt
        assert (r.prv is None and pd.isna(w.prv)) or r.prv == w.prv
        assert (r.ff is None and pd.isna(w.ff)) or r.ff == w.ff
        assert r.first == first[r.rec]


def test_global_index_strings(spark):
    words = [f"w{i:03d}" for i in range(200)]
    random.Random(1).shuffle(words)
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r.w: r.i for r in seq.global_index(df, ["w"], "i", partitions=7).collect()}
    assert got == {w: i for i, w in enumerate(sorted(words))}


def test_fill_grid_is_a_left_join_of_the_full_grid(spark):
    data = [(1, 10, 1.0), (1, 11, 2.0), (1, 14, 3.0), (1, 14, 3.5), (2, 5, 9.0), (3, 100, None)]
    df = spark.createDataFrame(data, "rec int, t long, x double")
    out = timeline.fill_grid(df, ["rec"], "t", 1, segment_steps=2)
    got = sorted((r.rec, r.t, r.x) for r in out.collect())
    assert got == [(1, 10, 1.0), (1, 11, 2.0), (1, 12, None), (1, 13, None), (1, 14, 3.0),
                   (1, 14, 3.5), (2, 5, 9.0), (3, 100, None)]


def test_fill_grid_anchor_min_drops_off_grid(spark):
    # step 17 from the first sample; 40 is off-grid and dropped; last grid point <= max
    data = [("a", 0, 1.0), ("a", 17, 2.0), ("a", 40, 3.0), ("a", 68, 4.0), ("a", 90, 5.0)]
    df = spark.createDataFrame(data, "rec string, t long, x double")
    out = timeline.fill_grid(df, ["rec"], "t", 17, anchor="min", carry=[])
    got = sorted((r.t, r.x) for r in out.collect())
    assert got == [(0, 1.0), (17, 2.0), (34, None), (51, None), (68, 4.0), (85, None)]


def test_fill_grid_properties(spark):
    data = _data(seed=3, recs=5, n=60)
    df = spark.createDataFrame(data, "rec int, t long, v int").dropDuplicates(["rec", "t"])
    src = df.collect()
    out = timeline.fill_grid(df, ["rec"], "t", 1, carry=[], segment_steps=4, start_out="t0")
    got = out.collect()
    by = {}
    for r in src:
        by.setdefault(r.rec, []).append(r.t)
    assert len(got) == sum(max(v) - min(v) + 1 for v in by.values())
    assert {(r.rec, r.t, r.v) for r in src} <= {(r.rec, r.t, r.v) for r in got}
    assert all(r.t0 == min(by[r.rec]) for r in got)
    lin = {}
    for r in got:
        lin.setdefault(r.rec, []).append(r.t)
    assert all(sorted(v) == list(range(min(v), max(v) + 1)) for v in lin.values())


def test_fill_grid_fills_every_gap_and_gaps_are_reported(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (1, 10_000), (1, 10_002)], "rec int, t long")
    out = timeline.fill_grid(df, ["rec"], "t", 1)
    assert sorted(r.t for r in out.collect()) == list(range(10_003))
    gaps = timeline.grid_gaps(df, ["rec"], "t", 1).collect()
    assert sorted((g.gap_after, g.gap_before, g.missing) for g in gaps) == [(1, 10_000, 9_998), (10_000, 10_002, 1)]


def test_elapsed_since_start(spark):
    df = spark.createDataFrame([(1, 5_000), (1, 7_999), (2, 3)], "rec int, u long")
    out = timeline.elapsed_since_start(df, ["rec"], "u", "ms", unit=1000)
    assert sorted((r.rec, r.ms) for r in out.collect()) == [(1, 0), (1, 2), (2, 0)]


def test_round_to_grid_operator(spark):
    df = spark.createDataFrame([(15000,), (25000,)], "u long")
    assert [r.g for r in timeline.round_to_grid(df, "u", 10000, "g").collect()] == [20000, 20000]


def test_segments_bound_a_dominant_recording(spark):
    # recording 0 holds ~95% of the rows; no window partition may hold more
    # than a bounded number of them, whatever segmenting mode is used
    big = spark.range(0, 190_000).select(F.lit(0).alias("rec"), (F.col("id") * 3).alias("t"))
    small = spark.range(0, 10_000).select((F.col("id") % 50 + 1).alias("rec"), F.col("id").alias("t"))
    df = big.unionByName(small)
    for kwargs, bound in [({"width": 3.0 * 1000}, 1000), ({"target_rows": 2000}, 2 * 2000)]:
        seg = seq.with_segments(df, ["rec"], "t", **kwargs)
        sizes = seg.groupBy("rec", seq.SEG).count()
        assert sizes.agg(F.max("count")).first()[0] <= bound, kwargs
        assert seg.count() == df.count()


def test_a_null_recording_key_is_a_recording(spark):
    df = spark.createDataFrame([(k, t) for k in (None, 7) for t in (0, 200_000)], "rec int, t long")
    out = timeline.fill_grid(df, ["rec"], "t", 1, start_out="t0")
    got = {r.rec: (r.n, r.t0) for r in out.groupBy("rec").agg(F.count("*").alias("n"), F.min("t0").alias("t0")).collect()}
    assert got == {None: (200_001, 0), 7: (200_001, 0)}
    index = seq.seq_index(df, ["rec"], ["t"], "i", width=1000.0).collect()
    assert sorted((r.rec or 0, r.i) for r in index) == [(0, 0), (0, 1), (7, 0), (7, 1)]


def test_global_index_above_the_sampling_size(spark):
    # more keys than the range partitioner samples, an extra column used, and exchanges not shared
    df = spark.range(0, 400_000, 1, 8).select(F.xxhash64("id").alias("k"), F.col("id").alias("extra"))
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            out = seq.global_index(df, ["k"], "n", partitions=16)
            got = out.agg(F.count_distinct("n"), F.min("n"), F.max("n"), F.sum("extra")).first()
            assert tuple(got) == (400_000, 0, 399_999, 400_000 * 399_999 // 2)
            lead = out.selectExpr("k", "lead(k) over (partition by n div 50000 order by n) as next")
            assert lead.where("next <= k").count() == 0
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")

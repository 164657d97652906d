"""Registered queries over the benchmark tables, with equivalent DuckDB SQL.

The tables stand in for sensor data:

* ``events``: long readings. ``user_id`` = subject, ``event_type`` = sensor
  location, ``value`` = reading in g, ``ts`` = sample clock, ``event_id`` =
  source order.
* ``lineitem``: packets. ``l_orderkey`` = recording, ``l_linenumber`` =
  packet counter, ``l_returnflag`` = sensor code, ``l_quantity`` etc. = raw
  measurements.
* ``orders`` / ``customer`` / ``pages`` / ``part``: names and codes to parse
  and label; ``conversations``: gap-free sequences.

Every query reads whole tables. Float results that are averages are rounded
to 9 decimals in both engines so that summation order cannot flip a bit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave import catalog
from sensorweave.functions import labels, paths, timegrid, units
from sensorweave.operators import align, sequence as seq, stack, timeline
from sensorweave.plans import quality
from sensorweave.plans.harmonise import harmonise_long
from sensorweave.session import materialize
from sensorweave.sources import files

HOUR_US = 3_600_000_000
TEN_MS_US = 10_000
EVENT_SENSORS = ["click", "error", "purchase", "signup", "view"]
PACKET_SENSORS = ["A", "N", "R"]
AVG_DECIMALS = 9

# analog label map for event types (activity text -> surface, identity default)
EVENT_ACTIVITY = {"click": "stairs_up", "view": "flat"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _rounded(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), AVG_DECIMALS) for c in cols})


# ---------------------------------------------------------------- events: beach-like

def _events_long(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").cast("string").alias("sid"),
                     F.col("event_type").alias("sensor"), "ts",
                     F.col("value").alias("x"))


def beach_harmonise(spark, sf_dir):
    """Long readings -> rounded grid, mean per slot, one column per sensor,
    every grid point present, ms since the subject's first slot, m/s^2."""
    out = harmonise_long(_events_long(spark, sf_dir), sid="sid", sensor="sensor", ts="ts",
                         sensors=EVENT_SENSORS, values=["x"], step_us=HOUR_US,
                         metric="acc", surface="flat")
    return _rounded(out, [f"{s}_acc_x" for s in EVENT_SENSORS])


def round_to_grid(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    u = ev.select("event_id", "user_id", "event_type", timegrid.epoch_micros(ev, "ts").alias("u"))
    return timeline.round_to_grid(u, "u", TEN_MS_US, "slot_us").drop("u")


def _hour_slots(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    u = ev.select("user_id", "event_type", "value", timegrid.epoch_micros(ev, "ts").alias("u"))
    return timeline.round_to_grid(u, "u", HOUR_US, "slot_us").drop("u")


def dedupe_mean(spark, sf_dir):
    s = _hour_slots(spark, sf_dir)
    out = s.groupBy("user_id", "event_type", "slot_us").agg(
        F.avg(units.nan_to_null(F.col("value"))).alias("value_mean"),
        F.count(F.lit(1)).alias("n_samples"))
    return _rounded(out, ["value_mean"])


def widen_sensors(spark, sf_dir):
    s = _hour_slots(spark, sf_dir)
    out = align.widen(s, ["user_id"], "slot_us", "event_type", EVENT_SENSORS, ["value"],
                      name=lambda sn, v: f"{sn}_acc_x")
    return _rounded(out, [f"{sn}_acc_x" for sn in EVENT_SENSORS])


def sample_number(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("user_id", "event_id")
    out = timeline.sample_number(ev, ["user_id"], ["event_id"], "sample_no")
    return out.withColumn("time_ms", timegrid.ms_from_step(F.col("sample_no"), catalog.GRID_STEP_MS["mhealth"]))


def time_from_rate(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("user_id", "event_id")
    out = timeline.sample_number(ev, ["user_id"], ["event_id"], "sample_no")
    return out.withColumn("time_ms", timegrid.ms_from_rate(F.col("sample_no"), catalog.SAMPLING_RATE_HZ["bruno"]))


def seconds_to_ms(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", timegrid.seconds_to_ms(F.col("value")).alias("time_ms"))


def datetime_to_ms(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    u = ev.select("user_id", "event_id", timegrid.epoch_micros(ev, "ts").alias("u"))
    return timeline.elapsed_since_start(u, ["user_id"], "u", "time_ms", unit=1000).drop("u")


def coerce_numeric(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    inner = F.regexp_extract(F.col("props"), r":\s*([^}]*)", 1)
    return ev.select("event_id",
                     units.coerce_numeric(inner).alias("props_value"),
                     units.coerce_numeric(F.col("props")).alias("props_whole"),
                     units.coerce_numeric(F.col("event_type")).alias("type_value"))


def label_identity(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", labels.map_label(F.col("event_type"), EVENT_ACTIVITY,
                                                  labels.IDENTITY).alias("surface"))


def label_null(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    code = F.floor(F.col("value")).cast("int")
    return ev.select("event_id", code.alias("code"),
                     labels.map_label(code, catalog.KARAS_SURFACES, labels.NULL).alias("surface"))


def label_ffill(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    code = F.floor(F.col("value")).cast("int")
    d = ev.select("user_id", "event_id", code.alias("code"),
                  labels.map_label(code, catalog.MHEALTH_SURFACES, labels.NULL).alias("surface"))
    return timeline.forward_fill(d, ["user_id"], ["event_id"], "surface")


def surrogate_subject_id(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    first = ev.groupBy("user_id").agg(F.min("event_id").alias("first_event_id"))
    ranked = seq.global_index(first, ["first_event_id", "user_id"], "sid")
    return ranked.withColumn("sid", (F.col("sid") + 1).cast("int"))


# ---------------------------------------------------------------- lineitem: luo-like packets

def _packets(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", F.col("l_linenumber").cast("long").alias("packetcounter"),
                     "l_returnflag", "l_quantity", "l_discount")


def widen_packets(spark, sf_dir):
    p = _packets(spark, sf_dir).withColumnsRenamed({"l_quantity": "acc_x", "l_discount": "gyr_x"})
    out = align.widen(p, ["l_orderkey"], "packetcounter", "l_returnflag", PACKET_SENSORS,
                      ["acc_x", "gyr_x"])
    return _rounded(out, [c for c in out.columns if c not in ("l_orderkey", "packetcounter")])


def packet_rejects(spark, sf_dir):
    p = _packets(spark, sf_dir)
    return align.duplicate_keys(p, ["l_orderkey"], "packetcounter", "l_returnflag")


def fill_packet_grid(spark, sf_dir):
    return timeline.fill_grid(_packets(spark, sf_dir), ["l_orderkey"], "packetcounter", 1)


def fill_grid_step(spark, sf_dir):
    return timeline.fill_grid(_packets(spark, sf_dir), ["l_orderkey"], "packetcounter", 2,
                              anchor="min")


def grid_gaps(spark, sf_dir):
    p = _packets(spark, sf_dir).select("l_orderkey", "packetcounter").distinct()
    return timeline.grid_gaps(p, ["l_orderkey"], "packetcounter", 1)


def packet_time_ms(spark, sf_dir):
    p = _packets(spark, sf_dir).select("l_orderkey", "packetcounter", "l_returnflag")
    return timeline.elapsed_since_start(p, ["l_orderkey"], "packetcounter", "time_ms",
                                        scale=catalog.GRID_STEP_MS["luo"])


def recording_bounds(spark, sf_dir):
    p = _packets(spark, sf_dir)
    b = p.groupBy("l_orderkey").agg(
        F.min("packetcounter").alias("first_packet"), F.max("packetcounter").alias("last_packet"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("packetcounter").alias("n_packets"))
    expected = F.col("last_packet") - F.col("first_packet") + F.lit(1)
    return (b.withColumn("expected_packets", expected)
            .withColumn("missing_packets", expected - F.col("n_packets")))


def unit_6bit(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_returnflag",
                     units.six_bit_to_ms2(F.col("l_quantity")).alias("acc_x"))


def unit_g(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_returnflag",
                     units.g_to_ms2(F.col("l_discount")).alias("acc_x"))


def unit_int16(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_returnflag",
                     units.int16_acc_to_ms2(F.col("l_partkey")).alias("acc_x"),
                     units.int16_gyr_to_rads(F.col("l_suppkey")).alias("gyr_x"))


def unit_deg(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_returnflag",
                     units.deg_to_rad(F.col("l_quantity")).alias("gyr_x"))


def label_list(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    trial_map = labels.expand_lists(catalog.LUO_TRIAL_SURFACES)
    return li.select("l_orderkey", "l_linenumber", "l_suppkey",
                     labels.map_label(F.col("l_suppkey"), trial_map, "unknown").alias("surface"))


def linearity_packets(spark, sf_dir):
    p = _packets(spark, sf_dir).withColumn("dataset", F.lit("luo"))
    p = catalog.with_dataset_config(p)
    p = p.withColumn("time_ms", F.col("packetcounter") * F.lit(catalog.GRID_STEP_MS["luo"]))
    return quality.linearity(p, ["l_orderkey"], "time_ms", F.col("fs"), tolerance=1.0,
                             width=float(catalog.GRID_STEP_MS["luo"] * seq.GRID_SEGMENT_STEPS))


def linearity_conversations(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select(
        "conv_id", (F.col("turn") * F.lit(catalog.GRID_STEP_MS["luo"])).alias("time_ms"))
    return quality.linearity(c, ["conv_id"], "time_ms", catalog.SAMPLING_RATE_HZ["luo"])


# ---------------------------------------------------------------- names and codes

def label_other(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", "p_size",
                       labels.map_label(F.col("p_size"), catalog.HUGADB_SURFACES, "other").alias("surface"))


def parse_trial_prefix(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    trial = paths.trial_prefix(F.col("o_orderpriority")).try_cast("int")
    trial_map = labels.expand_lists(catalog.LUO_TRIAL_SURFACES)
    return o.select("o_orderkey", trial.alias("trial_no"),
                    labels.map_label(trial, trial_map, "unknown").alias("surface"))


def parse_suffix_code(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    code = paths.suffix_code(F.col("c_name"))
    return c.select("c_custkey", code.alias("code"),
                    labels.map_label(code, catalog.LUO_SENSOR_CODES, labels.NULL).alias("location"))


def parse_parent_and_stem(spark, sf_dir):
    pg = table(spark, sf_dir, "pages")
    stem = paths.file_stem(F.col("url"))
    sid, trial = paths.underscored_ids(stem)
    return pg.select("page_id", paths.parent_dir(F.col("url")).alias("parent"),
                     paths.file_name(F.col("url")).alias("name"), stem.alias("stem"),
                     sid.alias("sid"), trial.alias("trial_no"))


def _strip_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[c[len(prefix):] if c.startswith(prefix) else c for c in df.columns])


def stack_by_name(spark, sf_dir):
    cu = _strip_prefix(table(spark, sf_dir, "customer"), "c_").withColumnRenamed("custkey", "key")
    su = _strip_prefix(table(spark, sf_dir, "supplier"), "s_").withColumnRenamed("suppkey", "key")
    return stack.stack_by_name([cu.withColumn("source", F.lit("customer")),
                                su.withColumn("source", F.lit("supplier"))])


def schema_align(spark, sf_dir):
    cu = _strip_prefix(table(spark, sf_dir, "customer"), "c_").withColumnRenamed("custkey", "key")
    su = _strip_prefix(table(spark, sf_dir, "supplier"), "s_").withColumnRenamed("suppkey", "key")
    return stack.align_to_schema(su, cu.schema)


def missing_subjects(spark, sf_dir):
    """Expected subjects (customers) without any order."""
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    found = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return files.missing_inputs(cu, found, "c_custkey")


def missing_recordings(spark, sf_dir):
    """Expected recordings (orders) for which no packet was found."""
    expected = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    found = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return files.missing_inputs(expected, found, "o_orderkey")


# ---------------------------------------------------------------- quality on harmonised events

def _harmonised_events(spark, sf_dir):
    return harmonise_long(_events_long(spark, sf_dir), sid="sid", sensor="sensor", ts="ts",
                          sensors=EVENT_SENSORS, values=["x"], step_us=HOUR_US,
                          metric="acc", surface="flat")


def _stored_harmonised_events(spark, sf_dir):
    """The harmonised table as the checks see it in practice: written once,
    then read (the checks have several branches over it)."""
    return materialize(_harmonised_events(spark, sf_dir), "harmonised-events")


def null_profile(spark, sf_dir):
    return quality.null_profile(_harmonised_events(spark, sf_dir))


def null_context(spark, sf_dir):
    h = _stored_harmonised_events(spark, sf_dir).select(
        "sid", "time_ms", *[f"{s}_acc_x" for s in EVENT_SENSORS])
    ex = quality.null_examples(h, ["sid"], "time_ms", max_examples=3, context=2,
                               grid_step=HOUR_US // 1000)
    return ex.select("sid", "example_no", "ctx_offset", "time_ms", "null_columns", "more_flagged")


def linearity_harmonised(spark, sf_dir):
    h = _stored_harmonised_events(spark, sf_dir)
    return quality.linearity(h, ["sid"], "time_ms", 1000.0 / (HOUR_US // 1000))


def quality_report(spark, sf_dir):
    """Q6: every check over the harmonised table in one long report."""
    h = _stored_harmonised_events(spark, sf_dir)
    return quality.quality_report(h, "beach", ["sid"], fs=1000.0 / (HOUR_US // 1000), grid_step=HOUR_US // 1000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "beach_harmonise": beach_harmonise,
    "round_to_grid": round_to_grid,
    "dedupe_mean": dedupe_mean,
    "widen_sensors": widen_sensors,
    "widen_packets": widen_packets,
    "packet_rejects": packet_rejects,
    "fill_packet_grid": fill_packet_grid,
    "fill_grid_step": fill_grid_step,
    "grid_gaps": grid_gaps,
    "packet_time_ms": packet_time_ms,
    "recording_bounds": recording_bounds,
    "sample_number": sample_number,
    "time_from_rate": time_from_rate,
    "seconds_to_ms": seconds_to_ms,
    "datetime_to_ms": datetime_to_ms,
    "unit_6bit": unit_6bit,
    "unit_g": unit_g,
    "unit_int16": unit_int16,
    "unit_deg": unit_deg,
    "coerce_numeric": coerce_numeric,
    "label_identity": label_identity,
    "label_null": label_null,
    "label_other": label_other,
    "label_list": label_list,
    "label_ffill": label_ffill,
    "parse_trial_prefix": parse_trial_prefix,
    "parse_suffix_code": parse_suffix_code,
    "parse_parent_and_stem": parse_parent_and_stem,
    "surrogate_subject_id": surrogate_subject_id,
    "stack_by_name": stack_by_name,
    "schema_align": schema_align,
    "missing_subjects": missing_subjects,
    "missing_recordings": missing_recordings,
    "linearity_packets": linearity_packets,
    "linearity_conversations": linearity_conversations,
    "linearity_harmonised": linearity_harmonised,
    "null_profile": null_profile,
    "null_context": null_context,
    "quality_report": quality_report,
}

"""Registered queries over files with the studies' own names and folders.

``orders`` is written as text in a layout's lines, with lines and files that
break the layout mixed in, and the files get the published names; then the
dataset's flow runs by name, as a user starts it. The results are summaries in
long form ``(check, key, n)``: rows kept per recording, and everything that was
set aside, by reason. Sinks, manifests and totals have queries of their own.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave import catalog
from sensorweave.functions import paths
from sensorweave.plans import quality, recordings
from sensorweave.plans.queries import _harmonised_events, table
from sensorweave.session import scratch_path, shuffle_partitions
from sensorweave.sources import sinks


SINK_FOLDERS = 16


def _publish(lines: DataFrame, head: str | None, tag: str) -> str:
    """Write ``(name, at, value)`` as one text file per ``name`` (a path below
    the returned root), lines in the order of ``at`` after ``head``. The part
    files that Spark writes are renamed, one call per file."""
    spark = lines.sparkSession
    root, staging = scratch_path(spark, tag), scratch_path(spark, f"{tag}-parts")
    lines = lines.select(F.replace("name", F.lit("/"), F.lit("~")).alias("name"), "at", "value")
    if head is not None:
        heads = lines.select("name").distinct().select("name", F.lit(-1).cast("long").alias("at"), F.lit(head).alias("value"))
        lines = lines.unionByName(heads)
    (lines.repartition(shuffle_partitions(spark), "name").sortWithinPartitions("name", "at")
     .select("value", "name").write.partitionBy("name").text(staging))
    jvm = spark.sparkContext._jvm
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in fs.listStatus(at(staging)):
        if not folder.isDirectory():
            continue
        name = folder.getPath().getName().removeprefix("name=").replace("~", "/")
        for part in fs.listStatus(folder.getPath()):
            if part.getPath().getName().startswith("part-"):
                target = at(f"{root}/{name}")
                fs.mkdirs(target.getParent())
                fs.rename(part.getPath(), target)
    fs.delete(at(staging), True)
    return root


def _counted(df: DataFrame, check: str, key: Column) -> DataFrame:
    return df.groupBy(key.alias("key")).agg(F.count("*").alias("n")).select(F.lit(check).alias("check"), "key", "n")


def _summary(h: recordings.Harmonised, keys: list[str], root: str) -> DataFrame:
    """Rows per recording, and rejects by reason and file."""
    rows = _counted(h.data, "rows", F.concat_ws("/", *[F.col(k).cast("string") for k in keys]))
    below = F.substring_index("path", re.sub(r"^[a-z]+:/*", "", root).split("/")[-1] + "/", -1)
    out = rows.unionByName(_counted(h.rejects, "reject", F.concat_ws(": ", "reason", below)))
    return out.unionByName(_counted(h.missing, "missing", F.col("sid").cast("string"))) if h.missing is not None else out


def luo_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 by name (S16) on ``<sid>/<trial>-...<code>.csv``, subjects 0..32 of
    which 1..30 belong to the layout; an unknown code, file names without a
    trial, lines with a surplus field and unreadable counters (S8, S10)."""
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    code = F.when(key % 3 == 0, "CC").when(key % 3 == 1, "9B").otherwise("ZZ")
    trial = F.when(key % 5 == 4, F.lit("notes")).otherwise((key % 5 + 1).cast("string"))
    counter = F.when(key % 64 == 1, F.lit("x")).otherwise((key / 33).cast("long").cast("string"))
    value = F.concat_ws(",", counter, (key % 100).cast("string"), F.col("o_custkey").cast("string"),
                        F.when(key % 50 == 2, F.lit("surplus")))
    lines = o.select(F.concat((key % 33).cast("string"), F.lit("/"), trial, F.lit("-000_00B432"), code, F.lit(".csv")).alias("name"),
                     key.alias("at"), value.alias("value"))
    root = _publish(lines, "PacketCounter, SampleTimeFine, Acc_X", "luo-published")
    return _summary(recordings.harmonise("luo", spark, root), ["sid", "trial_no"], root)


_LUO = """
WITH l AS (
  SELECT o_orderkey % 33 AS sid, CASE WHEN o_orderkey % 5 = 4 THEN 'notes' ELSE CAST(o_orderkey % 5 + 1 AS VARCHAR) END AS trial,
         CASE o_orderkey % 3 WHEN 0 THEN 'CC' WHEN 1 THEN '9B' ELSE 'ZZ' END AS code,
         o_orderkey // 33 AS packet, o_orderkey % 64 = 1 AS unread, o_orderkey % 50 = 2 AS surplus
  FROM orders),
f AS (SELECT *, CAST(sid AS VARCHAR) || '/' || trial || '-000_00B432' || code || '.csv' AS name,
         CASE WHEN sid NOT BETWEEN 1 AND 30 THEN 'subject outside the layout''s range'
              WHEN trial = 'notes' THEN 'no trial number'
              WHEN code = 'ZZ' THEN 'unknown sensor code' END AS reason FROM l),
g AS (SELECT * FROM f WHERE reason IS NULL),
ok AS (SELECT * FROM g WHERE NOT surplus AND NOT unread),
rep AS (SELECT DISTINCT sid, trial FROM ok GROUP BY sid, trial, code, packet HAVING count(*) > 1)
SELECT 'rows' AS "check", CAST(sid AS VARCHAR) || '/' || trial AS key, max(packet) - min(packet) + 1 AS n
FROM ok WHERE NOT EXISTS (SELECT 1 FROM rep WHERE rep.sid = ok.sid AND rep.trial = ok.trial) GROUP BY sid, trial
UNION ALL SELECT 'reject', reason || ': ' || name, 1 FROM (SELECT DISTINCT reason, name FROM f WHERE reason IS NOT NULL)
UNION ALL SELECT 'reject', 'more fields than header: ' || name, count(*) FROM g WHERE surplus GROUP BY name
UNION ALL SELECT 'reject', 'unreadable packet counter: ' || name, count(*) FROM g WHERE unread AND NOT surplus GROUP BY name
UNION ALL SELECT 'reject', 'sensor repeats a packet in its trial: ' || name, 1 FROM (
  SELECT DISTINCT name FROM g JOIN rep ON rep.sid = g.sid AND rep.trial = g.trial)"""


def mhealth_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 by name on ``mHealth_subject<N>.log`` for N in 0, 2..12 and X: two
    are outside the layout, one has no number, subject 1 is missing (S7c, S9)."""
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    n = key % 13
    who = F.when(n == 1, F.lit("X")).otherwise(n.cast("string"))
    fields = [F.col("o_custkey").cast("string")] * 23 + [(key % 15).cast("string"), F.when(key % 40 == 3, F.lit("surplus"))]
    lines = o.select(F.concat(F.lit("mHealth_subject"), who, F.lit(".log")).alias("name"), key.alias("at"), F.concat_ws("\t", *fields).alias("value"))
    root = _publish(lines, None, "mhealth-published")
    return _summary(recordings.harmonise("mhealth", spark, root), ["sid"], root)


_MHEALTH = """
WITH l AS (SELECT o_orderkey % 13 AS sid, o_orderkey % 40 = 3 AS surplus FROM orders),
f AS (SELECT *, 'mHealth_subject' || CASE WHEN sid = 1 THEN 'X' ELSE CAST(sid AS VARCHAR) END || '.log' AS name FROM l)
SELECT 'rows' AS "check", CAST(sid AS VARCHAR) AS key, count(*) AS n FROM f WHERE sid BETWEEN 2 AND 10 AND NOT surplus GROUP BY sid
UNION ALL SELECT 'reject', 'more than 24 fields: ' || name, count(*) FROM f WHERE sid BETWEEN 2 AND 10 AND surplus GROUP BY name
UNION ALL SELECT DISTINCT 'reject', CASE WHEN sid = 1 THEN 'no subject in the file name: ' ELSE 'subject outside the layout''s range: ' END || name, 1
  FROM f WHERE sid NOT BETWEEN 2 AND 10
UNION ALL SELECT 'missing', CAST(s AS VARCHAR), 1 FROM range(1, 11) t(s) WHERE s NOT IN (SELECT sid FROM f WHERE sid <> 1)"""


def hugadb_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5 by name on ``HGD_v1_<activity>_<sid>_<trial>.txt`` (P1b), with names
    that don't parse and lines with a surplus field; the last time shows that
    rejected lines take no place."""
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    trial = key % 4
    name = F.concat(F.lit("HGD_v1_walking_"), F.lpad((key % 18 + 1).cast("string"), 2, "0"), F.lit("_"),
                    F.when(trial == 3, F.lit("xx")).otherwise(F.lpad(trial.cast("string"), 2, "0")), F.lit(".txt"))
    fields = [F.col("o_custkey").cast("string")] * 38 + [(key % 15).cast("string"), F.when(key % 30 == 5, F.lit("surplus"))]
    lines = o.select(name.alias("name"), key.alias("at"), F.concat_ws(" ", *fields).alias("value"))
    root = _publish(lines, "# export\nnames of fields", "hugadb-published")
    h = recordings.harmonise("hugadb", spark, root)
    last = h.data.groupBy("sid", "trial_no").agg(F.max("time_ms").alias("n"))
    last = last.select(F.lit("last time").alias("check"), F.concat_ws("/", F.col("sid").cast("string"), F.col("trial_no").cast("string")).alias("key"), "n")
    return _summary(h, ["sid", "trial_no"], root).unionByName(last)


_HUGADB = f"""
WITH f AS (
  SELECT o_orderkey % 18 + 1 AS sid, o_orderkey % 4 AS trial, o_orderkey % 30 = 5 AS surplus,
         'HGD_v1_walking_' || lpad(CAST(o_orderkey % 18 + 1 AS VARCHAR), 2, '0') || '_' ||
         CASE WHEN o_orderkey % 4 = 3 THEN 'xx' ELSE lpad(CAST(o_orderkey % 4 AS VARCHAR), 2, '0') END || '.txt' AS name FROM orders),
r AS (SELECT CAST(sid AS VARCHAR) || '/' || CAST(trial AS VARCHAR) AS key, count(*) AS n FROM f WHERE trial <> 3 AND NOT surplus GROUP BY sid, trial)
SELECT 'rows' AS "check", key, n FROM r
UNION ALL SELECT 'last time', key, (n - 1) * {catalog.GRID_STEP_MS['hugadb']} FROM r
UNION ALL SELECT 'reject', 'more than 39 fields: ' || name, count(*) FROM f WHERE trial <> 3 AND surplus GROUP BY name
UNION ALL SELECT DISTINCT 'reject', 'no subject and trial number in the file name: ' || name, 1 FROM f WHERE trial = 3"""


def bruno_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 by name on ``<Activity>/Accelerometer-Y-M-D-h-m-s-<activity>-<volunteer>.txt``
    (P1a), with ``_MODEL`` folders, which are skipped, and short names."""
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    kind = key % 4
    act = F.when(kind == 0, "walk").when(kind == 1, "climb_stairs").otherwise("comb_hair")
    tail = F.concat(F.lit("Accelerometer-2011-03-24-10-24-"), F.lpad((key % 50).cast("string"), 2, "0"))
    name = F.concat(F.when(kind == 3, F.lit("Comb_MODEL/")).otherwise(F.lit("Rest/")), tail,
                    F.when(key % 50 == 7, F.lit("")).otherwise(F.concat(F.lit("-"), act, F.lit("-f"), (key % 5).cast("string"))), F.lit(".txt"))
    value = F.concat_ws(" ", (key % 64).cast("string"), (key % 63).cast("string"), F.lit("5"), F.when(key % 30 == 5, F.lit("surplus")))
    lines = o.select(name.alias("name"), key.alias("at"), value.alias("value"))
    root = _publish(lines, None, "bruno-published")
    return _summary(recordings.harmonise("bruno", spark, root), ["sid", "trial_no", "surface"], root)


def _bruno_oracle() -> str:
    surface = "CASE act " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in catalog.BRUNO_SURFACES.items()) + " ELSE act END"
    return f"""
WITH l AS (
  SELECT *, CASE o_orderkey % 4 WHEN 0 THEN 'walk' WHEN 1 THEN 'climb_stairs' ELSE 'comb_hair' END AS act,
         'f' || CAST(o_orderkey % 5 AS VARCHAR) AS vol, o_orderkey % 30 = 5 AS surplus,
         'Rest/Accelerometer-2011-03-24-10-24-' || lpad(CAST(o_orderkey % 50 AS VARCHAR), 2, '0') AS stem
  FROM orders WHERE o_orderkey % 4 <> 3),
f AS (SELECT *, stem || CASE WHEN o_orderkey % 50 = 7 THEN '' ELSE '-' || act || '-' || vol END || '.txt' AS name, o_orderkey % 50 = 7 AS short FROM l),
d AS (SELECT DISTINCT name, vol, act FROM f WHERE NOT short),
t AS (SELECT name, vol, act, row_number() OVER (ORDER BY name) AS trial FROM d),
v AS (SELECT vol, row_number() OVER (ORDER BY min(name)) AS sid FROM d GROUP BY vol)
SELECT 'rows' AS "check", CAST(sid AS VARCHAR) || '/' || CAST(trial AS VARCHAR) || '/' || {surface.replace('act', 't.act')} AS key, count(*) AS n
FROM f JOIN t ON f.name = t.name JOIN v ON f.vol = v.vol WHERE NOT short AND NOT surplus GROUP BY sid, trial, t.act
UNION ALL SELECT 'reject', 'more than 3 fields: ' || name, count(*) FROM f WHERE NOT short AND surplus GROUP BY name
UNION ALL SELECT DISTINCT 'reject', 'file name has fewer than 9 parts: ' || name, 1 FROM f WHERE short"""


def _files_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as parsed lines with the file that each came from."""
    li = table(spark, sf_dir, "lineitem")
    sid, trial = (F.col("l_suppkey") / 10).cast("long"), F.col("l_linenumber")
    return li.select(sid.alias("sid"), trial.alias("trial_no"),
                     F.concat_ws("/", sid.cast("string"), F.concat(trial.cast("string"), F.lit("-"), F.col("l_returnflag"))).alias("path"))


def trial_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files per (subject, trial), comma-joined."""
    m = recordings.trial_manifest(_files_of_lines(spark, sf_dir))
    return m.select("sid", "trial_no", F.array_join("files", ",").alias("files"), "n_files")


def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects, trials, rows and files of a run."""
    lines = _files_of_lines(spark, sf_dir)
    return recordings.run_totals(lines, lines)


def linearity_source_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 in source order (O2): the steps of a subject's events as they came."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_id", (F.unix_millis(F.col("ts").cast("timestamp"))).alias("time_ms"))
    return quality.linearity(ev, ["user_id"], "time_ms", 1.0, sort_first=False, order="event_id")


def parse_underscored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1b on stems that hold a subject and a trial, and on some that don't."""
    cu = table(spark, sf_dir, "customer")
    stem = F.concat(F.lit("HGD_v2_walking_"), (F.col("c_custkey") % 18).cast("string"), F.lit("_"),
                    F.when(F.col("c_custkey") % 7 == 0, F.lit("x")).otherwise(F.col("c_nationkey").cast("string")))
    sid, trial = paths.underscored_ids(paths.file_stem(F.concat(stem, F.lit(".txt"))))
    return cu.select("c_custkey", sid.alias("sid"), trial.alias("trial_no"))


def sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The harmonised events through the sorted sink, in a fixed number
    of folders however many subjects there are, and back."""
    out = scratch_path(spark, "sink-parquet")
    sinks.write_parquet(_harmonised_events(spark, sf_dir), out, buckets=SINK_FOLDERS)
    return sinks.read_output(spark, out)


def sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the CSV sink and back."""
    out, events = scratch_path(spark, "sink-csv"), _harmonised_events(spark, sf_dir)
    sinks.write_csv(events, out)
    return spark.read.schema(events.schema).option("header", True).csv(out)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "luo_published": luo_published, "mhealth_published": mhealth_published, "hugadb_published": hugadb_published,
    "bruno_published": bruno_published, "trial_manifest": trial_manifest, "run_totals": run_totals,
    "linearity_source_order": linearity_source_order, "parse_underscored": parse_underscored,
    "sink_parquet": sink_parquet, "sink_csv": sink_csv,
}

_LINES = "(SELECT l_suppkey // 10 AS sid, l_linenumber AS trial_no, CAST(l_suppkey // 10 AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR) || '-' || l_returnflag AS path FROM lineitem)"


def oracle(sql: dict[str, str]) -> dict[str, str]:
    """DuckDB SQL of these queries; ``sql`` has that of the others."""
    return {
        "luo_published": _LUO, "mhealth_published": _MHEALTH, "hugadb_published": _HUGADB, "bruno_published": _bruno_oracle(),
        "trial_manifest": f"SELECT sid, trial_no, string_agg(DISTINCT path, ',' ORDER BY path) AS files, count(DISTINCT path) AS n_files FROM {_LINES} GROUP BY sid, trial_no",
        "run_totals": f"""SELECT count(DISTINCT sid) AS subjects, (SELECT count(*) FROM (SELECT DISTINCT sid, trial_no FROM {_LINES})) AS trials,
  count(*) AS "rows", count(DISTINCT path) AS files FROM {_LINES}""",
        "linearity_source_order": """
WITH p AS (SELECT user_id, epoch_ms(ts) - lag(epoch_ms(ts)) OVER (PARTITION BY user_id ORDER BY event_id, epoch_ms(ts)) AS step FROM events WHERE ts IS NOT NULL),
a AS (SELECT user_id, count(*) AS n_points, COALESCE(min(step) < 0, FALSE) AS has_negative,
             COALESCE(max(abs(step - 1000.0)) > 1.0, FALSE) AS out_of_tolerance FROM p GROUP BY user_id)
SELECT *, NOT has_negative AND NOT out_of_tolerance AS linear FROM a""",
        "parse_underscored": "SELECT c_custkey, CAST(c_custkey % 18 AS INTEGER) AS sid, CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_nationkey AS INTEGER) END AS trial_no FROM customer",
        "sink_parquet": sql["beach_harmonise"], "sink_csv": sql["beach_harmonise"],
    }

"""Registered queries over messy intake: broken files, records over several
lines, sensor folders, repeated batches, changed files, and the checks of several
datasets at once.

``conversations`` is written as text or as an output in parts; the readers and
sinks then have to give back exactly what the SQL computes from the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.plans import quality, recordings
from sensorweave.plans.oracle import _beach
from sensorweave.plans.queries import AVG_DECIMALS, EVENT_SENSORS, HOUR_US, _harmonised_events, table
from sensorweave.session import scratch_path, shuffle_partitions
from sensorweave.sources import files, sinks, text

#: Conversations that share a file or a subject.
GROUP = 16


def _group(column: str = "conv_id") -> Column:
    return F.floor(F.col(column) / F.lit(GROUP)).cast("long")


def broken_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One headed file for every few conversations; every eighth holds bytes
    that are not UTF-8, every eighth only its header, one is a packed file that
    was cut off, one is no packed file at all, and one is empty. Rows kept per
    file, and a reject for each broken one."""
    conv = table(spark, sf_dir, "conversations").select(_group().alias("g"), "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"))
    bad = F.when(F.col("g") % 8 == 3, F.expr("CAST(X'C328FF' AS STRING)")).otherwise(F.lit(""))
    data = conv.where(F.col("g") % 8 != 5).select("g", F.lit(1).alias("at"), F.concat(F.concat_ws(",", F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role"), bad).alias("value"))
    heads = conv.select("g").distinct().select("g", F.lit(0).alias("at"), F.lit("conv_id,turn,role").alias("value"))
    lines = data.unionByName(heads).repartition(shuffle_partitions(spark), "g").sortWithinPartitions("g", "at")
    root, packed = scratch_path(spark, "raw-broken"), scratch_path(spark, "raw-packed")
    lines.where(F.col("g") > 1).select("value", "g").write.partitionBy("g").text(root)
    # the first group packed by the writer, the second one only named so
    for g, codec in ((0, "gzip"), (1, "none")):
        lines.where(F.col("g") == g).select("value").coalesce(1).write.option("compression", codec).text(f"{packed}/{g}")
    jvm = spark.sparkContext._jvm
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for g in (0, 1):
        fs.mkdirs(at(f"{root}/g={g}"))
        for part in fs.listStatus(at(f"{packed}/{g}")):
            if part.getPath().getName().startswith("part-"):
                source, target = fs.open(part.getPath()), fs.create(at(f"{root}/g={g}/part.csv.gz"))
                jvm.org.apache.commons.io.IOUtils.copyLarge(source, target, 0, part.getLen() // 2 if g == 0 else part.getLen())
                source.close()
                target.close()
    fs.mkdirs(at(f"{root}/g=-1"))
    fs.create(at(f"{root}/g=-1/part.txt")).close()
    scan = text.read_headed(spark, root, columns=["conv_id", "turn", "role"])
    folder = F.regexp_extract("path", "/g=(-?[0-9]+)/", 1).cast("long").alias("g")
    kept = scan.rows.groupBy(folder).agg(F.count("*").alias("n"), F.sum(F.col("conv_id").cast("long")).alias("ids"), F.max("line_no").alias("last_line"))
    return kept.withColumn("reason", F.lit(None).cast("string")).unionByName(
        scan.rejects.select(folder, F.lit(1).cast("long").alias("n"), F.lit(None).cast("long").alias("ids"), "line_no", "reason").withColumnRenamed("line_no", "last_line"))


_BROKEN = f"""
WITH c AS (SELECT conv_id // {GROUP} AS g, conv_id FROM conversations),
d AS (SELECT g, count(*) AS n, sum(conv_id) AS ids FROM c GROUP BY g)
SELECT g, n, CAST(ids AS BIGINT) AS ids, n - 1 AS last_line, CAST(NULL AS VARCHAR) AS reason FROM d WHERE g > 1 AND g % 8 NOT IN (3, 5)
UNION ALL SELECT g, 1, NULL, NULL, CASE WHEN g <= 1 THEN '{text.UNREADABLE}' WHEN g % 8 = 3 THEN '{text.NOT_UTF8}' ELSE '{text.NO_DATA}' END
  FROM d WHERE g <= 1 OR g % 8 IN (3, 5)
UNION ALL SELECT -1, 1, NULL, NULL, '{text.EMPTY}'"""


def quoted_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as headed CSV whose quoted texts hold line ends,
    quotes and commas, in files of two column orders, read back exactly."""
    conv = table(spark, sf_dir, "conversations")
    said = F.replace(F.concat(F.lit(' so, "'), F.col("text")), F.lit(" la "), F.lit('",\n\n"la" '))
    conv = conv.select("conv_id", "turn", "role", said.alias("text"))
    root = scratch_path(spark, "raw-quoted")
    for name, part, columns in (("a", F.col("conv_id") % 2 == 0, conv.columns), ("b", F.col("conv_id") % 2 != 0, conv.columns[::-1])):
        (conv.where(part).select(*columns).repartition(shuffle_partitions(spark), "conv_id", "turn").write.option("header", True).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("emptyValue", "").csv(f"{root}/{name}"))
    rows = text.read_headed(spark, root, columns=conv.columns, glob="*.csv", skip_initial_space=False).rows
    return rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", F.char_length("text").cast("long").alias("n_chars"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


_QUOTED = """
WITH c AS (SELECT conv_id, turn, role, replace(' so, "' || text, ' la ', '",' || chr(10) || chr(10) || '"la" ') AS text FROM conversations)
SELECT conv_id, turn, role, CAST(length(text) AS BIGINT) AS n_chars, sha256(text) AS text_sha256 FROM c"""


def _append_twice(fmt: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = table(spark, sf_dir, "conversations").select(_group().alias("sid"), (F.col("turn") * 20).alias("time_ms"), "conv_id",
                                                            F.char_length("text").cast("double").alias("chest_acc_x"), "role")
        out = scratch_path(spark, f"append-{fmt}")
        older = rows.where(F.col("sid") % 2 == 0).drop("role").withColumn("old", F.lit(None).cast("string"))
        if fmt == "parquet":
            sinks.write_parquet(older, out)
        else:
            sinks.write_csv(older, out, partition_by=["sid"])
        batch = rows.where(F.col("sid") % 2 == 1)
        for again in (batch, batch, batch.where(F.col("sid") % 4 == 1).withColumn("chest_acc_x", -F.col("chest_acc_x"))):
            sinks.replace_subjects(again, out, fmt)
        return sinks.read_output(spark, out) if fmt == "parquet" else sinks.read_csv_output(spark, out, older.schema)

    query.__doc__ = f"S12, E7: a batch appended twice and then changed for some subjects, in a {fmt} output; its rows are there once."
    return query


_APPEND = f"""
SELECT conv_id // {GROUP} AS sid, turn * 20 AS time_ms, conv_id,
       CASE WHEN (conv_id // {GROUP}) % 4 = 1 THEN -1 ELSE 1 END * CAST(length(text) AS DOUBLE) AS chest_acc_x, CAST(NULL AS VARCHAR) AS old FROM conversations"""

#: The datasets of the joint report: recording keys and sampling rates.
REPORT_KEYS = {"beach": ["sid"], "hugadb": ["sid", "trial_no"], "mhealth": ["sid"]}
REPORT_RATES = {"beach": 1000.0 / (HOUR_US // 1000)}


def quality_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: all checks of three stored outputs, found by name below one folder."""
    root = scratch_path(spark, "outputs")
    sinks.write_parquet(_harmonised_events(spark, sf_dir), f"{root}/beach", buckets=4)
    conv, orders = table(spark, sf_dir, "conversations"), table(spark, sf_dir, "orders")
    size = F.char_length("text").cast("double")
    sinks.write_parquet(conv.select((F.col("turn") * F.when(F.col("conv_id") % 5 == 0, 21).otherwise(20)).cast("long").alias("time_ms"), F.col("conv_id").alias("sid"), F.col("role").alias("surface"),
                                    F.when(size % 7 != 0, size).alias("chest_acc_x"), F.when(size % 11 != 0, size / 2).alias("left_ankle_gyr_y")), f"{root}/mhealth", buckets=4)
    sinks.write_parquet(orders.select((F.col("o_orderkey") * 17).alias("time_ms"), (F.col("o_custkey") % 18).cast("int").alias("sid"), F.lit("flat").alias("surface"),
                                      (F.col("o_orderkey") % 40).cast("int").alias("trial_no"), F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice")).alias("right_foot_acc_x")),
                        f"{root}/hugadb", buckets=4)
    found = quality.stored_datasets(spark, root)
    return quality.quality_report_all({name: (df, REPORT_KEYS[name]) for name, df in found.items()}, REPORT_RATES)


def _quality_sql() -> str:
    tables = {
        "beach": (_beach(rounded=False), 1000.0 / (HOUR_US // 1000), "sid",
                  {"time_ms": "bigint", "sid": "string", "surface": "string", **{f"{s}_acc_x": "double" for s in ("click", "error", "purchase", "signup", "view")}}),
        "mhealth": ("""SELECT turn * CASE WHEN conv_id % 5 = 0 THEN 21 ELSE 20 END AS time_ms, conv_id AS sid, role AS surface,
  CASE WHEN length(text) % 7 <> 0 THEN length(text) END AS chest_acc_x, CASE WHEN length(text) % 11 <> 0 THEN length(text) END AS left_ankle_gyr_y FROM conversations""",
                    50, "CAST(sid AS VARCHAR)", {"time_ms": "bigint", "sid": "bigint", "surface": "string", "chest_acc_x": "double", "left_ankle_gyr_y": "double"}),
        "hugadb": ("""SELECT o_orderkey * 17 AS time_ms, o_custkey % 18 AS sid, 'flat' AS surface, o_orderkey % 40 AS trial_no,
  CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice END AS right_foot_acc_x FROM orders""",
                   58.8, "CAST(sid AS VARCHAR) || '/' || CAST(trial_no AS VARCHAR)",
                   {"time_ms": "bigint", "sid": "int", "surface": "string", "trial_no": "int", "right_foot_acc_x": "double"}),
    }
    known = {"time_ms", "sid", "surface", "trial_no"}
    ctes, stream, rows = [], [], []
    for name, (sql, fs, key, columns) in tables.items():
        ctes.append(f"t_{name} AS MATERIALIZED ({sql})")
        missing = [c for c in columns if c not in ("sid", "trial_no")]
        stream.append(f"SELECT '{name}' AS dataset, {key} AS recording, time_ms, {fs}::DOUBLE AS fs, concat_ws(',', "
                      + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in missing) + f") AS gone FROM t_{name}")
        facts = [("column", c, k) for c, k in columns.items()]
        facts += [("location", v, None) for v in sorted({c.rsplit("_", 2)[0] if c.count("_") > 2 else c.split("_")[0] for c in columns if c not in known})]
        facts += [("metric", v, None) for v in sorted({c.split("_")[-2] for c in columns if c not in known})]
        rows += [f"SELECT '{name}', '{k}', '{v}', 'info', {f"'{d}'" if d else 'CAST(NULL AS VARCHAR)'}" for k, v, d in facts]
        rows += [f"SELECT '{name}', 'nulls', '{c}', 'warn', CAST(count(*) - count({c}) AS VARCHAR) || '/' || CAST(count(*) AS VARCHAR) FROM t_{name} HAVING count(*) > count({c})"
                 for c in columns]
    return f"""
WITH {", ".join(ctes)},
s AS ({" UNION ALL ".join(stream)}),
p AS (SELECT *, row_number() OVER w - 1 AS pos, time_ms - lag(time_ms) OVER w AS step FROM s WINDOW w AS (PARTITION BY dataset, recording ORDER BY time_ms)),
l AS (SELECT dataset, recording, count(*) AS n, coalesce(min(step) < 0, false) AS neg, coalesce(max(abs(step - 1.0::DOUBLE / fs * 1000.0::DOUBLE)) > 1.0, false) AS tol
      FROM p GROUP BY dataset, recording),
f AS (SELECT dataset, recording, pos, row_number() OVER (PARTITION BY dataset, recording ORDER BY pos) AS no FROM p WHERE gone <> ''),
x AS (SELECT f.dataset, f.recording, f.no, o.o, f.pos + o.o AS pos FROM f, range(-2, 3) o(o) WHERE f.no <= 3)
SELECT * FROM (SELECT NULL AS dataset, NULL AS "check", NULL AS key, NULL AS status, NULL AS detail WHERE false
UNION ALL {" UNION ALL ".join(rows)}
UNION ALL SELECT dataset, 'linearity', recording, CASE WHEN neg OR tol THEN 'fail' ELSE 'pass' END,
  'points=' || CAST(n AS VARCHAR) || ' negative=' || CAST(neg AS VARCHAR) || ' out_of_tolerance=' || CAST(tol AS VARCHAR) FROM l
UNION ALL SELECT x.dataset, 'null_example', x.recording || '/' || CAST(x.no AS VARCHAR) || '/' || CAST(x.o AS VARCHAR),
  CASE WHEN p.gone <> '' THEN 'warn' ELSE 'info' END, CAST(p.time_ms AS VARCHAR) || ': ' || p.gone
  FROM x JOIN p ON p.dataset = x.dataset AND p.recording = x.recording AND p.pos = x.pos)"""


def _folders_of_events(spark: SparkSession, sf_dir: str) -> str:
    """``events`` as sensor folders of subjects of ten users; every third subject
    lacks one sensor, and the value's column is spelled in two ways."""
    ev = table(spark, sf_dir, "events").select(F.format_string("%03d", (F.col("user_id") / 10).cast("long")).alias("sid"), F.col("event_type").alias("sensor"),
                                               F.col("ts").alias("datetime"), F.col("value").alias("x"), (F.col("user_id") / 10).cast("long").alias("s"))
    ev = ev.where(~((F.col("sensor") == "view") & (F.col("s") % 3 == 0)))
    root = scratch_path(spark, "raw-folders")
    for rows in (ev.where(F.col("s") % 2 == 0), ev.where(F.col("s") % 2 != 0).withColumnsRenamed({"x": " X", "datetime": "DateTime"}).withColumn("battery", F.lit(1))):
        rows.drop("s").repartition(shuffle_partitions(spark), "sid", "sensor").write.mode("append").partitionBy("sid", "sensor").parquet(root)
    return root


def beach_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor folders read as one long table and harmonised (hour grid)."""
    h = recordings.harmonise_beach_folders(spark, _folders_of_events(spark, sf_dir), sensors=EVENT_SENSORS, values=["x"], step_us=HOUR_US)
    return h.data.withColumns({f"{s}_acc_x": F.round(f"{s}_acc_x", AVG_DECIMALS) for s in EVENT_SENSORS})


def absent_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sensors that a subject's folder lacks, for the subjects of a table."""
    wanted = table(spark, sf_dir, "events").select(F.format_string("%03d", (F.col("user_id") / 10).cast("long")).alias("sid")).where(F.col("user_id") % 4 != 1)
    return text.read_sensor_folders(spark, _folders_of_events(spark, sf_dir), [*EVENT_SENSORS, "spare"], wanted, ["x"])[1]


def _beach_folders_sql() -> str:
    sid = "lpad(CAST(user_id // 10 AS VARCHAR), 3, '0') AS sid"
    return (_beach(rounded=True).replace("CAST(user_id AS VARCHAR) AS sid", sid)
            .replace("WHERE ts IS NOT NULL", "WHERE ts IS NOT NULL AND NOT (event_type = 'view' AND (user_id // 10) % 3 = 0)"))


_ABSENT = f"""
WITH e AS (SELECT user_id // 10 AS s, event_type AS sensor FROM events WHERE NOT (event_type = 'view' AND (user_id // 10) % 3 = 0)),
w AS (SELECT DISTINCT user_id // 10 AS s FROM events WHERE user_id % 4 <> 1 AND user_id // 10 IN (SELECT s FROM e))
SELECT lpad(CAST(w.s AS VARCHAR), 3, '0') AS sid, n.sensor FROM w, (VALUES {", ".join(f"('{s}')" for s in [*EVENT_SENSORS, "spare"])}) n(sensor)
WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.s = w.s AND e.sensor = n.sensor)"""


def changed_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of ``conversations`` in two deliveries, the second with new
    files, a changed one and a removed one; what the manifest says of each group's
    file, and the rows of the new and changed files, which alone are read."""
    lines = table(spark, sf_dir, "conversations").select(_group().alias("g"), F.concat_ws(",", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("value"))
    root = scratch_path(spark, "raw-deliveries")
    write = lambda rows, to: rows.repartition(shuffle_partitions(spark), "g").write.mode("append").partitionBy("g").text(to)
    write(lines.where(F.col("g") % 3 != 2), root)
    before = files.write_manifest(files.file_listing(spark, root), scratch_path(spark, "manifest"))
    write(lines.where(F.col("g") % 3 == 2), root)
    jvm = spark.sparkContext._jvm
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(at(f"{root}/g=3"), True)
    again = scratch_path(spark, "raw-again")
    write(lines.where(F.col("g") == 1).withColumn("value", F.concat("value", F.lit(",again"))), again)
    if fs.exists(at(f"{again}/g=1")):
        (old,), (new,) = ([f.getPath() for f in fs.listStatus(at(f"{p}/g=1")) if f.getPath().getName().startswith("part-")] for p in (root, again))
        fs.delete(old, False)
        fs.rename(new, old)
    changes = files.changed_files(files.file_listing(spark, root), before)
    folder = F.regexp_extract("path", "/g=([0-9]+)/", 1).cast("long").alias("g")
    read = text.read_headerless(spark, files.paths_to_read(changes), 3, pattern=",").rows
    counts = read.groupBy(folder).agg(F.count("*").alias("n_rows"), F.count("f2").alias("n_again"))
    return changes.select(folder, "status").join(counts, "g", "left")


_CHANGED = f"""
WITH c AS (SELECT conv_id // {GROUP} AS g, count(*) AS n FROM conversations GROUP BY conv_id // {GROUP}),
s AS (SELECT g, n, CASE WHEN g = 1 THEN 'changed' WHEN g = 3 THEN 'removed' WHEN g % 3 = 2 THEN 'new' ELSE 'same' END AS status FROM c)
SELECT g, status, CASE WHEN status IN ('new', 'changed') THEN n END AS n_rows,
       CASE status WHEN 'new' THEN 0 WHEN 'changed' THEN n END AS n_again FROM s"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "broken_files": broken_files, "quoted_records": quoted_records, "append_twice_parquet": _append_twice("parquet"), "append_twice_csv": _append_twice("csv"),
    "quality_all": quality_all, "beach_folders": beach_folders, "absent_sensors": absent_sensors, "changed_since": changed_since,
}
ORACLE: dict[str, str] = {"broken_files": _BROKEN, "quoted_records": _QUOTED, "append_twice_parquet": _APPEND, "append_twice_csv": _APPEND, "quality_all": _quality_sql(),
                          "beach_folders": _beach_folders_sql(), "absent_sensors": _ABSENT, "changed_since": _CHANGED}

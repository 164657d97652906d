"""Registered reader queries: raw text layouts that Spark derives from the
benchmark tables, read back by the layout readers.

Each query first writes the table's rows in a raw layout (several files, into
a fresh folder under the shared ``spark.checkpoint.dir``), then parses them
with the reader under test. The expected result is the table itself, so the
oracle SQL reads the table directly. Line order inside the written files is
not known to the oracle, so outputs carry no line numbers.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave import catalog
from sensorweave.functions.labels import expand_lists
from sensorweave.functions.units import coerce_numeric
from sensorweave.operators import sequence as seq
from sensorweave.operators.joins import null_safe_join
from sensorweave.plans import recordings
from sensorweave.session import materialize, scratch_path, shuffle_partitions, shuffles_removed
from sensorweave.sources import text
from sensorweave.sources.sinks import append_aligned


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _scratch(spark: SparkSession, tag: str) -> str:
    return scratch_path(spark, f"raw-{tag}")


def _files(spark: SparkSession) -> int:
    """Number of files to write: scales with the session's parallelism."""
    return max(2, shuffle_partitions(spark))


def _write_lines(df: DataFrame, path: str, line) -> None:
    """Write one text line per row, spread over many files."""
    df.select(line.alias("value")).repartition(_files(df.sparkSession)).write.mode("overwrite").text(path)


#: Lines of a recording up to which its file is packed. A scan can't split a
#: packed file, so the files of longer recordings stay plain.
PACKED_LINES = 1 << 20
#: The names of files written so.
RECORDING_FILES = "*.{txt,txt.gz}"


def _recordings(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The recordings of the rows, with their number of lines (``_lines``)."""
    return materialize(rows.groupBy(*keys).agg(F.count("*").alias("_lines")), "recordings")


def _write_recordings(rows: DataFrame, found: DataFrame, keys: list[str], order: list[str], line, root: str) -> None:
    """Write one text file for each recording (``found``), its lines in order.
    Rows are dealt and sorted before they are made text by ``line``, as the text
    is many times larger than the columns it is made of."""
    longer = found.where(F.col("_lines") > PACKED_LINES).select(*keys)  # few: one for so many rows at most
    parts = {"gzip": rows}
    if not longer.isEmpty():
        parts = {codec: null_safe_join(rows, F.broadcast(longer), keys, how) for codec, how in (("gzip", "left_anti"), ("none", "left_semi"))}
    with shuffles_removed(rows.sparkSession):
        for codec, part in parts.items():
            (_recording_lines(part, keys, order, line).write.mode("append")
             .options(**{"compression": codec, "zlib.compress.level": "BEST_SPEED"}).partitionBy(*keys).text(root))


def _recording_lines(rows: DataFrame, keys: list[str], order: list[str], line) -> DataFrame:
    return (rows.repartition(_files(rows.sparkSession), *keys).sortWithinPartitions(*keys, *order)
            .select(line.alias("value"), *keys))


def headed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as headed CSV files whose headers differ in column
    order, case and padding; fields bound by each file's own header."""
    cu = _table(spark, sf_dir, "customer")
    root = _scratch(spark, "headed")
    in_a = F.coalesce(F.col("c_nationkey") < 13, F.lit(True))
    a, b = cu.filter(in_a), cu.filter(~in_a)  # complementary: every row once
    # layout A: natural order, upper case names; layout B: reversed, padded
    (a.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
     .toDF("C_CUSTKEY", "C_NAME", "C_NATIONKEY", "C_ACCTBAL", "C_MKTSEGMENT")
     .repartition(_files(spark)).write.option("header", True).csv(os.path.join(root, "a")))
    (b.select("c_mktsegment", "c_acctbal", "c_nationkey", "c_name", "c_custkey")
     .toDF(" c_mktsegment", " c_acctbal", " c_nationkey", " c_name", " c_custkey")
     .repartition(_files(spark)).write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .csv(os.path.join(root, "b")))
    scan = text.read_headed(spark, root, glob="*.csv", recursive=True, strip=True)
    r = scan.rows
    return r.select(
        r.c_custkey.try_cast("long").alias("c_custkey"), r.c_name.alias("c_name"),
        r.c_nationkey.try_cast("int").alias("c_nationkey"),
        coerce_numeric(r.c_acctbal).alias("c_acctbal"),
        r.c_mktsegment.alias("c_mktsegment"))


def headerless_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: ``lineitem`` numbers as headerless lines separated by spaces or
    commas, with blank lines mixed in."""
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    root = _scratch(spark, "headerless")
    sep = F.when(F.col("l_linenumber") % 2 == 0, F.lit(" ")).otherwise(F.lit(","))
    line = F.concat_ws("", F.col("l_orderkey").cast("string"), sep,
                       F.col("l_linenumber").cast("string"), F.lit("  "),
                       F.col("l_quantity").cast("string"),
                       F.when(F.col("l_linenumber") == 3, F.lit("\n")).otherwise(F.lit("")))
    _write_lines(li, root, line)
    scan = text.read_headerless(spark, root, 3, pattern=r"\s+|,")
    r = scan.rows
    return r.select(r.f0.try_cast("long").alias("l_orderkey"),
                    r.f1.try_cast("int").alias("l_linenumber"),
                    coerce_numeric(r.f2).alias("l_quantity"))


def commented_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as whitespace-separated files with '#' comments and a
    header line per file that is replaced by fixed names."""
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    root = _scratch(spark, "commented")
    line = F.concat_ws(" ", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
                       F.concat(F.col("o_totalprice").cast("string"), F.lit("  # price")))
    files = _files(spark)
    body = o.select(line.alias("value"), F.lit(1).alias("_k"),
                    F.pmod(F.hash(line), F.lit(files)).alias("_f"))
    head = spark.range(files).select(F.lit("# recorded\nkey cust price").alias("value"),
                                     F.lit(0).alias("_k"), F.col("id").cast("int").alias("_f"))
    # one folder (and file) per _f, its header line first
    (body.unionByName(head).repartition(files, "_f").sortWithinPartitions("_f", "_k")
     .select("value", "_f").write.mode("overwrite").partitionBy("_f").text(root))
    scan = text.read_commented(spark, root, ["o_orderkey", "o_custkey", "o_totalprice"])
    r = scan.rows
    return r.select(r.o_orderkey.try_cast("long").alias("o_orderkey"),
                    r.o_custkey.try_cast("long").alias("o_custkey"),
                    coerce_numeric(r.o_totalprice).alias("o_totalprice"))


def delimited_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as headerless tab-separated lines with fixed names."""
    p = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    root = _scratch(spark, "tsv")
    line = F.concat_ws("\t", *[F.col(c).cast("string") for c in p.columns])
    _write_lines(p, root, line)
    scan = text.read_delimited(spark, root, ["p_partkey", "p_name", "p_size", "p_retailprice"], sep="\t")
    r = scan.rows
    return r.select(r.p_partkey.try_cast("long").alias("p_partkey"), r.p_name,
                    r.p_size.try_cast("int").alias("p_size"),
                    coerce_numeric(r.p_retailprice).alias("p_retailprice"))


# mHealth layout derived from lineitem: one file per supplier (the subject),
# 23 readings taken round-robin from these columns, the label from quantity
MHEALTH_SOURCES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax",
                   "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
# a total order of the written lines: every written field is one of these
MHEALTH_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax"]


def _subject():
    """A subject groups ten suppliers: 10 subjects at sf0.01, like the
    mHealth study, and larger files than one per supplier."""
    return (F.col("l_suppkey") / F.lit(10)).cast("long")


def _mhealth_fields() -> list[tuple[str, str]]:
    data = [c for c in catalog.MHEALTH_COLUMNS if c != "surface"]
    return [(n, MHEALTH_SOURCES[i % len(MHEALTH_SOURCES)]) for i, n in enumerate(data)]


def mhealth_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 end to end: ``lineitem`` written in the mHealth layout (one TSV file
    per subject, lines in a fixed order, no header), then harmonised:
    position -> 20 ms time, label -> surface with forward fill, deg/s -> rad/s."""
    li = _table(spark, sf_dir, "lineitem")
    root = _scratch(spark, "mhealth")
    # a missing value is an empty field, never a dropped one
    fields = [F.coalesce(F.col(src).cast("string"), F.lit("")) for _, src in _mhealth_fields()]
    label = F.coalesce(F.col("l_quantity").cast("int").cast("string"), F.lit(""))
    rows = li.select((_subject() + 1).alias("subject"), *MHEALTH_ORDER)
    _write_recordings(rows, _recordings(rows, ["subject"]), ["subject"], MHEALTH_ORDER,
                      F.concat_ws("\t", *fields, label), root)
    h = recordings.harmonise_mhealth(spark, root, glob=RECORDING_FILES, subject_pattern=r"subject=(\d+)/",
                                     subject_in="path", enumerated=False)
    return h.data


QUERIES = {
    "src_headed_csv": headed_csv,
    "src_headerless_text": headerless_text,
    "src_commented_text": commented_text,
    "src_delimited_tsv": delimited_tsv,
    "mhealth_layout": mhealth_layout,
}

ORACLE = {
    "src_headed_csv": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "src_headerless_text": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem",
    "src_commented_text": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "src_delimited_tsv": "SELECT p_partkey, p_name, p_size, p_retailprice FROM part",
}


def _mhealth_oracle() -> str:
    def case(expr, mapping):
        return "CASE " + expr + " " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in mapping.items()) + " END"
    cols = []
    for name, src in _mhealth_fields():
        v = f"CAST({src} AS DOUBLE)"
        if "gyr" in name:
            v = f"{v} * (pi() / 180.0::DOUBLE)"
        cols.append(f"{v} AS {name}")
    order = ", ".join(MHEALTH_ORDER)
    return f"""
WITH b AS (
  SELECT CAST(l_suppkey // 10 + 1 AS INTEGER) AS sid,
         row_number() OVER (PARTITION BY l_suppkey // 10 ORDER BY {order}) - 1 AS pos,
         {case("CAST(l_quantity AS INTEGER)", catalog.MHEALTH_SURFACES)} AS lab,
         {", ".join(cols)}
  FROM lineitem)
SELECT pos * {catalog.GRID_STEP_MS["mhealth"]} AS time_ms, sid,
       last_value(lab IGNORE NULLS) OVER (PARTITION BY sid ORDER BY pos
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS surface,
       {", ".join(n for n, _ in _mhealth_fields())}
FROM b"""


ORACLE["mhealth_layout"] = _mhealth_oracle()


# ---------------------------------------------------------------- karas

def _karas_in_a():
    # subjects are split between two header layouts; every row is written once
    return F.coalesce(_subject().bitwiseAND(F.lit(1)) == 0, F.lit(True))


def karas_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 end to end: ``lineitem`` as one headed CSV per subject (supplier),
    half of the subjects with another column order and an extra column, then
    harmonised by header name: seconds -> ms, activity -> surface, g -> m/s^2."""
    li = _table(spark, sf_dir, "lineitem")
    root = _scratch(spark, "karas")
    base = li.select(_subject().alias("subject"), _karas_in_a().alias("_a"),
                     F.col("l_linenumber").alias("activity"),
                     (F.col("l_extendedprice") / F.lit(1000.0)).alias("time_s"),
                     F.col("l_quantity").alias("lw_x"), F.col("l_discount").alias("lw_y"),
                     F.col("l_tax").alias("lw_z"), F.col("l_partkey").alias("la_x"))
    n = _files(spark)
    (base.filter(F.col("_a")).select("subject", "activity", "time_s", "lw_x", "lw_y", "lw_z")
     .repartition(n, "subject").write.mode("overwrite").partitionBy("subject")
     .option("header", True).csv(os.path.join(root, "a")))
    (base.filter(~F.col("_a")).select("subject", "lw_z", "time_s", "la_x", "activity", "lw_y", "lw_x")
     .repartition(n, "subject").write.mode("overwrite").partitionBy("subject")
     .option("header", True).csv(os.path.join(root, "b")))
    return recordings.harmonise_karas(
        spark, root, subject_pattern=r"subject=(\d+)/",
        columns=["activity", "time_s", "lw_x", "lw_y", "lw_z", "la_x"]).data


def _karas_oracle() -> str:
    g = "9.80665::DOUBLE"
    surf = "CASE l_linenumber " + " ".join(
        f"WHEN {k} THEN '{v}'" for k, v in catalog.KARAS_SURFACES.items()) + " END"
    return f"""
SELECT CAST(trunc((l_extendedprice / 1000.0::DOUBLE) * 1000.0::DOUBLE) AS BIGINT) AS time_ms,
       CAST(l_suppkey // 10 AS VARCHAR) AS sid, {surf} AS surface,
       l_quantity * {g} AS lw_x, l_discount * {g} AS lw_y, l_tax * {g} AS lw_z,
       CASE WHEN ((l_suppkey // 10) & 1) <> 0 THEN CAST(l_partkey AS DOUBLE) * {g} END AS la_x
FROM lineitem"""


# ---------------------------------------------------------------- hugadb (E5)

HUGADB_INT_SOURCES = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
HUGADB_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax"]


def _hugadb_fields() -> list[tuple[str, str]]:
    data = [c for c in catalog.HUGADB_COLUMNS if c != "activityid"]
    return [(n, HUGADB_INT_SOURCES[i % len(HUGADB_INT_SOURCES)]) for i, n in enumerate(data)]


def _hugadb_trial():
    return F.when(F.col("l_linestatus") == "F", F.lit(1)).otherwise(F.lit(2))


def hugadb_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5 end to end: ``lineitem`` as one commented file per (subject,
    trial): a '#' line, a header line, then 39 whitespace-separated fields,
    some lines with trailing comments; harmonised by position (17 ms),
    int16 scales and the activity map with 'other'."""
    li = _table(spark, sf_dir, "lineitem")
    root = _scratch(spark, "hugadb")
    fields = [F.coalesce(F.col(src).cast("string"), F.lit("")) for _, src in _hugadb_fields()]
    act = F.coalesce(F.col("l_quantity").cast("int").cast("string"), F.lit(""))
    line = F.concat(F.concat_ws(" ", *fields, act),
                    F.when(F.col("l_linenumber") == 1, F.lit("  # checked")).otherwise(F.lit("")))
    body = li.select(_subject().alias("sid"), _hugadb_trial().alias("trial"),
                     F.lit(1).alias("_k"), *HUGADB_ORDER)
    found = _recordings(body, ["sid", "trial"])
    heads = found.select(
        "sid", "trial", F.lit(0).alias("_k"),
        *[F.lit(None).cast(li.schema[c].dataType).alias(c) for c in HUGADB_ORDER])
    line = F.when(F.col("_k") == 0, F.lit("# HGD v2 export\nfield names")).otherwise(line)
    _write_recordings(body.unionByName(heads), found, ["sid", "trial"], ["_k", *HUGADB_ORDER], line, root)
    return recordings.harmonise_hugadb(spark, root, sid_pattern=r"sid=(\d+)/",
                                       trial_pattern=r"trial=(\d+)/", glob=RECORDING_FILES).data


def _hugadb_oracle() -> str:
    acc = "((2.0::DOUBLE * 9.80665::DOUBLE) / 32768.0::DOUBLE)"
    gyr = "((2000.0::DOUBLE * pi() / 180.0::DOUBLE) / 32768.0::DOUBLE)"
    cols = []
    for name, src in _hugadb_fields():
        v = f"CAST({src} AS DOUBLE)"
        if "acc" in name:
            v = f"{v} * {acc}"
        elif "gyr" in name:
            v = f"{v} * {gyr}"
        cols.append(f"{v} AS {name}")
    surf = "COALESCE(CASE CAST(l_quantity AS INTEGER) " + " ".join(
        f"WHEN {k} THEN '{v}'" for k, v in catalog.HUGADB_SURFACES.items()) + " END, 'other')"
    order = ", ".join(HUGADB_ORDER)
    return f"""
WITH b AS (SELECT *, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS trial,
                    l_suppkey // 10 AS subject FROM lineitem)
SELECT (row_number() OVER (PARTITION BY subject, trial ORDER BY {order}) - 1)
         * {catalog.GRID_STEP_MS['hugadb']} AS time_ms,
       CAST(subject AS INTEGER) AS sid, {surf} AS surface, CAST(trial AS INTEGER) AS trial_no,
       {", ".join(cols)}
FROM b"""


# ---------------------------------------------------------------- bruno

BRUNO_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax"]


def _bruno_activity():
    return (F.when(F.col("l_returnflag") == "A", F.lit("walk"))
            .when(F.col("l_returnflag") == "N", F.lit("climb_stairs")).otherwise(F.lit("comb_hair")))


def _bruno_volunteer():
    # as many volunteers as subjects, so that the files grow in number with the table
    return F.concat(F.when(F.col("l_linestatus") == "F", F.lit("f")).otherwise(F.lit("m")), _subject().cast("string"))


def bruno_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 end to end: ``lineitem`` as one headerless file per (activity,
    volunteer), three codes per line separated by spaces or commas; trial and
    subject ids by path order, 32 Hz time, 6-bit codes -> m/s^2."""
    li = _table(spark, sf_dir, "lineitem")
    root = _scratch(spark, "bruno")
    sep = F.when(F.col("l_linenumber") % 2 == 0, F.lit(" ")).otherwise(F.lit(","))
    line = F.concat_ws("", F.col("l_quantity").cast("string"), sep,
                       F.col("l_linenumber").cast("string"), sep, F.col("l_tax").cast("string"))
    (li.select(_bruno_activity().alias("activity"), _bruno_volunteer().alias("volunteer"),
               *BRUNO_ORDER, line.alias("value"))
     .repartition(_files(spark), "activity", "volunteer")
     .sortWithinPartitions("activity", "volunteer", *BRUNO_ORDER)
     .select("value", "activity", "volunteer").write.mode("overwrite")
     .partitionBy("activity", "volunteer").text(root))
    return recordings.harmonise_bruno(spark, root, activity_pattern=r"activity=([^/]+)/",
                                      volunteer_pattern=r"volunteer=([^/]+)/").data


def _bruno_oracle() -> str:
    g = "9.80665::DOUBLE"

    def six(c):
        return f"(-1.5::DOUBLE + (CAST({c} AS DOUBLE) / 63.0::DOUBLE) * 3.0::DOUBLE) * {g}"
    surf = "COALESCE(CASE activity " + " ".join(
        f"WHEN '{k}' THEN '{v}'" for k, v in catalog.BRUNO_SURFACES.items()) + " END, activity)"
    order = ", ".join(BRUNO_ORDER)
    return f"""
WITH b AS (
  SELECT *, CASE l_returnflag WHEN 'A' THEN 'walk' WHEN 'N' THEN 'climb_stairs' ELSE 'comb_hair' END AS activity,
         CASE WHEN l_linestatus = 'F' THEN 'f' ELSE 'm' END || CAST(l_suppkey // 10 AS VARCHAR) AS volunteer FROM lineitem),
p AS (SELECT *, 'activity=' || activity || '/volunteer=' || volunteer || '/' AS dir FROM b),
f AS (SELECT DISTINCT dir, volunteer FROM p),
t AS (SELECT dir, row_number() OVER (ORDER BY dir) AS trial_no FROM f),
v AS (SELECT volunteer, row_number() OVER (ORDER BY min(dir)) AS sid FROM f GROUP BY volunteer)
SELECT CAST(trunc((row_number() OVER (PARTITION BY p.dir ORDER BY {order}) - 1)
         * (1000.0::DOUBLE / 32.0::DOUBLE)) AS BIGINT) AS time_ms,
       CAST(v.sid AS INTEGER) AS sid, {surf} AS surface, CAST(t.trial_no AS INTEGER) AS trial_no,
       {six('l_quantity')} AS right_wrist_acc_x, {six('l_linenumber')} AS right_wrist_acc_y,
       {six('l_tax')} AS right_wrist_acc_z
FROM p JOIN t ON p.dir = t.dir JOIN v ON p.volunteer = v.volunteer"""


QUERIES.update({"karas_layout": karas_layout, "hugadb_layout": hugadb_layout,
                "bruno_layout": bruno_layout})
ORACLE.update({"karas_layout": _karas_oracle(), "hugadb_layout": _hugadb_oracle(),
               "bruno_layout": _bruno_oracle()})


# ---------------------------------------------------------------- luo

LUO_CODES = {"A": "CC", "N": "9B", "R": "B6"}


LUO_COLUMNS = ["packetcounter", "sampletimefine", "acc_x", "acc_y", "acc_z"]
# a total order of the written rows
LUO_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity", "l_discount", "l_tax"]
LUO_RULES = dict(sid_pattern=r"sid=(\d+)/", trial_pattern=r"trial=(\d+)/",
                 code_pattern=r"code=([^/]+)/", enumerated=False, columns=LUO_COLUMNS)


def _luo_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as luo sensor rows: (sid, trial, code, PacketCounter, ...)."""
    li = _table(spark, sf_dir, "lineitem")
    code = F.when(F.col("l_returnflag") == "A", F.lit(LUO_CODES["A"])).when(
        F.col("l_returnflag") == "N", F.lit(LUO_CODES["N"])).otherwise(F.lit(LUO_CODES["R"]))
    base = li.select(_subject().alias("sid"), _hugadb_trial().alias("trial"), code.alias("code"),
                     *LUO_ORDER)
    # place of the row inside its recording (segmented index, no recording-wide window)
    base = seq.seq_index(base, ["sid", "trial"], LUO_ORDER, "_rank")
    packet = F.when((F.col("sid") % 8 == 5) & (F.col("trial") == 2), F.floor(F.col("_rank") / 3)).otherwise(
        3 * F.col("_rank") + F.col("l_linenumber") % 3).cast("long")
    return base.select("sid", "trial", "code", packet.alias("PacketCounter"),
                       F.col("l_partkey").alias("SampleTimeFine"), F.col("l_quantity").alias("Acc_X"),
                       F.col("l_discount").alias("Acc_Y"), F.col("l_tax").alias("Acc_Z"))


def _write_luo(lines: DataFrame, root: str) -> None:
    """One headed CSV per (subject, trial, sensor) folder."""
    (lines.repartition(_files(lines.sparkSession), "sid", "trial", "code")
     .write.mode("overwrite").partitionBy("sid", "trial", "code").option("header", True).csv(root))


def luo_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 end to end: ``lineitem`` as one headed CSV per (subject, trial,
    sensor) with a packet counter (three per row and a shift, so packets have
    gaps; in the second trial of every eighth subject they repeat, which
    rejects it); harmonised by aligning the sensors on the counter, filling
    every packet, 10 ms per packet from the trial start."""
    root = _scratch(spark, "luo")
    _write_luo(_luo_lines(spark, sf_dir), root)
    return recordings.harmonise_luo(spark, root, **LUO_RULES).data


def luo_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E7 end to end: the luo files arrive in two folders (trial 1, then
    trial 2; every row is in one of them). The first batch is harmonised and
    stored in an older output layout (one sensor column missing, one
    obsolete column); the second batch is harmonised and appended matched to
    that layout. The result is the stored table read back."""
    root = _scratch(spark, "luo-append")
    # one write: the batch folder is the trial (every row lands in one batch)
    lines = _luo_lines(spark, sf_dir).withColumn("batch", F.col("trial"))
    (lines.repartition(_files(spark), "batch", "sid", "trial", "code")
     .write.mode("overwrite").partitionBy("batch", "sid", "trial", "code")
     .option("header", True).csv(os.path.join(root, "in")))
    out = os.path.join(root, "out")
    older = (recordings.harmonise_luo(spark, os.path.join(root, "in", "batch=1"), **LUO_RULES).data
             .drop("right_wrist_acc_y").withColumn("trunk_roll", F.lit(None).cast("double")))
    older.write.mode("overwrite").parquet(out)
    append_aligned(recordings.harmonise_luo(spark, os.path.join(root, "in", "batch=2"), **LUO_RULES).data,
                   out)
    return spark.read.parquet(out)


def _luo_oracle(drop: str | None = None, extra: str | None = None) -> str:
    locs = list(dict.fromkeys(catalog.LUO_SENSOR_CODES.values()))
    loc_case = "CASE l_returnflag " + " ".join(
        f"WHEN '{flag}' THEN '{catalog.LUO_SENSOR_CODES[c]}'" for flag, c in LUO_CODES.items()
        if flag != "R") + f" ELSE '{catalog.LUO_SENSOR_CODES[LUO_CODES['R']]}' END"
    metrics = [("l_quantity", "acc_x"), ("l_discount", "acc_y"), ("l_tax", "acc_z")]
    wide = ", ".join(f"max(CASE WHEN loc = '{lo}' THEN {src} END) AS {lo}_{m}"
                     for lo in locs for src, m in metrics)
    cols = ", ".join([f"w.{lo}_{m}" for lo in locs for _, m in metrics if f"{lo}_{m}" != drop]
                     + ([f"CAST(NULL AS DOUBLE) AS {extra}"] if extra else []))
    trial_map = expand_lists(catalog.LUO_TRIAL_SURFACES)
    surf = "COALESCE(CASE g.trial " + " ".join(
        f"WHEN {k} THEN '{v}'" for k, v in trial_map.items()) + " END, 'unknown')"
    return f"""
WITH b AS (
  SELECT CAST(l_suppkey // 10 AS INTEGER) AS sid,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS trial,
         {loc_case} AS loc, {", ".join(LUO_ORDER)}
  FROM lineitem),
k AS (SELECT *, row_number() OVER (PARTITION BY sid, trial ORDER BY {", ".join(LUO_ORDER)}) - 1 AS place FROM b),
r AS (SELECT *, CAST(CASE WHEN sid % 8 = 5 AND trial = 2 THEN place // 3 ELSE 3 * place + l_linenumber % 3 END AS BIGINT) AS packet FROM k),
bad AS (SELECT DISTINCT sid, trial FROM r GROUP BY sid, trial, packet, loc HAVING count(*) > 1),
ok AS (SELECT * FROM r WHERE NOT EXISTS (
         SELECT 1 FROM bad WHERE bad.sid = r.sid AND bad.trial = r.trial)),
w AS (SELECT sid, trial, packet, {wide} FROM ok GROUP BY sid, trial, packet),
e AS (SELECT sid, trial, min(packet) AS lo, max(packet) AS hi FROM w GROUP BY sid, trial),
g AS (SELECT sid, trial, lo, unnest(generate_series(lo, hi)) AS packet FROM e)
SELECT (g.packet - g.lo) * {catalog.GRID_STEP_MS['luo']} AS time_ms, g.sid, {surf} AS surface,
       CAST(g.trial AS INTEGER) AS trial_no, g.packet AS packetcounter, {cols}
FROM g LEFT JOIN w ON w.sid = g.sid AND w.trial = g.trial AND w.packet = g.packet"""


QUERIES["luo_layout"] = luo_layout
ORACLE["luo_layout"] = _luo_oracle()
QUERIES["luo_append"] = luo_append
ORACLE["luo_append"] = _luo_oracle(drop="right_wrist_acc_y", extra="trunk_roll")

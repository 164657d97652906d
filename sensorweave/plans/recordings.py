"""Harmonising each public dataset layout into its tidy wide table.

Each function reads every file of a dataset in one distributed scan and
returns :class:`Harmonised`: the wide table (``time_ms, sid, surface
[, trial_no], sensor columns...``) and a ``rejects`` table ``(path, line_no,
reason)`` of lines or files that were set aside. Datasets are never merged
with each other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave import catalog
from sensorweave.functions import labels, paths, timegrid, units
from sensorweave.functions.columns import names_containing
from sensorweave.operators import align, sequence as seq, timeline
from sensorweave.plans.harmonise import harmonise_long
from sensorweave.session import materialize
from sensorweave.sources import files, sinks, text


@dataclass
class Harmonised:
    """``rejects`` is put together when it is first asked for, as it lists the files."""
    data: DataFrame
    set_aside: Callable[[], DataFrame]
    missing: DataFrame | None = None

    @cached_property
    def rejects(self) -> DataFrame:
        return self.set_aside()


def _rejects(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "path string, line_no long, reason string")


def _whole_files(found: DataFrame, reason) -> DataFrame:
    """Rejects of whole files, from a file listing and a reason per path."""
    return (found.select("path", F.lit(None).cast("long").alias("line_no"), reason.alias("reason"))
            .where(F.col("reason").isNotNull()))


def _outside(sid, lo: int, hi: int):
    return F.coalesce(~sid.between(lo, hi), F.lit(True))


# ---------------------------------------------------------------- E6 mhealth

MHEALTH_SUBJECT = r"^mHealth_subject(\d+)\.log$"


def harmonise_mhealth(spark: SparkSession, root: str, glob: str = "mHealth_subject*.log",
                      subject_pattern: str = MHEALTH_SUBJECT, subject_in: str = "name",
                      enumerated: bool = True) -> Harmonised:
    """``mHealth_subject<N>.log`` (N = 1..10): tab-separated, 23 readings and a
    label per line at 50 Hz. Labels map to surfaces; unknown labels take the
    previous surface; gyroscopes deg/s -> rad/s.

    ``subject_pattern`` (first group = subject id, matched against the file
    ``name`` or full ``path``) and ``glob`` describe where files and ids are;
    ``enumerated`` keeps only the subjects the layout promises (1..10) and
    reports the missing ones.
    """
    names = catalog.MHEALTH_COLUMNS
    lo, hi = catalog.EXPECTED_SUBJECTS["mhealth"]

    def subject(path):
        where = paths.file_name(path) if subject_in == "name" else path
        return F.regexp_extract(where, subject_pattern, 1).try_cast("int")

    def reason(path):
        sid = subject(path)
        out = F.when(sid.isNull(), F.lit("no subject in the file name"))
        return out.when(_outside(sid, lo, hi), F.lit("subject outside the layout's range")) if enumerated else out

    look = {"glob": glob, "recursive": not enumerated}
    scan = text.read_delimited(spark, root, names, sep="\t", where=lambda p: reason(p).isNull(), **look)
    listed = cache(lambda: text.list_files(spark, root, **look))
    data_cols = [c for c in names if c != "surface"]
    rows = text.as_double(scan.rows, data_cols)
    rows = rows.withColumn("surface", labels.map_label(F.col("surface"), catalog.MHEALTH_SURFACES,
                                                       labels.NULL))
    rows = seq.seq_ffill(rows, ["path"], ["line_no"], "surface", width=float(seq.TARGET_ROWS))
    # what follows from the path and position is added after the fill has dealt out the rows;
    # the axis is the row position, so the 20 ms grid has no holes to fill
    rows = rows.withColumns({"sid": subject(F.col("path")),
                             "time_ms": timegrid.ms_from_step(F.col("line_no"), catalog.GRID_STEP_MS["mhealth"])})
    gyr = names_containing(rows.select(*data_cols), "gyr")
    rows = rows.withColumns({c: units.deg_to_rad(F.col(c)) for c in gyr})
    missing = (files.missing_inputs(files.expected_range(spark, "sid", lo, hi),
                                    listed().select(subject(F.col("path")).alias("sid")), "sid") if enumerated else None)
    return Harmonised(rows.select("time_ms", "sid", "surface", *data_cols),
                      lambda: scan.rejects.unionByName(_whole_files(listed(), reason(F.col("path")))), missing)


# ---------------------------------------------------------------- E5 hugadb

def harmonise_hugadb(spark: SparkSession, root: str, sid_pattern: str | None = None,
                     trial_pattern: str | None = None, glob: str = "*.txt") -> Harmonised:
    """``HGD_vX_ACT_PR_CNT.txt``: '#' comments, a header line, then 39
    whitespace-separated int16 fields at 17 ms per row. Activity ids map to
    surfaces (unknown -> 'other'); acc/gyr counts -> m/s^2 and rad/s.

    ``sid_pattern``/``trial_pattern`` (regex, first group, on the path) take
    the ids from elsewhere than the file name; files are then searched
    recursively. ``glob`` describes their names.
    """
    names = catalog.HUGADB_COLUMNS
    by_path = sid_pattern is not None

    def ids(path):
        if not by_path:
            return paths.underscored_ids(paths.file_stem(path))
        return tuple(F.regexp_extract(path, p, 1).try_cast("int") for p in (sid_pattern, trial_pattern))

    def reason(path):
        sid, trial = ids(path)
        return F.when(sid.isNull() | trial.isNull(), F.lit("no subject and trial number in the file name"))

    look = {"glob": glob, "recursive": by_path, "skip_names": ["readme.txt", "readme.md"]}
    scan = text.read_commented(spark, root, names, where=lambda p: reason(p).isNull(), **look)
    sid, trial = ids(F.col("path"))
    sensor_cols = [c for c in names if c != "activityid"]
    rows = text.as_double(scan.rows, sensor_cols)
    rows = rows.select(
        timegrid.ms_from_step(F.col("line_no"), catalog.GRID_STEP_MS["hugadb"]).alias("time_ms"),
        sid.alias("sid"),
        labels.map_label(F.col("activityid"), catalog.HUGADB_SURFACES, "other").alias("surface"),
        trial.alias("trial_no"),
        *[F.col(c) for c in sensor_cols])
    rows = rows.withColumns({c: units.int16_acc_to_ms2(F.col(c)) for c in sensor_cols if "acc" in c})
    rows = rows.withColumns({c: units.int16_gyr_to_rads(F.col(c)) for c in sensor_cols if "gyr" in c})
    return Harmonised(rows, lambda: scan.rejects.unionByName(
        _whole_files(text.list_files(spark, root, **look), reason(F.col("path")))))


# ---------------------------------------------------------------- E4 bruno

def harmonise_bruno(spark: SparkSession, root: str, activity_pattern: str | None = None,
                    volunteer_pattern: str | None = None) -> Harmonised:
    """``<Activity>/Accelerometer-Y-M-D-h-m-s-<activity>-<volunteer>.txt``:
    three 6-bit codes per line at 32 Hz. Subjects and trials get integer ids
    by first appearance in path order; ``*_MODEL`` folders and manuals are
    skipped. ``activity_pattern``/``volunteer_pattern`` (regex, first group,
    on the path) replace the file-name rule."""
    def parts(path):
        if activity_pattern is None:
            return paths.dashed_metadata(paths.file_name(path))
        activity, volunteer = (F.nullif(F.regexp_extract(path, p, 1), F.lit("")) for p in (activity_pattern, volunteer_pattern))
        return activity.isNotNull() & volunteer.isNotNull(), activity, volunteer

    look = {"skip_parent_suffix": "_MODEL", "skip_names": ["manual.txt", "readme.txt"], "require_suffix": ".txt"}
    scan = text.read_headerless(spark, root, 3, pattern=r"\s+|,", where=lambda p: parts(p)[0], **look)
    # everything known per file is computed on the (small) file table and
    # joined back once: name parts, trial id by path order, subject id by
    # the volunteer's first path
    _, activity, volunteer = parts(F.col("path"))
    files_t = materialize(scan.files.select("path", activity.alias("_activity"), volunteer.alias("_volunteer")), "bruno-files")
    unnamed = F.when(~parts(F.col("path"))[0], F.lit("file name has fewer than 9 parts"))
    trials = seq.global_index(files_t.select("path"), ["path"], "trial_no")
    vols = files_t.groupBy("_volunteer").agg(F.min("path").alias("_first"))
    vols = seq.global_index(vols, ["_first", "_volunteer"], "sid")
    meta = (files_t.join(trials, "path").join(vols.select("_volunteer", "sid"), "_volunteer")
            .select("path", "_activity", "trial_no", "sid"))
    rows = text.as_double(scan.rows.join(meta, "path"), ["f0", "f1", "f2"])
    out = rows.select(
        timegrid.ms_from_rate(F.col("line_no"), catalog.SAMPLING_RATE_HZ["bruno"]).alias("time_ms"),
        (F.col("sid") + 1).cast("int").alias("sid"),
        labels.map_label(F.col("_activity"), catalog.BRUNO_SURFACES, labels.IDENTITY).alias("surface"),
        (F.col("trial_no") + 1).cast("int").alias("trial_no"),
        *[units.six_bit_to_ms2(F.col(f"f{i}")).alias(n) for i, n in enumerate(catalog.BRUNO_COLUMNS)])
    return Harmonised(out, lambda: scan.rejects.unionByName(_whole_files(text.list_files(spark, root, **look), unnamed)))


# ---------------------------------------------------------------- E3 karas

def harmonise_karas(spark: SparkSession, root: str, subject_pattern: str | None = None,
                    columns: list[str] | None = None, time_mode: str = "truncate") -> Harmonised:
    """``**/<sid>.csv``: headed CSV, already wide; ``activity`` code, ``time_s``
    seconds and accelerations in g under any names. No grid (as published).
    ``subject_pattern`` (regex, first group, on the path) replaces the file
    stem as subject id; ``columns`` fixes the header names to output
    (default: every name found in the headers); ``time_mode`` is that of
    :func:`timegrid.seconds_to_ms`."""
    scan = text.read_headed(spark, root, columns=columns, glob="*.csv", recursive=True,
                            strip=False, skip_initial_space=False)
    rows = scan.rows
    accel = [c for c in rows.columns if c not in ("path", "name", "line_no", "activity", "time_s")]
    rows = text.as_double(rows, ["time_s", *accel])
    out = rows.select(
        timegrid.seconds_to_ms(F.col("time_s"), time_mode).alias("time_ms"),
        (paths.file_stem(F.col("path")) if subject_pattern is None
         else F.regexp_extract(F.col("path"), subject_pattern, 1)).alias("sid"),
        labels.map_label(F.col("activity"), catalog.KARAS_SURFACES, labels.NULL).alias("surface"),
        *[units.g_to_ms2(F.col(c)).alias(c) for c in accel])
    return Harmonised(out, lambda: scan.rejects)


# ---------------------------------------------------------------- E2 beach

def harmonise_beach(long: DataFrame, sensors: Sequence[str] = catalog.BEACH_SENSORS, values: Sequence[str] = ("x", "y", "z"),
                    step_us: int = catalog.GRID_STEP_MS["beach"] * 1000) -> Harmonised:
    """Long readings ``(sid, sensor, datetime, x, y, z)`` (the per-subject
    sensor frames re-aimed as one table): 10 ms grid, mean per slot, eight
    sensors aligned, every slot present, g -> m/s^2, surface 'flat'."""
    long = long.toDF(*[c.strip().lower() for c in long.columns])
    data = harmonise_long(long, sid="sid", sensor="sensor", ts="datetime",
                          sensors=list(sensors), values=list(values),
                          step_us=step_us, metric="acc", surface="flat")
    return Harmonised(data, lambda: _rejects(long.sparkSession))


def harmonise_beach_folders(spark: SparkSession, root: str, subjects: Sequence[str] | DataFrame | None = None,
                            sensors: Sequence[str] = catalog.BEACH_SENSORS, values: Sequence[str] = ("x", "y", "z"),
                            step_us: int = catalog.GRID_STEP_MS["beach"] * 1000) -> Harmonised:
    """:func:`harmonise_beach` of per-subject sensor folders
    (:func:`text.read_sensor_folders`); an absent sensor is a reject of its
    folder, and its columns are null."""
    long, absent = text.read_sensor_folders(spark, root, sensors, subjects, values)
    folder = F.concat(F.lit(root.rstrip("/") + "/sid="), F.col("sid"), F.lit("/sensor="), F.col("sensor"))
    rejects = absent.select(folder.alias("path"), F.lit(None).cast("long").alias("line_no"), F.lit("absent sensor").alias("reason"))
    return Harmonised(harmonise_beach(long, sensors, values, step_us).data, lambda: rejects)


# ---------------------------------------------------------------- E1 luo

def harmonise_luo(spark: SparkSession, root: str, sids: list[int] | None = None,
                  sid_pattern: str | None = None,
                  trial_pattern: str | None = None, code_pattern: str | None = None,
                  enumerated: bool = True, columns: list[str] | None = None) -> Harmonised:
    """``<sid>/**/<trial>-...<code>.csv`` (sid 1..30): one headed CSV per
    sensor with a packet counter. Sensors of a trial are aligned on the
    counter, every packet from first to last gets a row, time is 10 ms per
    packet from the trial start. Files with an unknown sensor code and trials
    where one sensor repeats a packet are set aside in ``rejects``.

    ``sid_pattern``/``trial_pattern``/``code_pattern`` (regex, first group,
    on the path) replace the folder and file-name rules; ``enumerated``
    keeps only the subjects the layout promises (1..30); ``columns`` fixes
    the (normalised) header names to read instead of collecting them.
    """
    root = root.rstrip("/")
    lo, hi = catalog.EXPECTED_SUBJECTS["luo"]

    def part(path, pattern):
        return F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))

    def subject(path):
        return (paths.dir_below(path, root) if sid_pattern is None else part(path, sid_pattern)).try_cast("int")

    def trial(path):
        return (paths.trial_prefix(paths.file_name(path)) if trial_pattern is None else part(path, trial_pattern)).try_cast("int")

    def location(path):
        code = paths.suffix_code(paths.file_name(path)) if code_pattern is None else part(path, code_pattern)
        return labels.map_label(code, catalog.LUO_SENSOR_CODES, labels.NULL)

    def reason(path):
        out = F.when(subject(path).isNull(), F.lit("no subject number"))
        if enumerated:
            out = out.when(_outside(subject(path), lo, hi), F.lit("subject outside the layout's range"))
        return (out.when(trial(path).isNull(), F.lit("no trial number"))
                .when(location(path).isNull(), F.lit("unknown sensor code")))

    def asked(path):
        return subject(path).isin(list(sids)) if sids is not None else F.lit(True)

    look = {"glob": "*.csv", "recursive": True}
    scan = text.read_headed(spark, root, columns=columns, strip=True, skip_initial_space=True,
                            where=lambda p: reason(p).isNull() & asked(p), **look)
    at = F.col("path")
    rows = scan.rows.withColumns({"sid": subject(at), "trial_no": trial(at), "loc": location(at)})
    metrics = [c for c in rows.columns
               if c not in ("path", "name", "line_no", "sid", "trial_no", "loc", "packetcounter",
                            "sampletimefine")]
    rows = text.as_double(rows, metrics).withColumn(
        "packetcounter", units.coerce_numeric(F.col("packetcounter")).cast("long"))
    unread = (rows.filter(F.col("packetcounter").isNull())
              .select("path", "line_no", F.lit("unreadable packet counter").alias("reason")))
    rows = rows.filter(F.col("packetcounter").isNotNull())
    keys = ["sid", "trial_no"]
    locations = list(dict.fromkeys(catalog.LUO_SENSOR_CODES.values()))
    wide, dups = align.widen_or_set_aside(rows, keys, "packetcounter", "loc", locations, metrics,
                                          name=lambda s, v: f"{s}_{v}")

    def rejects():
        listed = text.list_files(spark, root, **look).where(asked(at) | subject(at).isNull())
        repeats = (listed.where(reason(at).isNull()).select("path", subject(at).alias("sid"), trial(at).alias("trial_no"))
                   .join(dups, keys).select("path", F.lit(None).cast("long").alias("line_no"),
                                            F.lit("sensor repeats a packet in its trial").alias("reason")))
        return scan.rejects.unionByName(unread).unionByName(_whole_files(listed, reason(at))).unionByName(repeats)

    filled = timeline.fill_grid(wide, keys, "packetcounter", 1, anchor="epoch",
                                start_out="_p0")
    surface = labels.map_label(F.col("trial_no"), labels.expand_lists(catalog.LUO_TRIAL_SURFACES),
                               "unknown")
    out = filled.withColumns({
        "time_ms": (F.col("packetcounter") - F.col("_p0")) * F.lit(catalog.GRID_STEP_MS["luo"]),
        "surface": surface,
    }).drop("_p0")
    sensor_cols = [f"{s}_{v}" for s in locations for v in metrics]
    out = out.select("time_ms", "sid", "surface", "trial_no", "packetcounter", *sensor_cols)
    return Harmonised(out, rejects)


def append_luo_subjects(spark: SparkSession, root: str, sids: list[int], target: str,
                        fmt: str = "parquet", replace: bool = False) -> DataFrame:
    """Harmonise only ``sids`` and append them to an existing luo output,
    matching its columns (missing -> null, extra dropped). With ``replace`` the
    subjects' earlier rows go, so the append may be repeated."""
    add = sinks.replace_subjects if replace else sinks.append_aligned
    return add(harmonise_luo(spark, root, sids=sids).data, target, fmt)


# ---------------------------------------------------------------- reports and dispatch

def trial_manifest(rows: DataFrame, keys=("sid", "trial_no")) -> DataFrame:
    """The files of every (subject, trial). A trial has one file per
    sensor, so each collected set is bounded by the sensor count."""
    return rows.groupBy(*keys).agg(F.sort_array(F.collect_set("path")).alias("files"),
                                   F.count_distinct("path").alias("n_files"))


def run_totals(data: DataFrame, rows_read: DataFrame | None = None) -> DataFrame:
    """One row with the number of subjects, trials (when present), rows
    and, given the parsed lines, files."""
    aggs = [F.count_distinct("sid").alias("subjects"), F.count(F.lit(1)).alias("rows")]
    if "trial_no" in data.columns:
        aggs.insert(1, F.count_distinct("sid", "trial_no").alias("trials"))
    out = data.agg(*aggs)
    if rows_read is not None:  # two single rows made one
        out = out.unionByName(rows_read.agg(F.count_distinct("path").alias("files")), allowMissingColumns=True)
        out = out.agg(*[F.max(c).alias(c) for c in out.columns])
    return out


def harmonise(name: str, spark: SparkSession, source) -> Harmonised:
    """Run the flow of dataset ``name`` (``source`` is a root folder, or
    the long table for 'beach')."""
    flows = {
        "luo": harmonise_luo, "karas": harmonise_karas, "bruno": harmonise_bruno,
        "hugadb": harmonise_hugadb, "mhealth": harmonise_mhealth,
    }
    if name == "beach":
        return harmonise_beach(source)
    if name not in flows:
        raise ValueError(f"unknown dataset {name!r}; known: {sorted([*flows, 'beach'])}")
    return flows[name](spark, source)

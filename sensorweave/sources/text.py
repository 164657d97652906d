"""Readers for the raw text layouts of wearable-sensor studies.

Every reader scans all matching files in one distributed text scan and
returns one row per kept data line with ``path`` (the file, the recording
key), ``line_no`` (0-based position among the file's kept lines, the source
order) and the parsed fields. Large files are split by the scan; the scanned
lines are written once with their row ids, and positions come from those ids and
a summary of one row per split of the same table, so a huge file never becomes
one task, lines are only shuffled where lines before them were set aside, and
neither another layout of the scan nor a file that grows can shift a number.

What breaks the layout is not silently dropped: each reader returns lines as
``(path, line_no, reason)`` in ``Scan.rejects``, and whole files (empty, only a
header, unreadable, not UTF-8) with a null ``line_no``. One broken file costs
its own rows only.
"""

from __future__ import annotations

import bz2
import os
import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorweave.functions import paths, units
from sensorweave.session import materialize

#: Splits (about 40 bytes each) whose summary is broadcast; more are joined.
BROADCAST_SPLITS = 500_000


#: Lines that a quoted field may spread over; a longer record is set aside.
MAX_RECORD_LINES = 100_000
#: File names whose content is packed, by how Python unpacks it piece by piece.
UNPACKERS: dict[str, Callable] = {".gz": lambda: zlib.decompressobj(31), ".deflate": zlib.decompressobj, ".bz2": bz2.BZ2Decompressor}
UNPACKED_BYTES = 4 << 20

#: How written lines are packed: they are the largest intermediate table.
LINES_CODEC = "zstd"

EMPTY, NO_LINES, NO_DATA = "empty file", "no lines in the file", "header without data"
UNREADABLE, NOT_UTF8, LONG_HEADER = "unreadable file", "not valid UTF-8", "header over several lines"
OPEN_QUOTE, LONG_RECORD = "quote not closed", "record of too many lines"


@dataclass
class Scan:
    """Parsed lines, what was set aside with a reason, and the files that rows
    can come from (``path``). The files are listed for ``rejects`` only when it
    is asked for: with many files each listing takes its time."""
    rows: DataFrame
    set_aside: Callable[[], DataFrame]
    files: DataFrame | None = None

    @cached_property
    def rejects(self) -> DataFrame:
        return self.set_aside()


def _reader(spark: SparkSession, glob: str | None, recursive: bool, tolerant: bool = False):
    reader = spark.read.option("ignoreCorruptFiles", tolerant).option("ignoreMissingFiles", tolerant)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", glob) if glob else reader


def _path_rule(path: Column, skip_parent_suffix: str | None, skip_names: Sequence[str], require_suffix: str | None) -> Column:
    name = paths.file_name(path)
    rule = F.lit(True)
    if skip_parent_suffix:
        rule = rule & ~F.coalesce(paths.parent_dir(path).endswith(skip_parent_suffix), F.lit(False))
    if skip_names:
        rule = rule & ~F.lower(name).isin([n.lower() for n in skip_names])
    return rule & name.endswith(require_suffix) if require_suffix else rule


def list_files(spark: SparkSession, root: str | Sequence[str], glob: str | None = None, recursive: bool = True,
               skip_parent_suffix: str | None = None, skip_names: Sequence[str] = (),
               require_suffix: str | None = None) -> DataFrame:
    """``(path)`` of the matching files; no file is opened."""
    found = _reader(spark, glob, recursive).format("binaryFile").load(root)
    path = paths.decoded_path(F.col("_metadata.file_path")).alias("path")
    return found.select(path).where(_path_rule(F.col("path"), skip_parent_suffix, skip_names, require_suffix))


def scan_lines(spark: SparkSession, root: str | Sequence[str], glob: str | None = None, recursive: bool = True,
               skip_parent_suffix: str | None = None, skip_names: Sequence[str] = (),
               require_suffix: str | None = None, where: Callable[[Column], Column] | None = None,
               blank: bool = False, tolerant: bool = False, look_first: bool = False) -> DataFrame:
    """Lines of the matching files, ``blank`` ones only when asked for:
    ``(path, _block, line)``.

    ``glob`` filters file names (``pathGlobFilter``); ``skip_parent_suffix``
    drops files whose directory name ends with it (e.g. ``_MODEL``);
    ``skip_names`` drops names compared lower-cased; ``require_suffix`` keeps
    only names ending with it (case-sensitive); ``where`` is any further rule
    on the path. All are rules on the file path alone, which the scan applies
    to its file list before it opens a file. ``root`` may also be a list of
    files (the changed ones). A file that can't be read ends the
    scan unless ``tolerant``, which leaves out the rest of that file. Spark asks
    the rules again for every line; with ``look_first`` they are left away where
    no file breaks them.
    """
    df = _reader(spark, glob, recursive, tolerant).text(root)
    path = paths.decoded_path(F.col("_metadata.file_path"))
    rule = _path_rule(path, skip_parent_suffix, skip_names, require_suffix)
    rule = rule & where(path) if where else rule
    asked = bool(skip_parent_suffix or skip_names or require_suffix or where)
    if asked and not (look_first and _keeps_all(df, rule)):
        df = df.where(rule)
    lines = df.select(path.alias("path"), F.col("_metadata.file_block_start").alias("_block"), F.col("value").alias("line"))
    return lines if blank else lines.where(F.trim("line") != "")


def _keeps_all(df: DataFrame, rule: Column) -> bool:
    """Whether a rule on the path keeps every line of a scan. The scan applies the
    opposite rule to its file list: without a file that breaks it, none is opened."""
    try:
        return df.where(~F.coalesce(rule, F.lit(False))).isEmpty()
    except Exception as failed:  # a file that breaks the rule, and can't be read either
        if "FAILED_READ_FILE" not in str(failed):
            raise
        return False


def _with_name(df: DataFrame) -> DataFrame:
    return df.withColumn("name", paths.file_name(F.col("path")))


# ---------------------------------------------------------------- one written scan

@dataclass
class _Lines:
    """A written scan: lines with their row ids, and the paths (``path``) of
    files that could not be read to their end."""
    table: DataFrame
    broken: DataFrame


KEY = ["_task", "_file", "_block"]


def _write_scan(spark: SparkSession, root: str | Sequence[str], prepare: Callable[[DataFrame], DataFrame], blank: bool = False, **scan) -> _Lines:
    """Write the lines of one scan, with what ``prepare`` adds to them. A scan
    task reads whole splits one after another, so the ids of a split's lines run
    on without a gap.

    Where a file can't be read, the scan is done once more without the rest of
    such files, and they are looked for."""
    def lines(tolerant: bool) -> DataFrame:
        found = scan_lines(spark, root, blank=blank, tolerant=tolerant, look_first=True, **scan).withColumn("_utf8", F.is_valid_utf8("line"))
        return prepare(found).withColumn("_id", F.monotonically_increasing_id())

    def written(tolerant: bool) -> DataFrame:  # what follows from other columns is not stored
        return materialize(lines(tolerant), "lines", None, LINES_CODEC).withColumns({"_task": F.shiftright("_id", 33), "_file": F.xxhash64("path")})

    none = spark.createDataFrame([], "path string")
    try:
        return _Lines(written(False), none)
    except Exception as failed:  # the error that Spark gives a file's name to, whatever the cause
        if "FAILED_READ_FILE" not in str(failed):
            raise
    return _Lines(written(True), materialize(_broken_files(spark, root, **scan), "broken"))


def _broken_files(spark: SparkSession, root: str | Sequence[str], glob: str | None = None, recursive: bool = True,
                  where: Callable[[Column], Column] | None = None, **rules) -> DataFrame:
    """Files that can't be read to their end. A plain file is broken when the
    bytes of its lines, with two more for each line's end, don't make up its
    length; a packed one when it can't be unpacked, which is tried piece by piece."""
    read = scan_lines(spark, root, glob, recursive, blank=True, tolerant=True, where=where, **rules).groupBy("path").agg(
        F.sum(F.octet_length("line") + F.lit(2)).alias("_bytes"))
    found = _reader(spark, glob, recursive, tolerant=True).format("binaryFile").load(root)
    path = paths.decoded_path(F.col("_metadata.file_path"))  # rules on it choose the files before they are opened
    rule = _path_rule(path, rules.get("skip_parent_suffix"), rules.get("skip_names", ()), rules.get("require_suffix"))
    packed = F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1)).isin(*UNPACKERS)
    found = found.where(rule & where(path) if where else rule)
    short = (found.where(~packed).select(path.alias("path"), "length").join(read, "path", "left")
             .where(F.coalesce("_bytes", F.lit(0)) + 3 < F.col("length")).select("path"))  # a byte order mark is in no line

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = []
            for path, content in zip(batch.column("path"), batch.column("content")):
                if not _unpacks(path.as_py(), memoryview(content.as_buffer())):
                    bad.append(path.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(bad, pa.string())], ["path"])

    return short.unionByName(found.where(packed).select(path.alias("path"), "content").mapInArrow(unpack, "path string"))


def _unpacks(path: str, content: memoryview) -> bool:
    """Whether packed bytes can be unpacked to their end, a few MB at a time."""
    make = UNPACKERS[os.path.splitext(path)[1].lower()]
    try:
        while len(content):
            unpacker, fed = make(), 0
            if isinstance(unpacker, bz2.BZ2Decompressor):
                while not unpacker.eof and (fed < len(content) or not unpacker.needs_input):
                    piece = content[fed : fed + UNPACKED_BYTES] if unpacker.needs_input else b""
                    fed += len(piece)
                    unpacker.decompress(piece, UNPACKED_BYTES)
            else:
                rest = b""
                while not unpacker.eof and (fed < len(content) or rest):
                    piece = rest or content[fed : fed + UNPACKED_BYTES]
                    fed += 0 if rest else len(piece)
                    unpacker.decompress(piece, UNPACKED_BYTES)
                    rest = unpacker.unconsumed_tail
            if not unpacker.eof:
                return False
            content = content[fed - len(unpacker.unused_data) :]  # the next member, if any
            if not bytes(content[:64]).strip(b"\0"):  # padding
                break
        return True
    except (OSError, zlib.error, ValueError):
        return False


def _splits(lines: _Lines, good: str, header: bool, extra: Sequence[Column] = (), by_file: dict[str, Column] | None = None) -> DataFrame:
    """One row per (file, split) of a written scan, written as well: the first
    row id (``_at``), the ``good`` lines of the split (``_n``) and of the file's
    earlier splits (``_off``), whether all its row ids are good lines (``_clean``), and
    why the whole file is set aside, if it is (``_why``). With ``header`` also
    the file's first line (``_head``) and its row id (``_head_id``)."""
    # the path is grouped by, and the header's text is looked up afterwards: aggregates
    # of numbers alone are hashed, those of texts would sort every line
    aggs = [F.min("_id").alias("_at"), F.max("_id").alias("_to"), F.count_if(good).alias("_n"), F.count("*").alias("_all"),
            F.bool_and("_utf8").alias("_utf8"), *extra]
    if header:
        aggs += [F.min_by(good, "_id").alias("_head_good")]
    splits = lines.table.groupBy("path", *KEY).agg(*aggs)
    earlier = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    splits = splits.withColumns({"_off": F.coalesce(F.sum("_n").over(earlier), F.lit(0)), "_clean": (F.col("_n") == F.col("_all")) & (F.col("_to") - F.col("_at") + 1 == F.col("_all")),
                                 "_data": F.sum("_n").over(whole), "_whole_utf8": F.bool_and("_utf8").over(whole)})
    if header:  # it takes no place among the data lines
        taken = F.first("_head_good").over(whole).cast("long")
        splits = splits.withColumns({"_off": F.col("_off") - taken, "_data": F.col("_data") - taken, "_head_id": F.first("_at").over(whole)})
    splits = splits.withColumns({n: c.over(whole) for n, c in (by_file or {}).items()})
    splits = splits.join(lines.broken.withColumn("_broken", F.lit(True)), "path", "left")
    why = F.when(F.col("_broken"), UNREADABLE).when(~F.col("_whole_utf8"), NOT_UTF8)
    if by_file and "_head_open" in by_file:
        why = why.when(F.col("_head_open") > 0, LONG_HEADER)
    splits = materialize(splits.withColumn("_why", why), "splits")
    return _with_headers(splits, lines) if header else splits


def _with_headers(splits: DataFrame, lines: _Lines) -> DataFrame:
    """The summary with the first line of each split's file (``_head``)."""
    first = splits.where(F.col("_at") == F.col("_head_id"))
    heads = lines.table.select(*KEY, "_id", F.col("line").alias("_head")).join(_beside(first, ["_head_id"]), KEY)
    heads = heads.where(F.col("_id") == F.col("_head_id")).select("_head_id", "_head")
    return materialize(splits.join(heads, "_head_id"), "headed-splits")


def _beside(splits: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns of the summary to be joined with lines: counted, and broadcast up
    to ``BROADCAST_SPLITS`` rows."""
    side = splits.select(*KEY, *columns)
    return F.broadcast(side) if splits.count() <= BROADCAST_SPLITS else side


def _place(rows: DataFrame, splits: DataFrame, out: str = "line_no") -> DataFrame:
    """Position of good lines (joined with their split) in their file: by row
    id alone where the split holds nothing else, else counted in the split."""
    direct = rows.withColumn(out, F.col("_off") + F.col("_id") - F.col("_at"))
    if splits.where(~F.col("_clean")).isEmpty():
        return direct
    counted = F.row_number().over(Window.partitionBy(*KEY).orderBy("_id"))
    mixed = rows.where(~F.col("_clean")).withColumn(out, F.col("_off") + counted - 1)
    return direct.where(F.col("_clean")).unionByName(mixed)


def _file_rejects(spark: SparkSession, root: str | Sequence[str], splits: DataFrame, lines: _Lines, header: bool,
                  where: Callable[[Column], Column] | None = None, **look) -> DataFrame:
    """Whole files that are set aside, from the file listing and what the scan
    really gave."""
    rule = _path_rule(F.col("path"), look.get("skip_parent_suffix"), look.get("skip_names", ()), look.get("require_suffix"))
    rule = rule & where(F.col("path")) if where else rule
    listed = list_files(spark, root, **look).withColumn("_long", F.lit(True))
    # the listing has no files of length zero; the names of all files are in the scan's own file index
    names = _reader(spark, look.get("glob"), look.get("recursive", True)).text(root).inputFiles()
    every = spark.createDataFrame([(n,) for n in names], "path string").select(_index_path(F.col("path")).alias("path"))
    listed = every.join(listed, "path", "full").where(rule)
    seen = splits.groupBy("path").agg(F.first("_why").alias("_why"), F.first("_data").alias("_data"))
    seen = listed.join(seen, "path", "left").join(lines.broken.withColumn("_broken", F.lit(True)), "path", "left")
    reason = F.coalesce("_why", F.when(F.col("_long").isNull(), EMPTY).when(F.col("_broken"), UNREADABLE).when(F.col("_data").isNull(), NO_LINES))
    if header:
        reason = F.coalesce(reason, F.when(F.col("_data") == 0, NO_DATA))
    return seen.select("path", F.lit(None).cast("long").alias("line_no"), reason.alias("reason")).where("reason IS NOT NULL")


def _index_path(path: Column) -> Column:
    """A path of the file index, spelled as the other sources spell it."""
    return paths.decoded_path(F.regexp_replace(path, "^file:/+", "file:/"))


def _set_aside(rows: DataFrame, reason: str) -> DataFrame:
    line_no = F.col("line_no") if "line_no" in rows.columns else F.lit(None).cast("long")
    return rows.select("path", line_no.alias("line_no"), F.lit(reason).alias("reason"))


def split_fields(line: Column, pattern: str) -> Column:
    """Split a trimmed line on a regular expression."""
    return F.split(F.trim(line), pattern)


#: Separators that can be counted without making the fields: the pattern of one, and of what is not part of one.
COUNTED = {r"\s+": (r"\s++", r"\S"), r"\s+|,": (r"(?:\s++|,)", r"[^\s,]")}


def _fits(line: Column, pattern: str, n: int) -> Column:
    """Whether a line splits into at most ``n`` fields."""
    if pattern not in COUNTED:
        return F.size(F.split(line, pattern, -1)) <= n
    end, inside = COUNTED[pattern]
    return ~line.rlike(rf"\A{inside}*+(?:{end}{inside}*+){{{n}}}")


def split_csv(line: Column, sep: str = ",", skip_initial_space: bool = False) -> Column:
    """Fields of a delimited line; a quoted field may hold the separator and
    doubled quotes. Lines without a quote take the plain split."""
    plain = F.split(line, re.escape(sep), -1)
    blanks = "[ ]*" if skip_initial_space else ""
    end = re.escape(sep)
    field = rf'{end}{blanks}("[^"]*+(?:""[^"]*+)*+"[^{end}]*+|[^{end}]*+)'
    found = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(field), 1)
    whole = r'(?s)^"(.*)"[ \r]*\z'
    quoted = F.transform(found, lambda c: F.when(c.rlike(whole), F.replace(F.regexp_extract(c, whole, 1), F.lit('""'), F.lit('"'))).otherwise(c))
    fields = F.when(F.contains(line, F.lit('"')), quoted).otherwise(plain)
    return F.transform(fields, lambda c: F.ltrim(c)) if skip_initial_space else fields


def _fields(tok: Column, names: Sequence[str]) -> list[Column]:
    return [F.get(tok, F.lit(i)).alias(n) for i, n in enumerate(names)]


def _fixed(spark: SparkSession, root: str | Sequence[str], tokens: Callable[[Column], Column], fits: Callable[[Column], Column],
           names: Sequence[str], header: bool, prepare: Callable[[DataFrame], DataFrame] = lambda lines: lines, **scan) -> Scan:
    """Lines whose ``tokens`` are bound by position to ``names``. A line with
    more fields is set aside and takes no place; a shorter one is padded."""
    lines = _write_scan(spark, root, lambda df: prepare(df).withColumn("_good", fits(F.col("line"))), **scan)
    splits = _splits(lines, "_good", header)
    columns = ["_at", "_off", "_clean", "_why", *(["_head_id"] if header else [])]
    kept = lines.table.join(_beside(splits, columns), KEY).where("_why IS NULL")
    data = kept.where(F.col("_id") != F.col("_head_id")) if header else kept
    # the header is counted in its split like any line, and left out afterwards
    good = _place(kept.where("_good"), splits)
    good = good.where(F.col("_id") != F.col("_head_id")) if header else good

    def rejects() -> DataFrame:
        surplus = _set_aside(data.where("NOT _good"), f"more than {len(names)} fields")
        return surplus.unionByName(_file_rejects(spark, root, splits, lines, header, **scan))

    rows = _with_name(good.withColumn("_tok", tokens(F.col("line"))))
    return Scan(rows.select("path", "name", "line_no", *_fields(F.col("_tok"), names)), rejects, splits.where("_why IS NULL").select("path").distinct())


# ------------------------------------------------------------------ S3

def read_headerless(spark: SparkSession, root: str | Sequence[str], width: int, pattern: str = r"\s+|,",
                    **scan) -> Scan:
    """Headerless lines split on ``pattern`` into ``f0..f{width-1}`` (text).

    Blank lines are skipped. A line with more than ``width`` fields is a bad
    line: skipped and reported. A shorter line is padded with nulls.
    """
    return _fixed(spark, root, lambda line: split_fields(line, pattern), lambda line: _fits(F.trim(line), pattern, width),
                  [f"f{i}" for i in range(width)], False, **scan)


# ------------------------------------------------------------------ S4

def read_commented(spark: SparkSession, root: str | Sequence[str], names: Sequence[str], pattern: str = r"\s+",
                   comment: str = "#", **scan) -> Scan:
    """Whitespace-separated lines with comments and one header row.

    Text from ``comment`` to the end of a line is removed; lines left blank
    are skipped; the first remaining line of every file is its header and is
    replaced by ``names``. Data lines with more fields than ``names`` are
    reported and take no place; the others are numbered from 0.
    """
    def uncommented(lines: DataFrame) -> DataFrame:
        bare = F.regexp_replace("line", re.escape(comment) + ".*$", "")
        return lines.withColumn("line", F.when(F.contains("line", F.lit(comment)), bare).otherwise(F.col("line"))).where(F.trim("line") != "")

    return _fixed(spark, root, lambda line: split_fields(line, pattern), lambda line: _fits(F.trim(line), pattern, len(names)),
                  list(names), True, uncommented, **scan)


# ------------------------------------------------------------------ S5

def read_delimited(spark: SparkSession, root: str | Sequence[str], names: Sequence[str], sep: str = "\t",
                   **scan) -> Scan:
    """Headerless delimited lines with fixed ``names`` (text fields)."""
    return _fixed(spark, root, lambda line: F.split(line, re.escape(sep), -1), lambda line: _fits(line, re.escape(sep), len(names)),
                  list(names), False, **scan)


# ------------------------------------------------------------------ S1 / S2

def _clean(name: Column, strip: bool) -> Column:
    return F.lower(F.trim(name) if strip else name)


def _quote_states(line: Column, sep: str, skip_initial_space: bool) -> tuple[Column, Column]:
    """Whether a quoted field is open after a line (1 or 0), had none been open
    before it, and had one been. A quote opens a field only as its first
    character (after blanks with ``skip_initial_space``)."""
    end, blanks = re.escape(sep), "[ ]*+" if skip_initial_space else ""
    inside = r'[^"]*+(?:""[^"]*+)*+'
    fields = rf'(?:(?:{blanks}"{inside}"[^{end}]*+|(?!{blanks}")[^{end}]*+){end})*+'
    opens = rf'{fields}{blanks}"{inside}\z'
    quoted = F.contains(line, F.lit('"'))
    return ((quoted & line.rlike(rf"\A{opens}")).cast("int"),
            (~quoted | line.rlike(rf'\A{inside}(?:\z|"[^{end}]*+{end}{opens})')).cast("int"))


def _composed(changes: Column, const: Column, start: Column | int) -> Column:
    """State after steps that set it (the last one: ``const`` with the number
    of changes up to it) or change it (``changes`` in all)."""
    since = (F.coalesce(changes, F.lit(0)) - F.coalesce(const["f"], F.lit(0))) % 2
    first = F.coalesce(const["v"], start if isinstance(start, Column) else F.lit(start))
    return first.bitwiseXOR(since.cast("int"))


def _mark_records(lines: DataFrame) -> DataFrame:
    """Lines with ``_before`` and ``_after``: whether a quoted field is open
    there (0 or 1).

    A line sets, changes or keeps that state. Steps are composed inside each
    split, then over the splits of a file (one row each), and the state at the
    start of a split is handed back to its lines."""
    w = Window.partitionBy(*KEY).orderBy("_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    changes = F.sum(F.when((F.col("_out") == 1) & (F.col("_in") == 0), 1).otherwise(0))
    marked = lines.withColumn("_changes", changes.over(w))
    const = F.last(F.when(F.col("_out") == F.col("_in"), F.struct(F.col("_out").alias("v"), F.col("_changes").alias("f"))), True)
    marked = materialize(marked.withColumn("_const", const.over(w)), "quote-states")
    last = marked.groupBy(*KEY).agg(F.first("path").alias("path"), F.max_by(F.struct("_changes", "_const"), "_id").alias("_last"))
    sets = F.col("_last._const").isNotNull()
    last = last.withColumns({"_v": F.when(sets, _composed(F.col("_last._changes"), F.col("_last._const"), 0)),
                             "_flip": F.when(sets, 0).otherwise(F.col("_last._changes") % 2)})
    file = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = last.withColumn("_flips", F.sum("_flip").over(file))
    last = last.withColumn("_set", F.last(F.when(F.col("_v").isNotNull(), F.struct(F.col("_v").alias("v"), F.col("_flips").alias("f"))), True).over(file))
    last = last.withColumn("_start", F.lag(_composed(F.col("_flips"), F.col("_set"), 0), 1, 0).over(Window.partitionBy("path").orderBy("_block")))
    rows = marked.join(_beside(materialize(last.select(*KEY, "_start"), "split-states"), ["_start"]), KEY)
    back = Window.partitionBy(*KEY).orderBy("_id")
    rows = rows.withColumn("_before", _composed(F.lag("_changes").over(back), F.lag("_const").over(back), F.col("_start")))
    return rows.withColumn("_after", F.when(F.col("_before") == 0, F.col("_out")).otherwise(F.col("_in"))).drop("_changes", "_const", "_start")


def read_headed(spark: SparkSession, root: str | Sequence[str], columns: Sequence[str] | None = None,
                sep: str = ",", strip: bool = True, skip_initial_space: bool = True,
                max_record_lines: int = MAX_RECORD_LINES, **scan) -> Scan:
    """Headed delimited files whose headers may differ in order and presence.

    The first non-blank line of each file is its header (names lower-cased,
    and trimmed when ``strip``). Every data field is bound to the name at its
    position in *its own file's* header, so files with reordered columns line
    up by name: the places of the output names are looked up once per file and
    travel with the split summary. ``columns`` fixes the output names (default:
    every header name seen). Names missing from a file are null there. A record
    with more fields than its header is skipped and reported; a shorter one is
    padded. ``line_no`` counts all non-blank data records.

    A quoted field may hold line ends (read as ``\\n``) and so spread a record
    over several lines, wherever the scan splits the file. Only then are lines
    shuffled: those of such records, to be joined. A quote that is never closed
    sets its record aside (with the rest of the file, which belongs to it), as
    does a record of more than ``max_record_lines`` lines.
    """
    out, in_ = _quote_states(F.col("line"), sep, skip_initial_space)
    states = {"_out": out, "_in": in_, "_good": F.trim("line") != ""}
    lines = _write_scan(spark, root, lambda df: df.withColumns(states), **scan)
    opened = [F.max("_out").alias("_opens"), F.min_by("_out", "_id").alias("_head_out")]
    over_file = {"_head_open": F.first("_head_out")}
    splits = _splits(lines, "_good", True, opened, over_file)
    spread = not splits.where(F.col("_opens") > 0).isEmpty()
    if spread:  # once more with blank lines, which may be part of a field
        lines = _write_scan(spark, root, lambda df: df.withColumns(states), blank=True, **scan)
        files = splits.where(F.col("_opens") > 0).select("path").distinct()
        others = lines.table.join(files, "path", "left_anti").withColumns({"_before": F.lit(0), "_after": F.lit(0)})
        records = _mark_records(lines.table.join(files, "path", "left_semi")).unionByName(others)
        # blank lines outside quotes are no records
        records = records.withColumn("_good", F.col("_good") & (F.col("_before") == 0)).where(F.col("_good") | (F.col("_before") == 1))
        lines = _Lines(materialize(records, "records"), lines.broken)
        last = [*opened, F.max_by("_after", "_id").alias("_open_after")]
        splits = _splits(lines, "_good", True, last, {**over_file, "_open_end": F.last("_open_after")})
    heads = splits.withColumn("_hdr", F.transform(split_csv(F.col("_head"), sep, skip_initial_space), lambda c: _clean(c, strip)))
    if columns is None:  # a small result: the distinct names, in the order first seen
        seen = (heads.where("_why IS NULL").select("path", F.posexplode("_hdr").alias("pos", "col")).where("col <> ''")
                .groupBy("col").agg(F.min(F.struct("path", "pos")).alias("first")).orderBy("first").select("col"))
        columns = [r[0] for r in seen.collect()]
    places = F.array(*[F.array_position("_hdr", F.lit(n)).cast("int") for n in columns]).cast("array<int>")
    heads = heads.withColumn("_at_field", places).withColumn("_width", F.size("_hdr"))
    beside = ["_at", "_off", "_clean", "_why", "_head_id", "_at_field", "_width"]
    if spread:
        data, records = _joined_records(lines, heads, beside, max_record_lines)
    else:
        data = _place(lines.table.join(_beside(heads, beside), KEY).where("_why IS NULL"), splits)
        data, records = data.where(F.col("_id") != F.col("_head_id")), None
    data = _with_name(data.withColumn("_tok", split_csv(F.col("line"), sep, skip_initial_space)).drop("line"))
    good = F.size("_tok") <= F.col("_width")
    fields = [F.get("_tok", F.col("_at_field")[i] - 1).alias(n) for i, n in enumerate(columns)]

    def rejects() -> DataFrame:
        surplus = _set_aside(data.where(~good), "more fields than header").unionByName(_file_rejects(spark, root, splits, lines, True, **scan))
        return surplus.unionByName(records) if records is not None else surplus

    return Scan(data.where(good).select("path", "name", "line_no", *fields), rejects, splits.where("_why IS NULL").select("path").distinct())


def _joined_records(lines: _Lines, splits: DataFrame, beside: list[str], max_lines: int) -> tuple[DataFrame, DataFrame]:
    """Records in one row each, and those set aside. The lines of a record that
    spreads have the number of its first line; only they are grouped."""
    kept = lines.table.join(_beside(splits, [*beside, "_data", "_open_end"]), KEY).where("_why IS NULL")
    so_far = F.sum(F.col("_good").cast("int")).over(Window.partitionBy(*KEY).orderBy("_id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    mixed = kept.where(~F.col("_clean")).withColumn("line_no", F.col("_off") + so_far - 1)
    rows = kept.where("_clean").withColumn("line_no", F.col("_off") + F.col("_id") - F.col("_at")).unionByName(mixed)
    rows = rows.where(F.col("line_no") >= 0)  # the header is number -1
    whole = (F.col("_before") == 0) & (F.col("_after") == 0)
    endless = (F.col("_open_end") == 1) & (F.col("line_no") == F.col("_data") - 1)
    parts = rows.where(~whole & ~endless)
    of = Window.partitionBy("path", "line_no")
    parts = parts.withColumn("_lines", F.count("*").over(of))
    long = parts.where((F.col("_lines") > max_lines) & (F.col("_before") == 0))
    fixed = ["_at_field", "_width"]
    joined = (parts.where(F.col("_lines") <= max_lines).groupBy("path", "line_no")
              .agg(F.sort_array(F.collect_list(F.struct("_block", "_id", "line"))).alias("_parts"), *[F.first(c).alias(c) for c in fixed])
              .withColumn("line", F.array_join(F.col("_parts.line"), "\n")))
    wanted = ["path", "line_no", "line", *fixed]
    rejects = _set_aside(rows.where(endless & (F.col("_before") == 0)), OPEN_QUOTE).unionByName(_set_aside(long, LONG_RECORD))
    return rows.where(whole).select(*wanted).unionByName(joined.select(*wanted)), rejects


#: Columns that are coerced by one expression each; the code that Spark makes of
#: more is too long for the JVM to compile, so they go through one array.
COERCED_ALONE = 8


def as_double(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Coerce text fields to double (non-numbers become null)."""
    names = list(names)
    if len(names) <= COERCED_ALONE:
        return df.withColumns({n: units.coerce_numeric(F.col(n)) for n in names})
    cells = F.array(*[F.col(n).cast("string") for n in names])
    # cells without letters need no look at suffixes, digits or NaN: the array is cast as one
    lettered = F.concat_ws("", cells).rlike("[DdFfNnXx]")
    df = df.withColumn("_numbers", F.when(lettered, F.transform(cells, units.coerce_numeric)).otherwise(cells.try_cast("array<double>")))
    return df.withColumns({n: F.get("_numbers", F.lit(i)) for i, n in enumerate(names)}).drop("_numbers")


# ------------------------------------------------------------------ S6

def read_long(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Long sensor readings ``(sid, sensor, datetime, x, y, z)`` (the re-aimed
    per-subject sensor frames), names stripped and lower-cased."""
    df = spark.read.format(fmt).options(**options).load(path)
    return df.toDF(*[c.strip().lower() for c in df.columns])


def read_sensor_folders(spark: SparkSession, root: str, sensors: Sequence[str], subjects: Sequence[str] | DataFrame | None = None,
                        values: Sequence[str] = ("x", "y", "z")) -> tuple[DataFrame, DataFrame]:
    """Per-subject sensor files below ``root/sid=<id>/sensor=<name>/`` (Parquet)
    as one long table ``(sid, sensor, datetime, values...)``, and the absent
    sensors ``(sid, sensor)`` of the subjects that have a folder.

    Ids are text, as the folders spell them. Files may lack columns or have
    others beside: their schemas are merged, names are compared stripped and
    lower-cased, and a value that no file has is null. ``subjects`` restricts
    the read before a file is opened: a list to the folders named in it, a table
    (with ``sid``) through a join by which Spark prunes folders at run time."""
    # one listing gives the schema and the rows: folder names stay text unless Spark guesses types from them
    guess = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(guess)
    spark.conf.set(guess, "false")
    try:
        rows = spark.read.option("mergeSchema", "true").parquet(root)
    finally:
        spark.conf.set(guess, before)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    path = paths.decoded_path(F.col("_metadata.file_path"))
    found = listed.select(*[F.regexp_extract(path, f"/{k}=([^/]*)/", 1).alias(k) for k in ("sid", "sensor")]).distinct()
    if isinstance(subjects, DataFrame):
        # a comparison on the wanted side is what makes Spark prune by it
        wanted = subjects.select(F.col("sid").cast("string").alias("sid")).where(F.col("sid") > "").distinct()
        rows, found = rows.join(wanted, "sid", "left_semi"), found.join(wanted, "sid", "left_semi")
    elif subjects is not None:
        texts = [str(s) for s in subjects]
        rows, found = rows.where(F.col("sid").isin(texts)), found.where(F.col("sid").isin(texts))
    expected = found.select("sid").distinct().withColumn("sensor", F.explode(F.array(*[F.lit(s) for s in sensors])))
    absent = expected.join(found, ["sid", "sensor"], "left_anti")
    # several spellings of a column in different files are one column
    spelled: dict[str, list[str]] = {}
    for name in rows.columns:
        spelled.setdefault(name.strip().lower(), []).append(name)
    wanted_columns = ["sid", "sensor", "datetime", *values]
    long = rows.select(*[F.coalesce(*[F.col(f"`{c}`") for c in spelled[n]]).alias(n) if n in spelled else F.lit(None).cast("double").alias(n)
                         for n in wanted_columns])
    return long.where(F.col("sensor").isin(list(sensors))), absent

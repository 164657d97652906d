"""Deletion of repeated runs of lines by a suffix array over line numbers.

Texts become sequences of line ranks (blank lines left out). Prefix doubling
ranks the suffixes by their first 1, 2, 4, ... lines: a round sorts the pairs
(rank here, rank 2^k lines on) over all partitions and numbers them in order.
Suffixes whose first lines occur nowhere else stand alone and drop out, as do
stretches of repeated lines that are too short together to hold a run, so the
rounds work on repeated text only. Suffixes that agree over their first n lines
form an interval of the suffix array whose longest common prefix is at least n;
such an interval is told by the ranks of the two stretches of 2^k lines that
cover n. For every line the shortest stretch of ``min_words`` words from it and
up to it is looked up: where the interval has an earlier member, the stretch is
a later copy. Stretches that touch make up the maximal repeated runs.

"Earlier" goes by id, then line. The first copy of a run always stays.

Defined cases: null texts stay null, empty and blank ones stay as they are; an
id that is null comes after all others; rows equal in id and text are one
document and get one result; rows of one id with other texts are told apart by
a hash of the text; blank lines inside a deleted run go with it; an empty table
gives an empty result; other columns pass through, clashing names included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorweave.llm.common import stored

#: Words that a repeated run has at least.
MIN_WORDS = 50
_DOC = ["id", "text_hash"]
_WORD = r"[^\x20\x09-\x0D]+"


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every line with a word: document key, number among such lines, number
    among all lines, two hashes of the line, and its words."""
    text = F.col(text_col).cast("string")
    lines = F.filter(F.transform(F.split("text", "\n", -1), lambda s, i: F.struct(i.alias("line_no"), s.alias("line"))),
                     lambda x: x["line"].rlike(_WORD))
    return (docs.select(F.col(id_col).alias("id"), text.alias("text")).where("text is not null")
            .select("id", F.xxhash64("text").alias("text_hash"), F.posexplode(lines).alias("at", "x"))
            .select(*_DOC, "at", "x.line_no", F.xxhash64("x.line").alias("a"), F.hash("x.line").alias("b"),
                    F.regexp_count("x.line", F.lit(_WORD)).alias("words")))


def _place() -> Column:
    """Where a line stands in the corpus, as something that can be ordered."""
    return F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("text_hash"), F.col("at"))


def _ranked(groups: DataFrame, keys: list[str], rank: str, name: str) -> DataFrame:
    """Rows of ``groups`` that stand for several suffixes, numbered in order."""
    several = groups.where("n > 1").select(*keys)
    return stored(several.orderBy(*keys).withColumn(rank, F.monotonically_increasing_id()), name)


def repeated_stretches(lines: DataFrame, min_words: int) -> DataFrame:
    """Lines that occur more than once, where neighbouring ones hold at least
    ``min_words`` words together, with the shortest such stretches from
    (``ahead``) and up to (``back``) each, in lines; 0: there is none."""
    ranks = _ranked(lines.groupBy("a", "b").agg(F.count("*").alias("n")), ["a", "b"], "r0", "line-ranks")
    common = lines.join(ranks, ["a", "b"]).select(*_DOC, "at", "line_no", "words", "r0").dropDuplicates([*_DOC, "at"])
    in_doc = Window.partitionBy(*_DOC).orderBy("at")
    isle = Window.partitionBy(*_DOC, "isle")
    common = common.withColumn("isle", F.col("at") - F.row_number().over(in_doc))
    common = common.withColumn("isle_words", F.sum("words").over(isle)).where(F.col("isle_words") >= min_words)
    common = (common.withColumn("upto", F.sum("words").over(isle.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("before", F.col("upto") - F.col("words")))
    # with every line holding a word, the running sums order the lines and measure the stretches
    ahead = isle.orderBy("before").rangeBetween(0, min_words - 1)
    back = isle.orderBy("upto").rangeBetween(-(min_words - 1), 0)
    common = (common.withColumn("ahead", F.when(F.max("upto").over(ahead) - F.col("before") >= min_words, F.count("*").over(ahead)).otherwise(0))
              .withColumn("back", F.when(F.col("upto") - F.min("before").over(back) >= min_words, F.count("*").over(back)).otherwise(0)))
    return stored(common.select(*_DOC, "isle", "at", "line_no", F.array("r0").alias("ranks"), "ahead", "back"), "stretches")


def double_prefixes(suffixes: DataFrame, longest: int) -> DataFrame:
    """``ranks[k]`` of every suffix: the order of its first 2^k lines among
    those that occur more than once (null: they don't), for 2^k <= longest."""
    k = 0
    while 2 ** (k + 1) <= longest:
        here, there = F.col("ranks")[k], F.lead(F.col("ranks")[k], 2**k).over(Window.partitionBy(*_DOC, "isle").orderBy("at"))
        pairs = suffixes.withColumn("here", here).withColumn("there", there)
        groups = pairs.where("here is not null and there is not null").groupBy("here", "there").agg(F.count("*").alias("n"))
        ranks = _ranked(groups, ["here", "there"], "next", "suffix-ranks")
        suffixes = stored(pairs.join(ranks, ["here", "there"], "left").withColumn("ranks", F.concat("ranks", F.array("next")))
                          .drop("here", "there", "next"), "suffixes")
        k += 1
    return suffixes


def later_copies(suffixes: DataFrame) -> DataFrame:
    """``(id, text_hash, first_line, last_line)`` of stretches that repeat an
    earlier one, in numbers of all lines."""
    k = F.floor(F.log2(F.col("n").cast("double")) + 1e-9).cast("int")
    stretch = (suffixes.where("ahead > 0").select(*_DOC, "at", F.col("ahead").alias("n"))
               .union(suffixes.where("back > 0").select(*_DOC, (F.col("at") - F.col("back") + 1).cast("int"), "back")).distinct()
               .withColumn("k", k).withColumn("half", (F.col("at") + F.col("n") - F.pow(F.lit(2), F.col("k"))).cast("int"))
               .withColumn("end", (F.col("at") + F.col("n") - 1).cast("int")))
    head = suffixes.select(*_DOC, "at", F.col("ranks").alias("head"), F.col("line_no").alias("first_line"))
    tail = suffixes.select(*_DOC, F.col("at").alias("half"), F.col("ranks").alias("tail"))
    last = suffixes.select(*_DOC, F.col("at").alias("end"), F.col("line_no").alias("last_line"))

    def same_doc(other: DataFrame, col: str):
        return lambda left: left.join(other.withColumnsRenamed({"id": "__id", "text_hash": "__h"}), F.col("id").eqNullSafe(F.col("__id"))
                                      & (F.col("text_hash") == F.col("__h")) & (left[col] == other[col])).drop("__id", "__h", other[col])

    stretch = stretch.transform(same_doc(head, "at")).withColumn("head", F.get("head", "k")).where("head is not null")
    stretch = stretch.transform(same_doc(tail, "half")).withColumn("tail", F.get("tail", "k")).where("tail is not null")
    stretch = stored(stretch.transform(same_doc(last, "end")).select(*_DOC, "at", "n", "head", "tail", "first_line", "last_line"), "intervals")
    interval = ["n", "head", "tail"]
    first = stretch.groupBy(*interval).agg(F.min(_place()).alias("first"), F.count("*").alias("members")).where("members > 1").drop("members")
    return stretch.join(first, interval).where(_place() > F.col("first")).select(*_DOC, "first_line", "last_line")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Maximal runs of lines that are later copies, ``(id, text_hash, runs)``
    with an array of ``(first_line, last_line)`` per document that has any."""
    suffixes = repeated_stretches(stored(line_table(docs, id_col, text_col), "lines"), min_words)
    longest = suffixes.agg(F.max(F.greatest("ahead", "back"))).first()[0] or 0
    copies = later_copies(double_prefixes(suffixes, longest))
    in_doc = Window.partitionBy(*_DOC).orderBy("first_line", "last_line")
    reach = F.max("last_line").over(in_doc.rowsBetween(Window.unboundedPreceding, -1))
    runs = (copies.distinct().withColumn("opens", F.coalesce((F.col("first_line") > reach + 1).cast("int"), F.lit(0)))
            .withColumn("run", F.sum("opens").over(in_doc.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy(*_DOC, "run").agg(F.min("first_line").alias("first_line"), F.max("last_line").alias("last_line")))
    return runs.groupBy(*_DOC).agg(F.sort_array(F.collect_list(F.struct("first_line", "last_line"))).alias("runs"))


def without_runs(text: Column, runs: Column) -> Column:
    """``text`` less its lines in ``runs`` (ordered, apart from each other)."""
    lines = F.split(text, "\n", -1)
    begin = lambda i: F.coalesce(F.get(runs, i - 1)["last_line"] + 1, F.lit(0))
    kept = F.transform(runs, lambda r, i: F.slice(lines, begin(i) + 1, r["first_line"] - begin(i)))
    rest = F.element_at(runs, -1)["last_line"] + 1
    return F.array_join(F.concat(F.flatten(kept), F.slice(lines, rest + 1, F.size(lines) - rest)), "\n")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Rows ``(row, text, runs, n_lines, n_deleted)``: ``row`` holds the input's
    columns, ``text`` what stays of the text, ``runs`` the runs deleted."""
    runs = repeated_runs(docs, id_col, text_col, min_words).withColumnsRenamed({"id": "__id", "text_hash": "__h"})
    text = F.col("__text")
    boxed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].alias("__key"), docs[text_col].cast("string").alias("__text"))
    boxed = boxed.withColumn("__hash", F.xxhash64("__text"))
    joined = boxed.join(runs, F.col("__key").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__h")), "left")
    deleted = F.aggregate("runs", F.lit(0), lambda n, r: n + r["last_line"] - r["first_line"] + 1)
    return joined.select(
        "row", F.when(F.col("runs").isNull(), text).otherwise(without_runs(text, F.col("runs"))).alias("text"), "runs",
        F.coalesce(F.size(F.split(text, "\n", -1)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(deleted, F.lit(0)).cast("long").alias("n_deleted"))


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies deleted from the texts; rows of which nothing
    but blank lines is left after that are dropped."""
    done = dedup_lines(docs, id_col, text_col, min_words).where(F.col("runs").isNull() | F.col("text").rlike(_WORD))
    return done.select(*[(F.col("text") if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])

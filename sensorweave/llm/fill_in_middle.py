"""Fill-in-middle rearrangement of whole texts, cut at line ends.

A text is read as repetitions of one unit, ``[^\\n]*\\n|[^\\n]+`` (a line with its
end, or the rest). One full match of the regex library against ``(unit)*`` keeps
the end of every repetition, so ``match.ends(1)`` gives the number of units and
both cut offsets at once. Only these three numbers leave the Arrow function;
prefix, middle and suffix are cut and rearranged by Spark's own string
functions, as is the text rebuilt from an output.

Where the cuts lie and which form a text takes follows from a hash of the seed
and the document's id, so any run and any executor decides alike.

Defined cases: null text counts as empty; an empty text, and one that holds a
sentinel, stays as it is (``plain``); a null id is hashed as an empty string;
repeated rows give equal results; a text of more than ``STRETCH`` code points is
matched in stretches of whole lines, which bounds what the match must remember;
an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNITS = regex.compile(r"([^\n]*\n|[^\n]+)*")
#: Code points matched at once; the regex library keeps some state for every repetition.
STRETCH = 1 << 20
PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Rates:
    """Per cent of the texts that are rearranged, and of those in suffix-first order."""
    rearranged: int = 100
    suffix_first: int = 50


@dataclass(frozen=True)
class Sentinels:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        # with overlaps, a sentinel could come about where a part of the text meets another one
        overlap = any(x[-k:] == y[:k] for x in marks for y in marks for k in range(1, min(len(x), len(y)) + 1) if (x, k) != (y, len(y)))
        if not all(marks) or len(set(marks)) < 3 or overlap or any(x in y for x in marks for y in marks if x != y):
            raise ValueError("sentinels must be different and must not overlap each other")


def unit_ends(text: str) -> list[int]:
    """The end of every unit of ``text``."""
    if len(text) <= STRETCH:
        return UNITS.fullmatch(text).ends(1)
    ends, start = [], 0
    while start < len(text):
        cut = text.rfind("\n", start, start + STRETCH) + 1 or text.find("\n", start + STRETCH) + 1 or len(text)
        ends += UNITS.fullmatch(text, start, cut).ends(1)
        start = cut
    return ends


def _cuts(text: Column, draw_1: Column, draw_2: Column) -> Column:
    """Column ``(n, first, second)``: the units of a text and the code points
    before its two cuts."""

    @F.arrow_udf("n long, first long, second long")
    def cuts(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, one, two in batches:
            out = np.zeros((3, len(texts)), np.int64)
            for i, (t, a, b) in enumerate(zip(texts, one.to_pylist(), two.to_pylist())):
                ends = unit_ends(t.as_py() or "")
                n = len(ends)
                low, high = sorted((a % (n + 1), b % (n + 1)))
                out[:, i] = n, ends[low - 1] if low else 0, ends[high - 1] if high else 0
            yield pa.StructArray.from_arrays([pa.array(c) for c in out], ["n", "first", "second"])

    return cuts(text, draw_1, draw_2)


def draws(seed: int, key: Column) -> list[Column]:
    """Four numbers below 2**32 from the seed and a document's id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def rearrange(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7,
              rates: Rates = Rates(), marks: Sentinels = Sentinels()) -> DataFrame:
    """``(id, text, n, form, prefix_chars, middle_chars, output)`` for every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), *[d.alias(f"_draw_{k}") for k, d in enumerate(draws(seed, F.col(id_col)))])
    rows = rows.withColumn("_cut", _cuts(F.col("_text"), F.col("_draw_0"), F.col("_draw_1")))
    plain = (F.col("_text") == "") | (F.col("_draw_2") % 100 >= rates.rearranged)
    for mark in (marks.prefix, marks.suffix, marks.middle):
        plain = plain | F.contains("_text", F.lit(mark))
    form = F.when(plain, PLAIN).when(F.col("_draw_3") % 100 < rates.suffix_first, SPM).otherwise(PSM)
    rows = rows.withColumn("_form", form)
    first, second = (F.col("_cut")[k].cast("int") for k in ("first", "second"))
    whole = F.char_length("_text")
    prefix = F.substr("_text", F.lit(1), first)
    middle, suffix = F.substr("_text", first + 1, second - first), F.substr("_text", second + 1, whole - second)
    p, s, m = F.lit(marks.prefix), F.lit(marks.suffix), F.lit(marks.middle)
    output = (F.when(F.col("_form") == PLAIN, F.col("_text")).when(F.col("_form") == PSM, F.concat(p, prefix, s, suffix, m, middle))
              .otherwise(F.concat(s, suffix, p, prefix, m, middle)))
    moved = F.col("_form") != PLAIN
    return rows.select(F.col("_id").alias(id_col), F.col("_text").alias("text"), F.col("_cut")["n"].alias("n"), F.col("_form").alias("form"),
                       F.when(moved, first.cast("long")).alias("prefix_chars"), F.when(moved, (second - first).cast("long")).alias("middle_chars"),
                       output.alias("output"))


def restored(output: Column, form: Column, marks: Sentinels = Sentinels()) -> Column:
    """The text that an output was made of: its parts lie between the sentinels,
    each of which occurs once."""

    def between(start: str, end: str) -> Column:
        return F.substring_index(F.substring_index(output, start, -1), end, 1)

    last = F.substring_index(output, marks.middle, -1)
    psm = F.concat(between(marks.prefix, marks.suffix), last, between(marks.suffix, marks.middle))
    spm = F.concat(between(marks.prefix, marks.middle), last, between(marks.suffix, marks.prefix))
    return F.when(form == PLAIN, output).when(form == PSM, psm).otherwise(spm)

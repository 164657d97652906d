"""Learned decision lists over text statistics, applied as Spark conditionals.

``text_statistics`` computes everything from whole texts with built-in
functions, row by row and without a shuffle. ``learn_rules`` grows and prunes
threshold conjunctions by sequential covering on a bounded sample of labelled
rows (``SAMPLE_ROWS``, those of the smallest hashed ids; the only thing that
reaches the driver), and ``DecisionList.verdict`` turns the ordered rules into
one conditional expression.

Defined cases: null, empty and blank texts have no words, so they fail the
base rule; a null statistic meets no condition, so the default verdict holds;
labels that are null or contradict each other are not learned from, and with
no usable label (or one class only) the list is empty and keeps what passes
the base rule; repeated rows are judged row by row; columns of the input pass
through, and clashing statistic names in it are replaced; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows the rules are learned from, at most.
SAMPLE_ROWS = 8192
#: Window of the repeated-words statistic.
WINDOW = 5
#: Statistics that rules may use; none grows with the length of a text.
FEATURES = ("symbols_pct", "stutter_pct", "upper_pct", "marks_pct", "digits_pct", "dup_lines_pct", "repeat_pct", "mean_word_chars")
_SPACE = r"[\x20\x09-\x0D]"


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.lit(100.0) * part / whole)


def _count_chars(text: Column, char_class: str) -> Column:
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, char_class, ""))).cast("long")


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the base counts and the rule features of whole texts."""
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *FEATURES]
    docs = docs.drop(*[c for c in added if c in docs.columns and c != text_col])
    kept = docs.columns
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.filter(F.split(text, f"{_SPACE}+"), lambda w: w != "")
    # words and windows of words as 64-bit hashes
    step = docs.withColumn("__words", words).withColumn("__ids", F.transform("__words", lambda w: F.xxhash64(w)))
    step = step.withColumn("__n", F.size("__ids").cast("long"))
    windows = F.transform(F.slice(F.col("__ids"), F.lit(1), F.greatest(F.col("__n").cast("int") - (WINDOW - 1), F.lit(0))),
                          lambda _, i: F.xxhash64(*[F.get("__ids", i + k) for k in range(WINDOW)]))
    step = step.withColumn("__windows", windows)
    # only texts in which some window comes again have their windows sorted
    again = F.size(F.array_distinct("__windows")) < F.size("__windows")
    order = F.when(again, F.sort_array(F.transform("__windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))))
    step = step.withColumn("__order", order)
    same = lambda p, i: (p["w"] == F.get("__order", i - 1)["w"]) | (p["w"] == F.get("__order", i + 1)["w"])
    places = F.sort_array(F.transform(F.filter("__order", lambda p, i: F.coalesce(same(p, i), F.lit(False))), lambda p: p["i"]))
    step = step.withColumn("__places", places)
    covered = F.aggregate(
        F.transform("__places", lambda p, i: F.least(F.coalesce(F.get("__places", i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    lines = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    step = step.withColumn("__lines", lines)
    n = F.col("__n")
    stutter = F.size(F.filter("__ids", lambda w, i: (i > 0) & (w == F.get("__ids", i - 1)))).cast("long")
    step = step.select(
        *kept, n.alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        _count_chars(text, r"[#*$%&|<>]").alias("n_symbols"),
        F.size("__lines").cast("long").alias("__n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
        stutter.alias("__stutter"), _count_chars(text, "[A-Z]").alias("__upper"),
        _count_chars(text, "[!?]").alias("__marks"), _count_chars(text, "[0-9]").alias("__digits"))
    n, chars = F.col("n_words"), F.col("word_chars")
    return step.select(
        *kept, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((n < 10) | (100 * F.col("n_repeat_words") > 20 * n)).alias("base_failed"),
        _share(F.col("n_symbols"), n).alias("symbols_pct"), _share(F.col("__stutter"), n).alias("stutter_pct"),
        _share(F.col("__upper"), chars).alias("upper_pct"), _share(F.col("__marks"), n).alias("marks_pct"),
        _share(F.col("__digits"), chars).alias("digits_pct"), _share(F.col("n_dup_lines"), F.col("__n_lines")).alias("dup_lines_pct"),
        _share(F.col("n_repeat_words"), n).alias("repeat_pct"), F.when(n > 0, chars / n).alias("mean_word_chars"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value > threshold, or value <= threshold
    threshold: float

    def holds(self, value: float | None) -> bool:
        return value is not None and (value > self.threshold) == self.above

    def column(self) -> Column:
        value = F.col(self.feature)
        return F.coalesce(value > self.threshold if self.above else value <= self.threshold, F.lit(False))


@dataclass(frozen=True)
class Rule:
    """A conjunction whose rows get ``keep`` as their verdict."""

    conditions: tuple[Condition, ...]
    keep: bool

    def covers(self, row: dict) -> bool:
        return all(c.holds(row[c.feature]) for c in self.conditions)


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...]
    default: bool = True

    def verdict(self) -> Column:
        """The first rule that covers a row decides; the default holds else."""
        out = None
        for rule in self.rules:
            met = reduce(and_, (c.column() for c in rule.conditions))
            out = F.when(met, F.lit(rule.keep)) if out is None else out.when(met, F.lit(rule.keep))
        return F.lit(self.default) if out is None else out.otherwise(F.lit(self.default))

    def decide(self, row: dict) -> bool:
        return next((r.keep for r in self.rules if r.covers(row)), self.default)


def _best_condition(rows: list[dict], features: Sequence[str], target: Sequence[bool]) -> Condition | None:
    """The threshold with the largest share-weighted gain in purity (FOIL's
    gain), from one sweep over each feature's sorted values."""
    from math import log2

    p_all = sum(target)
    n_all = len(rows) - p_all
    if not p_all or not n_all:
        return None
    before, best, gain = log2(p_all / (p_all + n_all)), None, 1e-9
    for feature in features:
        known = sorted((r[feature], t) for r, t in zip(rows, target) if r[feature] is not None)
        p_known = sum(t for _, t in known)
        p_low = 0
        for i, (value, t) in enumerate(known[:-1]):
            p_low += t
            if value == known[i + 1][0]:
                continue
            middle = (value + known[i + 1][0]) / 2
            for above, p, n in ((False, p_low, i + 1 - p_low), (True, p_known - p_low, len(known) - i - 1 - p_known + p_low)):
                if p and (g := p * (log2(p / (p + n)) - before)) > gain:
                    best, gain = Condition(feature, above, middle), g
    return best


def _worth(rule: tuple[Condition, ...], rows: list[dict], keep: bool) -> tuple[float, int]:
    """(right - wrong) / covered on held-back rows, and the number covered."""
    met = [r["__keep"] == keep for r in rows if all(c.holds(r[c.feature]) for c in rule)]
    return (2 * sum(met) - len(met)) / len(met) if met else -1.0, len(met)


def cover(rows: list[dict], features: Sequence[str] = FEATURES, keep: bool = False, min_covered: int = 5,
          min_precision: float = 0.95, max_conditions: int = 4, max_rules: int = 32) -> DecisionList:
    """Sequential covering: grow a conjunction on two thirds of the rows, drop
    its last conditions while that does not hurt on the other third, take it if
    it is precise on all of them together, remove the rows it covers, and begin again."""
    rules: list[Rule] = []
    left = list(rows)
    while len(rules) < max_rules:
        grow = [r for i, r in enumerate(left) if i % 3]
        hold = [r for i, r in enumerate(left) if not i % 3]
        chosen: list[Condition] = []
        inside = grow
        while len(chosen) < max_conditions and (c := _best_condition(inside, features, [r["__keep"] == keep for r in inside])):
            chosen.append(c)
            inside = [r for r in inside if c.holds(r[c.feature])]
        if not chosen:
            break
        best = tuple(max((chosen[:k] for k in range(1, len(chosen) + 1)), key=lambda c: (_worth(tuple(c), hold, keep)[0], -len(c))))
        covered = [r for r in left if all(c.holds(r[c.feature]) for c in best)]
        right = sum(r["__keep"] == keep for r in covered)
        if len(covered) < min_covered or right < min_precision * len(covered):
            break
        rules.append(Rule(best, keep))
        left = [r for r in left if not all(c.holds(r[c.feature]) for c in best)]
    return DecisionList(tuple(rules), not keep)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
                    text_col: str = "text", bound: int = SAMPLE_ROWS) -> DataFrame:
    """Statistics of up to ``bound`` labelled documents, with their label."""
    agreed = (labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__label"))
              .where("__id is not null and __label is not null").groupBy("__id")
              .agg(F.min("__label").alias("__low"), F.max("__label").alias("__label")).where("__low = __label")
              .orderBy(F.xxhash64("__id"), "__id").limit(bound).select("__id", "__label"))
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    return text_statistics(texts.join(F.broadcast(agreed), "__id")).drop("text")


def learn_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
                text_col: str = "text", bound: int = SAMPLE_ROWS) -> DecisionList:
    """A decision list for rejecting documents, learned from those labelled 0
    and 1 that the base rule passes."""
    sample = labelled_sample(docs, labels, id_col, label_col, text_col, bound)
    sample = (sample.select("__id", (F.col("__label") > 0).alias("__keep"), "base_failed", *FEATURES)
              .orderBy(F.xxhash64("__id"), "__id", *FEATURES).limit(bound))  # ids may repeat
    return cover([r.asDict() for r in sample.collect() if not r["base_failed"]])


def judge(docs: DataFrame, rules: DecisionList, text_col: str = "text") -> DataFrame:
    """``docs`` with their statistics and ``kept``."""
    docs = docs.drop("kept") if "kept" in docs.columns else docs
    return text_statistics(docs, text_col).withColumn("kept", ~F.col("base_failed") & rules.verdict())


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they were."""
    rules = learn_rules(docs, labels, id_col=id_col, text_col=text_col)
    boxed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"), docs[text_col].alias("__text"))
    # the row number keeps the optimiser from copying the statistics into a pushed filter
    judged = judge(boxed, rules, "__text").select("__row", "kept", F.monotonically_increasing_id().alias("__at"))
    return judged.where(F.col("kept") & (F.col("__at") >= 0)).select("__row.*")

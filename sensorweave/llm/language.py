"""Language identification by the nearest of several centroids per language.

Texts become TF-IDF vectors of hashed letter n-grams (1 to 3 letters, words
padded with a space), scaled to length 1. Document frequencies count every
training document. Of each language, up to ``SAMPLE_PER_LANG`` training
documents (those of the smallest hashed ids) are clustered by cosine into
``CLUSTERS`` centroids, language by language in tasks of their own; the centroids
are all that the driver gets. Those of more than ``LANGUAGES_AT_ONCE`` languages
stay in a table and are fetched and scored in blocks of about so many. A text takes the language of the centroid of the
largest cosine; it is ``rejected`` where its distance is beyond that of the
centroid's own training documents by more than ``SLACK``.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
without any training document everything is ``und``; null languages are not
learned from; an id that is null is never trained on and not held out; ties go
to the language that sorts first; repeated rows are judged row by row; other
columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorweave.llm.common import stored

DIMENSIONS = 1 << 14
MAX_N = 3
CLUSTERS = 3
#: Training documents that a language's centroids are fitted on, at most.
SAMPLE_PER_LANG = 256
#: Languages whose centroids the driver and a worker hold at a time, about.
LANGUAGES_AT_ONCE = 512
SLACK = 0.1
UNKNOWN = "und"
_CHUNK = 1 << 20


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams of a whole text; None without a letter."""
    total, carry, lettered = np.zeros(DIMENSIONS, np.int64), np.array([32], np.uint64), False
    text = text or ""
    for at in range(0, len(text), _CHUNK):
        points = np.frombuffer(text[at : at + _CHUNK].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[points]
        lettered = lettered or bool(letter.any())
        points = np.where(letter, points, 32).astype(np.uint64)
        last = at + _CHUNK >= len(text)
        run = np.concatenate([carry, points, np.array([32] if last else [], np.uint64)])
        run = run[np.concatenate([[True], (run[1:] != 32) | (run[:-1] != 32)])]  # one space between words
        grams, code = [], np.zeros(len(run), np.uint64)
        for n in range(MAX_N):
            size = len(run) - n
            if size <= 0:
                break
            code = (code[:size] + run[n:] + np.uint64(n + 1)) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
            new = max(0, len(carry) - n) if at else 0  # counted with the part before
            grams.append(code[new:] >> np.uint64(64 - 14) if DIMENSIONS == 1 << 14 else code[new:] % np.uint64(DIMENSIONS))
        total += np.bincount(np.concatenate(grams).astype(np.int64), minlength=DIMENSIONS)
        carry = run[-(MAX_N - 1):]
    return total if lettered else None


def unit_vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vector = np.log1p(counts).astype(np.float32) * idf
    return vector / max(float(np.linalg.norm(vector)), 1e-12)


def cluster(vectors: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``k`` centroids of unit vectors by cosine, farthest-first seeded,
    and the largest distance of a centroid's own vectors."""
    seeds = [0]
    while len(seeds) < min(k, len(vectors)):
        far = (vectors @ vectors[seeds].T).max(axis=1)
        if far.min() > 1 - 1e-6:
            break
        seeds.append(int(far.argmin()))
    centroids = vectors[seeds]
    for _ in range(rounds):
        own = (vectors @ centroids.T).argmax(axis=1)
        sums = np.stack([vectors[own == c].sum(axis=0) if (own == c).any() else centroids[c] for c in range(len(centroids))])
        moved = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        if np.allclose(moved, centroids, atol=1e-6):
            break
        centroids = moved
    near = vectors @ centroids.T
    own = near.argmax(axis=1)
    radius = np.array([1 - near[own == c, c].min() if (own == c).any() else 0.0 for c in range(len(centroids))])
    return centroids, radius


class Centroids:
    """A fitted model: names, unit centroids, radii and inverse frequencies."""

    def __init__(self, languages: list[str], centroids: np.ndarray, radius: np.ndarray, idf: np.ndarray):
        order = np.argsort(np.array(languages, object), kind="stable") if languages else np.zeros(0, int)
        self.languages = [languages[i] for i in order]
        self.centroids, self.radius, self.idf = centroids[order].astype(np.float32), radius[order], idf

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine of the nearest centroid, and whether it is too far."""
        counts = ngram_counts(text) if self.languages else None
        if counts is None:
            return UNKNOWN, 0.0, True
        near = self.centroids @ unit_vector(counts, self.idf)
        best = int(near.argmax())
        score = float(min(max(near[best], 0.0), 1.0))
        return self.languages[best], score, bool(1 - score > self.radius[best] + SLACK)


class StoredCentroids:
    """A fitted model of many languages: ``(block, lang, radius, centroid)``."""

    def __init__(self, table: DataFrame, blocks: int, idf: np.ndarray):
        self.table, self.blocks, self.idf = table, blocks, idf

    def block(self, number: int) -> Centroids:
        return _fetched(self.table.where(F.col("block") == number), self.idf)


def _fetched(table: DataFrame, idf: np.ndarray) -> Centroids:
    found = sorted(table.select("lang", "radius", "centroid").collect(), key=lambda r: (r["lang"], bytes(r["centroid"])))
    return Centroids([r["lang"] for r in found], np.stack([np.frombuffer(r["centroid"], np.float32) for r in found]) if found
                     else np.zeros((0, DIMENSIONS)), np.array([r["radius"] for r in found]), idf)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """``(id, lang, text)`` of the documents that may be learned from."""
    return (docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col))
            .select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")))


def _document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each n-gram, over all rows, and their number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                counts = ngram_counts(text.as_py())
                if counts is not None:
                    seen += counts > 0
                    n += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(seen[at], n), pa.int64())], ["gram", "n"])

    found = rows.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    df, total = np.zeros(DIMENSIONS), 0
    for gram, n in found:
        if gram < 0:
            total = n
        else:
            df[gram] = n
    return df, total


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Centroids | StoredCentroids:
    """Centroids of every language among the training rows of ``docs``."""
    rows = training_rows(docs, id_col, text_col, lang_col)
    counted = stored(rows.groupBy("lang").count(), "languages")
    languages = counted.count()
    df, total = _document_frequencies(rows) if languages else (np.zeros(DIMENSIONS), 0)
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)
    if not languages or not total:
        return Centroids([], np.zeros((0, DIMENSIONS)), np.zeros(0), idf)
    # a share of each language by hashed id that gives about the sample, then the smallest of these
    spot = F.pmod(F.xxhash64("id"), F.lit(1 << 30)).cast("long")
    spotted = rows.withColumn("spot", spot)
    if languages <= LANGUAGES_AT_ONCE:
        share = F.create_map(*[F.lit(x) for lang, n in counted.collect() for x in (lang, min(1.0, 1.5 * SAMPLE_PER_LANG / n))])
        picked = spotted.where(F.col("spot") < F.coalesce(share[F.col("lang")], F.lit(0.0)) * (1 << 30))
    else:
        shares = counted.select("lang", F.least(F.lit(1.0), F.lit(1.5 * SAMPLE_PER_LANG) / F.col("count")).alias("share"))
        picked = spotted.join(shares, "lang").where(F.col("spot") < F.col("share") * (1 << 30))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, spot, text in zip(*[c.to_pylist() for c in batch.columns]):
                counts = ngram_counts(text)
                if counts is not None:
                    at = np.flatnonzero(counts).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([spot], pa.int64()), pa.array([at], pa.list_(pa.int32())),
                                                      pa.array([counts[at].astype(np.int32)], pa.list_(pa.int32()))], ["lang", "spot", "gram", "n"])

    def centre(table: pa.Table) -> pa.Table:
        table = table.sort_by([("spot", "ascending")]).slice(0, SAMPLE_PER_LANG)
        vectors = np.zeros((len(table), DIMENSIONS), np.float32)
        for i, (at, n) in enumerate(zip(table["gram"], table["n"])):
            counts = np.zeros(DIMENSIONS)
            counts[at.values.to_numpy()] = n.values.to_numpy()
            vectors[i] = unit_vector(counts, idf)
        centroids, radius = cluster(vectors, CLUSTERS)
        return pa.table({"lang": [table["lang"][0].as_py()] * len(centroids), "radius": radius.astype(np.float64),
                         "centroid": pa.array([c.astype(np.float32).tobytes() for c in centroids], pa.binary())})

    kinds = "lang string, spot long, gram array<int>, n array<int>"
    found = (picked.select("lang", "spot", "text").mapInArrow(grams, kinds).groupBy("lang")
             .applyInArrow(centre, "lang string, radius double, centroid binary"))
    if languages <= LANGUAGES_AT_ONCE:
        return _fetched(found, idf)
    blocks = -(-languages // LANGUAGES_AT_ONCE)
    block = F.pmod(F.xxhash64("lang"), F.lit(blocks)).cast("int").alias("block")
    return StoredCentroids(stored(found.select(block, "lang", "radius", "centroid"), "centroids"), blocks, idf)


def _guessed(text: Column, shared) -> Column:
    """Guess of the broadcast model ``shared`` for a text."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    @F.arrow_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def guess(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = [shared.value.predict(t.as_py()) for t in texts]
            yield pa.array([{"lang_pred": a, "score": b, "rejected": c} for a, b, c in rows], kind)

    return guess(text)


def _guessed_by_block(rows: DataFrame, model: StoredCentroids) -> DataFrame:
    """``rows`` with the best guess over all blocks, one block at a time."""
    rows = stored(rows.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    parts = []
    for number in range(model.blocks):
        held = model.block(number)
        if held.languages:
            shared = rows.sparkSession.sparkContext.broadcast(held)
            parts.append(stored(rows.select("__row", _guessed(F.col("text"), shared).alias("guess")), "guesses"))
            shared.destroy()
    every = functools.reduce(DataFrame.unionByName, parts)
    # the largest score, then the language that sorts first; a text without a letter is und in every block
    best = every.groupBy("__row").agg(F.min_by("guess", F.struct(-F.col("guess.score"), F.col("guess.lang_pred"))).alias("guess"))
    return rows.drop("text").join(best, "__row").drop("__row")


def predict(docs: DataFrame, model: Centroids | StoredCentroids, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, held_out, lang_pred, score, rejected)`` for every row of ``docs``."""
    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    if isinstance(model, StoredCentroids):
        found = _guessed_by_block(rows, model)
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x CLUSTERS x DIMENSIONS, both bounded
        found = rows.select(id_col, "held_out", _guessed(F.col("text"), shared).alias("guess"))
    return found.select(id_col, "held_out", "guess.lang_pred", "guess.score", "guess.rejected")

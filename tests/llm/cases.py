"""Awkward documents shared by the operator tests."""

import random

from pyspark.sql import types as T

CLASHING = ["n_tokens", "kept", "shard", "slot", "node", "comp", "spans", "row", "runs", "id", "text_hash", "n_words", "key", "label", "at", "piece", "fingerprint"]

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in CLASHING]])

WORDS = ["the", "of", "and", "Thing", "oneder", "ersh", "été", "größe", "niño", "42", "end.", "so,"]


def prose(seed: int, n: int, line: int = 9) -> str:
    rng = random.Random(seed)
    words = [rng.choice(WORDS) + rng.choice(["", "a", "er", "on", "th"]) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + line]) for i in range(0, n, line))


def awkward() -> list[tuple]:
    """(doc_id, text): nulls, empty and blank texts, a long one, repeated rows,
    equal texts under several ids, and an id with two texts."""
    base = prose(1, 120)
    texts = [(1, base), (2, None), (3, ""), (4, "  \n\t "), (5, prose(2, 40_000)), (6, base), (6, base), (7, base + "\nmore words at the end here"),
             (None, "a text without an id that is here"), (None, base), (8, "one two"), (9, "one two"), (10, prose(3, 60)), (10, prose(4, 60)),
             (11, "x" * 50_000), (12, prose(3, 60)), (-5, prose(5, 80)), (13, " leading and  double   spaces "), (14, "日本語のテキスト 😀 и кириллица")]
    return texts


def frame(spark, rows):
    """Documents with other columns beside, null or clashing in name."""
    data = [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else "src", len(t) if t else None, *["x"] * len(CLASHING)) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def words_of(text):
    return (text or "").encode().split()

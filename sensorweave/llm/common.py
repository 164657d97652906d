"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sensorweave.session import scratch_path

#: Text bytes an Arrow function holds decoded at a time.
BATCH_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back:
    a cut lineage whose files survive lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file (the default of the path parameters)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def by_bytes(sizes: Iterable[int], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges ``(start, end)`` whose sizes add up to about ``limit``;
    one larger item is a range of its own."""
    start, total, i = 0, 0, -1
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if i >= start:
        yield start, i + 1


def string_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of an Arrow string array, one after the other,
    and the n + 1 offsets of the texts in them (null: empty), without a copy
    where nothing is null or sliced."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, off - off[0]

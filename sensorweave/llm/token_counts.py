"""Token counts of whole texts, encoded in Arrow batches that return lengths only.

A text longer than ``SPLIT_BYTES`` is cut at safe boundaries and its parts'
lengths are added up. A boundary is a single space after a character that is
neither a space nor the space mark: where the vocabulary holds no piece in
which the space mark follows another character, no merge can reach over such a
place, and the encoder's own dummy prefix stands for the dropped space. The
vocabulary is checked for this; where it does not hold (or the model
normalises text), texts are encoded in one go.

Defined cases: null text counts as empty (0 bytes, 0 tokens); a text without
any safe boundary is encoded whole, however long; repeated rows and null ids
are counted row by row; other columns of the input are not read, so none can
clash; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorweave.llm.common import BATCH_BYTES, by_bytes, tokenizer_path

SPACE_MARK = "▁"
SPLIT_BYTES = 16 << 10


@functools.lru_cache(maxsize=4)
def load_model(path: str):
    """The processor, and whether texts may be cut at spaces; once per worker."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model.serialized_model_proto())
    norm = proto.normalizer_spec
    plain = (norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces
             and not norm.precompiled_charsmap and not proto.trainer_spec.treat_whitespace_as_suffix)
    bridged = any(SPACE_MARK in p.piece.lstrip(SPACE_MARK) for p in proto.pieces)
    return model, bool(plain and not bridged)


def safe_parts(text: str, size: int = SPLIT_BYTES) -> list[str]:
    """Cut ``text`` at spaces so that the parts' encodings add up to its own."""
    parts, start, n = [], 0, len(text)
    while n - start > size:
        cut = text.find(" ", start + size)
        while 0 <= cut < n and text[cut - 1] in (" ", SPACE_MARK):
            cut = text.find(" ", cut + 1)
        if cut < 0 or cut == n - 1:  # the last space must stay: nothing follows that would stand for it
            break
        parts.append(text[start:cut])
        start = cut + 1
    parts.append(text[start:])
    return parts


def token_lengths(texts: list[str | None], path: str, split: int = SPLIT_BYTES,
                  batch: int = BATCH_BYTES) -> np.ndarray:
    """Token counts of a list of texts."""
    model, safe = load_model(path)
    parts: list[str] = []
    owner: list[int] = []
    for i, text in enumerate(texts):
        cut = safe_parts(text, split) if text and safe and len(text) > split else [text or ""]
        parts += cut
        owner += [i] * len(cut)
    counts = np.zeros(len(texts), np.int64)
    for a, b in by_bytes((len(p) for p in parts), batch):
        lengths = [len(ids) for ids in model.encode(parts[a:b], num_threads=1, add_bos=False, add_eos=False)]
        np.add.at(counts, owner[a:b], lengths)
    return counts


def token_count(text: Column, path: str) -> Column:
    """Column of token counts; nothing but the lengths returns from the workers."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            sizes = [n or 0 for n in pc.binary_length(texts).to_pylist()]
            out = [token_lengths(texts.slice(a, b - a).to_pylist(), path) for a, b in by_bytes(sizes)]
            yield pa.array(np.concatenate(out) if out else np.zeros(0, np.int64), pa.int64())

    return count(text)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 model: str | None = None, limit: int = 4096) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` for every row of ``docs``."""
    path = model or tokenizer_path("piece_bpe_32k.model")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return (docs.select(F.col(id_col), text.alias("text"))
            .select(F.col(id_col), F.octet_length("text").cast("long").alias("n_bytes"),
                    token_count(F.col("text"), path).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > F.lit(limit)))

"""Byte-level BPE by a sentencepiece model that is written from a rank file.

The rank file of a byte-level vocabulary (token bytes and rank) is turned into a
sentencepiece BPE model in memory, without training: every byte becomes one
letter (``LETTERS`` on), every token the piece of its letters, with the negative
rank as score and the rank as id; normalisation is the identity and nothing is
added before a text. The best-scored pair of neighbours merges first there, the
leftmost of equal ones, which is the order of the ranks.

A text is split into pre-tokens by the tokenizer's pattern, each pre-token is
encoded on its own (a pre-token that is a token as it stands is that token), and
ids are decoded by the inverse mapping, piece by piece. The pattern is run by the
regex library, whose tables know newer letters and digits than those of the
tokenizer's own library; characters that the two class differently are looked up
once on the driver and taken out of the classes.

Defined cases: null text counts as empty (no ids); texts are encoded whole,
however long, and special tokens' strings are ordinary text; repeated rows and
null ids are encoded row by row; decoding gives bytes, an unknown id raises; an
empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import base64
import functools
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.llm.common import by_bytes, tokenizer_path

#: The letter of byte 0; those of the others follow.
LETTERS = 0x100
UNKNOWN = "<unknown>"  # no piece: its signs are not among the letters
#: Pre-tokens a worker remembers (the table is emptied when full), none longer than this many characters.
KEPT_PRETOKENS = 600_000
LONGEST_KEPT = 32
#: Text bytes that are held split at a time.
SPLIT_BYTES = 1 << 20

#: A byte that no UTF-8 text holds; it keeps pre-tokens apart.
NO_BYTE = b"\xff"


def pattern_of_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file in the order of their ranks, which run from 0."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))) or not all(bytes([b]) in ranks for b in range(256)):
        raise ValueError("ranks must run from 0 without a gap and hold every single byte")
    return tokens


def as_letters(raw: bytes) -> str:
    return (np.frombuffer(raw, np.uint8).astype("<u2") + LETTERS).tobytes().decode("utf-16-le")


def as_bytes(letters: str) -> bytes:
    return bytes(ord(c) - LETTERS for c in letters)


def piece_model(tokens: list[bytes]) -> bytes:
    """The serialised sentencepiece model of a vocabulary in the order of ranks."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    for rank, token in enumerate(tokens):
        model.pieces.add(piece=as_letters(token), score=-rank, type=proto.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece=UNKNOWN, score=0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    model.trainer_spec.model_type = proto.TrainerSpec.BPE
    model.trainer_spec.vocab_size = len(model.pieces)
    model.trainer_spec.unk_id, model.trainer_spec.unk_piece = len(tokens), UNKNOWN
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


@functools.lru_cache(maxsize=1)
def newer_characters() -> str:
    """Characters that the regex library counts as letters or digits and the
    tokenizer's library does not, as ranges of a class."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    newer: set[str] = set()
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        finder = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        theirs, ours = set(finder.decode(finder.encode_ordinary(every))), set(regex.findall(kind, every))
        if theirs - ours or kind == r"\s" and ours != theirs:
            raise ValueError(f"the two libraries disagree on {kind}")
        newer |= ours - theirs
    codes = set(map(ord, newer))
    starts, ends = (sorted(c for c in codes if c + step not in codes) for step in (-1, 1))
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends))


def spelled_out(pattern: str) -> str:
    """``pattern`` for Latin-1 texts, its classes spelled out, as the standard
    library's engine takes it, which is faster."""
    ranges = {}
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        codes = {c for c in range(256) if regex.match(kind, chr(c))}
        starts, ends = (sorted(c for c in codes if c + step not in codes) for step in (-1, 1))
        ranges[kind] = "".join(f"\\x{a:02x}-\\x{b:02x}" for a, b in zip(starts, ends))
    out, inside = [], False
    for token in re.findall(r"\\p\{.\}|\\.|.", pattern, re.S):
        inside = token == "[" or inside and token != "]"
        if token in ranges:
            token = ranges[token] if inside else f"[{ranges[token]}]"
        elif token == r"\S" and not inside:
            token = f"[^{ranges[chr(92) + 's']}]"
        out.append(token)
    return "".join(out)


class Splitter:
    """Pre-tokens of a text, by a pattern whose classes ``\\p{L}`` and
    ``\\p{N}`` don't hold the ``newer`` characters."""

    def __init__(self, pattern: str, newer: str = ""):
        self.plain = self.exact = regex.compile(pattern)
        self.latin = re.compile(spelled_out(pattern))
        self.newer = regex.compile(f"[{newer}]") if newer else None
        if newer:
            for kind in (r"\p{L}", r"\p{N}"):
                pattern = pattern.replace(kind, f"[{kind}--[{newer}]]")
            self.exact = regex.compile(pattern, regex.V1)

    def split(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            rare = self.newer is not None and self.newer.search(text)
            return (self.exact if rare else self.plain).findall(text)
        return self.latin.findall(text)


class Coder:
    """Ids of pre-tokens and bytes of ids, for the vocabulary of a rank file."""

    def __init__(self, path: str):
        import sentencepiece

        tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=piece_model(tokens))
        self.rank = {token: i for i, token in enumerate(tokens)}
        self.bytes_of = [as_bytes(self.model.id_to_piece(i)) for i in range(len(tokens))]
        self.known: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        raw = [w.encode() for w in words]
        alone = list(map(self.rank.get, raw))
        merge = [r for r, i in zip(raw, alone) if i is None]
        spelled = as_letters(NO_BYTE.join(merge)).split(as_letters(NO_BYTE)) if merge else []
        merged = iter(self.model.encode(spelled, num_threads=1))
        return {w: array("i", next(merged) if i is None else (i,)).tobytes() for w, i in zip(words, alone)}

    def encode(self, split: list[list[str]]) -> Iterator[bytes]:
        """Ids of texts, given their pre-tokens, as little-endian 32-bit numbers."""
        known = self.known
        if len(known) > KEPT_PRETOKENS:
            known.clear()
        fresh = self._learn(list({w for words in split for w in words if w not in known}))
        known.update((w, ids) for w, ids in fresh.items() if len(w) <= LONGEST_KEPT)
        for words in split:
            try:
                yield b"".join(map(known.__getitem__, words))
            except KeyError:  # a long one among them
                yield b"".join([known[w] if w in known else fresh[w] for w in words])

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    return Coder(path)


@functools.lru_cache(maxsize=2)
def splitter(pattern: str, newer: str) -> Splitter:
    return Splitter(pattern, newer)


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None,
                     pattern: str | None = None, decode: bool = False) -> DataFrame:
    """``(id, ids[, decoded])``: the ids of every row's text and, with
    ``decode``, the bytes that these ids decode to."""
    path, pattern, newer = ranks or tokenizer_path("byte_bpe_multi_50k.tiktoken"), pattern or pattern_of_tokenizer(), newer_characters()
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if decode:
        schema = schema.add("decoded", T.BinaryType())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cut = coder(path), splitter(pattern, newer)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            sizes = [n or 0 for n in pc.binary_length(texts).to_pylist()]
            for a, b in by_bytes(sizes, SPLIT_BYTES):
                coded = list(own.encode([cut.split(t) if t else [] for t in texts.slice(a, b - a).to_pylist()]))
                offsets = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), "<i4")))
                columns = [keys.slice(a, b - a), ids]
                if decode:
                    columns.append(pa.array([own.decode(np.frombuffer(c, "<i4").tolist()) for c in coded], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(encode, schema)


def decoded(ids: Column, ranks: str | None = None) -> Column:
    """Bytes of a column of ids (null: null)."""
    path = ranks or tokenizer_path("byte_bpe_multi_50k.tiktoken")

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = coder(path)
        for rows in batches:
            at, ids, known = rows.offsets.to_numpy(), rows.values.to_numpy(zero_copy_only=False), rows.is_valid().to_pylist()
            yield pa.array([own.decode(ids[a:b].tolist()) if k else None for a, b, k in zip(at, at[1:], known)], pa.binary())

    return decode(ids)

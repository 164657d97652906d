"""Packing of token pieces into sequences of a fixed capacity by the sum-of-squares rule.

Texts are tokenised in Arrow batches and cut into pieces of at most
``capacity`` tokens; the small piece rows are written once to the shared
folder. They are then dealt at random into groups of about ``GROUP_PIECES``
rows, and each group is packed on its own: longest piece first, a piece goes
into the open sequence for which the sum over all residual gaps of (number of
open sequences with that gap) squared becomes smallest, ties to the tightest
gap. A group holds a bounded number of small rows however large the corpus or
a single source is, and loses at most a few sequences against packing it all at
once (each group's unfinished ones).

Defined cases: null text counts as empty and gives one piece holding the end
token; a row whose id is null or repeated is packed like any other; an empty
table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import functools
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.llm.common import by_bytes, stored, tokenizer_path

CAPACITY = 4096
END_ID = 1
#: Pieces packed together; the state of a group is this many small rows.
GROUP_PIECES = 32_768
#: About the bytes of the table in which a worker remembers words and parts (emptied when
#: full), what an entry takes besides its characters, and the longest part it keeps.
CACHE_BYTES = 200 << 20
ENTRY_BYTES = 160
LONGEST_KEPT = 64
#: Text bytes of an Arrow batch: the larger, the fewer words are looked up.
PACK_BATCH_BYTES = 8 << 20


class WordEncoder:
    """Ids of texts for a tokenizer that drops white space and lower-cases: the
    ids of a text are those of its white-space separated words. The words of a
    batch are told apart by Arrow, each different word is encoded once, and the
    ids of the texts are gathered by index.

    Words of printable ASCII and Latin-1 letters are cut into letter runs,
    digits and other runs as the tokenizer's pattern cuts them, and every part
    goes straight to its merges; other words pass the whole tokenizer. Words and
    parts are remembered up to ``CACHE_BYTES``, but none longer than
    ``LONGEST_KEPT``. Texts with a special token's string are encoded whole."""

    #: What the fast path takes, and its parts (the tokenizer's own pattern on these characters).
    PLAIN = re.compile("[\x21-\x7eÀ-ÖØ-öø-ÿ]+")
    LETTERS = "a-zß-öø-ÿ"
    PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^0-9{LETTERS}]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.held = 0
        # byte-level alphabet: a printable byte stands for itself, the others for characters from 256 on
        shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        hidden = [i for i in range(256) if i not in shown]
        self.letter_of = np.arange(256, dtype="<u2")
        self.letter_of[hidden] = np.arange(256, 256 + len(hidden))
        self.letter_of[0x20] = 0x20  # blanks stay between parts
        self.by_word = self._agrees(lambda text: b"".join(map(self._whole, text.lower().split())))
        self.by_part = self.by_word and self._merges_alone() and self._agrees(lambda text: b"".join(self._words(text.lower().split())))
        self.known.clear()

    def _merges_alone(self) -> bool:
        """Prepare a tokenizer of the merges alone, for parts separated by
        blanks; the vocabulary tells which ids end a part."""
        from tokenizers import Tokenizer, pre_tokenizers

        mark = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if not mark:
            return False
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(mark)]] = True
        self.by_part = True
        return True

    def _agrees(self, way) -> bool:
        """Whether a way of encoding gives the tokenizer's ids on the cases that matter."""
        words = sorted(w.replace("</w>", "") for w in self.tokenizer.get_vocab())[::20]
        probes = ["Ab, Cd. éa", "x,y a.b ... c", "a 1 22 b's  ß!? (c), d", "ÈA ÀÖØÞ öø ÿ don't I'LL 'dx' a'b", "".join(map(chr, range(0x21, 0x7F))),
                  " ".join(w for w in words if self.PLAIN.fullmatch(w) and w not in self.special)]
        return all(self._whole(p) == way(p) for p in probes)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of parts, from the merges alone: the last id of each part ends it."""
        out = {}
        for i in range(0, len(parts), 500):
            block = parts[i : i + 500]
            line = " ".join(block)
            if not line.isascii():
                line = self.letter_of[np.frombuffer(line.encode(), np.uint8)].tobytes().decode("utf-16-le")
            ids = np.array(self.merges.encode_batch_fast([line], add_special_tokens=False)[0].ids, "<u4")
            raw, a = ids.tobytes(), 0
            for part, b in zip(block, (4 * np.flatnonzero(self.ends[ids]) + 4).tolist(), strict=True):
                out[part] = raw[a:b]
                a = b
        return out

    def _remember(self, entries: dict[str, bytes]) -> None:
        if self.held > CACHE_BYTES:
            self.known.clear()
            self.held = 0
        if max(map(len, entries), default=0) > LONGEST_KEPT:
            entries = {w: ids for w, ids in entries.items() if len(w) <= LONGEST_KEPT}
        self.known.update(entries)
        self.held += ENTRY_BYTES * len(entries) + 2 * sum(map(len, entries)) + sum(map(len, entries.values()))

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of different words (ASCII letters in lower case)."""
        known = self.known
        out: list[bytes | None] = list(map(known.get, words))
        letters, cut, other = [], [], []
        for i in [i for i, ids in enumerate(out) if ids is None]:
            word = words[i]
            if self.by_part and word.isascii() and word.isalpha():
                letters.append(i)
            elif self.by_part and self.PLAIN.fullmatch(word):
                cut.append((i, self.PARTS.findall(word.lower())))
            else:
                other.append(i)
        parts = {words[i] for i in letters}
        parts.update(p for _, some in cut for p in some if p not in known)
        new = self._learn(list(parts))
        for i in letters:
            out[i] = new[words[i]]
        for i, some in cut:
            out[i] = b"".join([new[p] if p in new else known[p] for p in some])
        for i in other:
            out[i] = self._whole(words[i]) if words[i] else b""
        new.update((words[i], out[i]) for i, _ in cut)
        new.update((words[i], out[i]) for i in other)
        self._remember(new)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty), one after the other, and the n + 1
        offsets of the texts in them."""
        texts = texts.fill_null("")
        if not self.by_word:
            return self._joined([self._whole(t) for t in texts.to_pylist()])
        whole = np.zeros(len(texts), bool)
        for mark in self.special:
            for form in (texts, pc.utf8_lower(texts)):
                whole |= pc.match_substring(form, mark).to_numpy(zero_copy_only=False)
        if whole.any():
            ids, at = self.encode(pc.if_else(pa.array(whole), "", texts))
            rows = [self._whole(texts[i].as_py()) if whole[i] else ids[at[i] : at[i + 1]].tobytes() for i in range(len(texts))]
            return self._joined(rows)
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts).cast(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        by_word = pa.array(self._words(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        taken = by_word.take(coded.indices)  # its data are the ids of all texts
        ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1] // 4
        ids = np.frombuffer(taken.buffers()[2] or b"", "<u4")[: ends[-1]]
        return ids, ends[split.offsets.to_numpy()]

    @staticmethod
    def _joined(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.zeros(len(rows) + 1, np.int64)
        np.cumsum([len(r) // 4 for r in rows], out=offsets[1:])
        return np.frombuffer(b"".join(rows), "<u4"), offsets


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def tokenize_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None,
                    capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces ``(id, piece, start, length, ids_crc32, deal[, ids])`` of every
    row's ids followed by ``end_id``; ``deal`` is a number to deal groups by."""
    path = model or tokenizer_path("word_bpe_49k.json")
    end = np.array([end_id], "<u4")
    id_type = docs.schema[id_col].dataType
    fields = [T.StructField(id_col, id_type), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
              T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("deal", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, row = word_encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes = [n or 0 for n in pc.binary_length(texts).to_pylist()]
            for a, b in by_bytes(sizes, PACK_BATCH_BYTES):
                coded, at = encoder.encode(texts.slice(a, b - a))
                rows, out = [], []
                for i in range(b - a):
                    own, row = np.append(coded[at[i] : at[i + 1]], end).astype("<u4"), row + 1
                    for k, start in enumerate(range(0, len(own), capacity)):
                        part = own[start : start + capacity].tobytes()
                        rows.append(a + i)
                        out.append((k, start, len(part) // 4, zlib.crc32(part), zlib.crc32(b"%d:%d:%d" % (task, row, k)), part if with_ids else None))
                kinds = [pa.int32(), *[pa.int64()] * 4, pa.binary()]
                columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows, pa.int64())), *columns][: len(fields)], [f.name for f in fields])

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(cut, T.StructType(fields))


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of every piece, in the order given, by the
    sum-of-squares rule. Opening a sequence counts as moving one from no gap."""
    count = np.zeros(capacity + 1, np.int64)
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened = 0
    for k, size in enumerate(lengths.tolist()):
        here = count[size:]
        after = 2 * count[: capacity + 1 - size] + 1  # one more sequence with the gap that is left
        after[0] = 0  # a full sequence is no longer open
        change = np.where(here > 0, after - 2 * here + 1, np.iinfo(np.int64).max)
        best = int(change.argmin())
        if change[best] <= (after[-1] if size < capacity else 0):
            gap = size + best
            bin_ = open_by_gap[gap].pop()
            count[gap] -= 1
        else:
            gap, bin_ = capacity, opened
            opened += 1
        sequence[k], offset[k] = bin_, capacity - gap
        if gap > size:
            count[gap - size] += 1
            open_by_gap[gap - size].append(bin_)
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (with ``length`` and ``deal``; written tables only, as they are
    counted first) with ``sequence_id`` and ``offset`` in place of ``deal``."""
    groups = max(1, -(-pieces.count() // group_pieces))
    kept = [f for f in pieces.schema.fields if f.name != "deal"]
    schema = T.StructType([*kept, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def fill(key: tuple, rows: pa.Table) -> pa.Table:
        order = pc.sort_indices(rows, [("length", "descending"), ("deal", "ascending"), ("ids_crc32", "ascending")])
        rows = rows.take(order)
        sequence, offset = place(rows["length"].to_numpy(), capacity)
        rows = rows.select([f.name for f in kept])
        return (rows.append_column("sequence_id", pa.array((key[0].as_py() << 32) + sequence, pa.int64()))
                .append_column("offset", pa.array(offset, pa.int64())))

    group = F.pmod(F.col("deal"), F.lit(groups)).alias("group")
    return pieces.groupBy(group).applyInArrow(fill, schema)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None,
                   capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece of every row of ``docs``, with its place in a sequence."""
    pieces = tokenize_pieces(docs, id_col, text_col, model, capacity, end_id, with_ids)
    return pack(stored(pieces, "pieces"), capacity)

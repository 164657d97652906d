"""Encoding of texts by a SentencePiece model, their n-best segmentations, and back.

The encoding is the library's own, and beside it stand the n best segmentations
of the piece lattice. A segmentation's score is the sum of its pieces' scores. In
a merge model these are negative merge ranks, whose sum prefers few and early
pieces, so the lattice takes log-probabilities from them by the law of Zipf and
Mandelbrot: a piece of rank r has a probability in proportion to 1 / (r +
``RANK_SHIFT``) (``scores="model"`` takes the model's scores as they are, right
for a unigram model). A merge model's encoding need not be the best segmentation
by any such sum. Within a segment the lattice of all pieces is searched from its
end: the forward Viterbi score of a place is exactly the best that can still be
reached from there, so A-star returns complete segmentations in descending order
of their scores.

A text falls apart between two neighbouring characters that no piece holds side
by side: neither an edge of the lattice nor a merge reaches over such a place.
Words with their encoding and the best two scores of their lattice (one forward
pass, over thousands of new words at a time) are remembered by each worker; a
text's encoding is that of its words, and its best segmentations are merged from
those of its words, of which only the few with the smallest losses can take part.
So whole texts are segmented exactly, however long they are.

The text gets one space in front and spaces become the space mark, as the model
does it. A character without a piece of its own is spelled in byte pieces, at
``UNKNOWN_LOSS`` below the lowest score.

Defined cases: null and empty texts have the empty segmentation (score 0); of
segmentations with equal scores the order is fixed, whichever comes first;
decoding gives back every text, except that a space mark in a text comes back as
a space; a text without blanks is one segment: its lattice falls apart only between
characters that no piece holds side by side, and is held whole; repeated rows and
null ids are handled row by row; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import math
import zlib
from array import array
from collections.abc import Callable, Iterator
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorweave.llm.common import by_bytes, tokenizer_path

SPACE_MARK = "▁"
UNKNOWN_LOSS = 10.0
#: Added to merge ranks before they are turned into probabilities.
RANK_SHIFT = 100.0
#: Sums of such parts are exact, so that equal segmentations tie whatever their order
#: and the search does not wander among them.
SCORE_GRAIN = 2.0**-24
#: About the bytes of the table in which a worker remembers segments (emptied before a block when full),
#: what an entry takes besides its characters, and the longest segment it keeps.
CACHE_BYTES = 300 << 20
ENTRY_BYTES = 280
LONGEST_KEPT = 64
#: About the characters of texts segmented together, of new words searched in one
#: pass, and the runs copied at a time.
BLOCK_CHARS = 1 << 19
PASS_CHARS = 1 << 17
RUNS = 1 << 14
_NORMAL, _BYTE = 1, 6

Path = tuple[float, bytes]  # score, ids as little-endian unsigned 32-bit numbers
Piece = tuple[str, float, int]  # text, score, kind


def gathered(values: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``at`` of ``values`` (run i lies from ``ends[i]`` to ``ends[i + 1]``)
    one after the other, and their ends there, 0 in front."""
    start = ends[at]
    size = ends[at + 1] - start
    out = np.concatenate([[0], np.cumsum(size)])
    copied = np.empty(out[-1], values.dtype)
    for a in range(0, len(at), RUNS):
        b = min(a + RUNS, len(at))
        copied[out[a] : out[b]] = values[np.repeat(start[a:b] - out[a:b], size[a:b]) + np.arange(out[a], out[b])]
    return copied, out


class Trie:
    """Texts with numbers, found at every place of many strings at once: nodes are
    told apart by a hash table of (node, character) with open addressing."""

    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, texts: list[str]):
        nodes = {"": 0}
        for text in texts:
            for k in range(1, len(text) + 1):
                nodes.setdefault(text[:k], len(nodes))
        chars = sorted({c for text in texts for c in text})
        self.char_no = np.zeros(ord(chars[-1]) + 2 if chars else 1, np.int64)  # 0: in no text
        self.char_no[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.width = len(chars) + 1
        inner = [nodes[text[:-1]] for text in nodes if text]
        self.inner = np.zeros(len(nodes), bool)
        self.inner[inner] = True
        self.length = np.array([len(text) for text in nodes], np.int64)
        self.number = np.full(len(nodes), -1, np.int64)
        self.number[[nodes[text] for text in texts]] = np.arange(len(texts))
        keys = np.array(inner, np.int64) * self.width + self.char_no[[ord(text[-1]) for text in nodes if text]]
        bits = max(4, (4 * len(nodes)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.next = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[slot[left]] < 0]
            self.keys[slot[free]] = keys[free]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & self.mask
        self.next[slot] = np.arange(1, len(nodes))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * self.FACTOR) >> self.shift).astype(np.int64)

    def _step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The nodes behind ``node`` (0: none)."""
        keys = node * self.width + char
        slot = self._slot(keys)
        seen = self.keys[slot]
        out = np.where(seen == keys, self.next[slot], 0)
        left = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            seen = self.keys[slot[left]]
            hit = seen == keys[left]
            out[left[hit]] = self.next[slot[left[hit]]]
            left = left[~hit & (seen >= 0)]
        return out

    def chars(self, text: str) -> np.ndarray:
        """The numbers of a string's characters (0: in no text)."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        return self.char_no[np.minimum(codes, len(self.char_no) - 1)]

    def found(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and nodes of all texts within ``chars``; none reaches over a
        number below 1, and one stands at the end."""
        at = np.flatnonzero(chars > 0)
        node = np.zeros(len(at), np.int64)
        starts, nodes, depth = [at[:0]], [node[:0]], 0
        while len(at):
            node = self._step(node, np.maximum(chars[at + depth], 0))
            depth += 1
            whole = self.number[node] >= 0
            starts.append(at[whole])
            nodes.append(node[whole])
            on = self.inner[node] & (node > 0)
            at, node = at[on], node[on]
        return np.concatenate(starts), np.concatenate(nodes)


def log_probabilities(pieces: list[Piece]) -> list[Piece]:
    """``pieces`` of a merge model, whose scores are negative ranks, with
    log-probabilities that add up to 1 over the normal ones, in whole parts of
    ``SCORE_GRAIN``."""
    total = math.log(sum(1 / (RANK_SHIFT - score) for _, score, kind in pieces if kind == _NORMAL))
    return [(p, -round((math.log(RANK_SHIFT - score) + total) / SCORE_GRAIN) * SCORE_GRAIN if kind == _NORMAL else score, kind) for p, score, kind in pieces]


class PieceLattice:
    def __init__(self, pieces: list[Piece], n: int = 3, library: Callable[[list[str]], list[list[int]]] | None = None):
        """``pieces``: text, score and kind (1 normal, 6 byte) by id;
        ``library`` encodes a list of texts (absent: the best segmentation stands for it)."""
        import ahocorasick

        self.n = n
        self.library = library
        self.mark_id = next((i for i, (p, _, _) in enumerate(pieces) if p == SPACE_MARK), None)
        normal = [(p, s, i) for i, (p, s, kind) in enumerate(pieces) if kind == _NORMAL]
        self.machine = ahocorasick.Automaton()  # finds every piece at every place in one pass
        for p, score, i in normal:
            self.machine.add_word(p, (len(p), score, np.array([i], "<u4").tobytes()))
        self.machine.make_automaton()
        self.single = {p for p, _, _ in normal if len(p) == 1}
        self.neighbours = {p[k : k + 2] for p, _, _ in normal for k in range(len(p) - 1)}
        self.bridged = any(p[1] == SPACE_MARK and p[0] != SPACE_MARK for p in self.neighbours)
        self.unknown = min((s for _, s, _ in normal if s > -1e8), default=0.0) - UNKNOWN_LOSS
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == _BYTE}
        self.raw = [bytes([int(p[3:5], 16)]) if kind == _BYTE else p.encode() if kind == _NORMAL else b"" for p, _, kind in pieces]
        self.unk_id = next((i for i, (_, _, kind) in enumerate(pieces) if kind == 2), 0)
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        self.raw_ends = np.concatenate([[0], np.cumsum([len(r) for r in self.raw])]).astype(np.int64)
        self.trie = Trie([p for p, _, _ in normal])
        self.odd = len(self.trie.length)  # stands for a character without a piece, behind the trie's nodes
        self.node_length = np.append(self.trie.length, 1)
        self.node_score = np.append(np.array([s for _, s, _ in normal] + [0.0])[self.trie.number], self.unknown)
        self.node_id = np.array([i for _, _, i in normal] + [0], "<u4")[self.trie.number]
        self._forget()

    def _forget(self) -> None:
        self.segments: dict[str, int] = {}  # words' numbers in the arrays below
        self.scores, self.losses = array("d"), array("d")  # of the best ids; by how much the second best is lower
        self.best_ids, self.best_ends = array("I"), array("q", [0])
        self.own_ids, self.own_ends = array("I"), array("q", [0])  # the encoding
        self.parts: dict[str, tuple[bytes, float, float]] = {}
        self.searched: dict[str, list[Path]] = {}
        self.held = 0

    @classmethod
    def load(cls, path: str, n: int = 3, scores: str = "auto") -> PieceLattice:
        """``scores``: ``zipf``, ``model`` or ``auto`` (zipf for a merge model)."""
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        if scores not in ("auto", "zipf", "model"):
            raise ValueError(f"no such scores: {scores}")
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        pieces = [(p.piece, p.score, p.type) for p in proto.pieces]
        merges = proto.trainer_spec.model_type == proto.trainer_spec.BPE
        if scores == "zipf" or (scores == "auto" and merges):
            pieces = log_probabilities(pieces)
        processor = SentencePieceProcessor(model_proto=proto.SerializeToString())
        return cls(pieces, n, lambda texts: processor.encode(texts, num_threads=1))

    def _spelled(self, char: str) -> bytes:
        raw = char.encode("utf-8", "surrogatepass")
        return np.array([self.byte_ids.get(b, self.unk_id) for b in raw] if self.byte_ids else [self.unk_id], "<u4").tobytes()

    def _lattice(self, text: str) -> tuple[list[tuple[int, int, float, bytes]], list[float], list[int]]:
        """Edges ``(start, end, score, ids)`` by end, the best score up to
        every place, and where the best last edge to it starts."""
        size = len(text)
        edges = [(last + 1 - length, last + 1, score, ids) for last, (length, score, ids) in self.machine.iter(text)]
        if not self.single.issuperset(text):
            edges += [(i, i + 1, self.unknown, self._spelled(c)) for i, c in enumerate(text) if c not in self.single]
            edges.sort(key=lambda e: e[1])
        best, begin = [0.0] + [float("-inf")] * size, [0] * (size + 1)
        for i, j, score, _ in edges:
            value = best[i] + score
            if value > best[j]:
                best[j], begin[j] = value, i
        return edges, best, begin

    def best_and_loss(self, text: str) -> tuple[bytes, float, float]:
        """Ids and score of a segment's best segmentation, and by how much the
        second best is lower (infinite: there is none), by the two best scores
        up to every place."""
        size, none = len(text), float("-inf")
        found = self.machine.iter(text)
        if not self.single.issuperset(text):
            found = [(j - 1, (j - i, score, ids)) for i, j, score, ids in self._lattice(text)[0]]
        best, second = [0.0] + [none] * size, [none] * (size + 1)
        back: list = [None] * (size + 1)
        for last, edge in found:
            length, score, _ = edge
            j = last + 1
            i = j - length
            value, top = best[i] + score, best[j]
            if value > top:
                other = second[i] + score
                second[j] = top if top > other else other
                best[j] = value
                back[j] = edge
            elif value > second[j]:
                second[j] = value
        ids, at = [], size
        while at:
            length, _, piece = back[at]
            ids.append(piece)
            at -= length
        ids.reverse()
        return b"".join(ids), best[size], best[size] - second[size]

    def best_and_losses(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """:meth:`best_and_loss` of many words by one pass over all of them: ids
        one after the other, their numbers, scores, losses."""
        size = np.array([len(w) for w in words])
        ends = np.cumsum(size + 1) - 1  # a word's last place, where the blank behind it stands
        begin = ends - size
        text = " ".join(words) + " "
        chars = self.trie.chars(text)
        chars[ends] = -1
        odd = np.flatnonzero(chars == 0)
        start, node = self.trie.found(chars)
        start, node = np.append(start, odd), np.append(node, np.full(len(odd), self.odd))
        length = self.node_length[node]
        # by the place in the word where they end, there the longest first: as in the single pass
        reach = start + length - np.repeat(begin, size + 1)[start]
        longest = int(length.max(initial=0))
        rank = reach * (longest + 1) + (longest - length)
        order = np.argsort(rank.astype(np.uint16) if rank.max(initial=0) < 1 << 16 else rank, kind="stable")
        start, node, length, rank = start[order], node[order], length[order], rank[order]
        end, score = start + length, self.node_score[node]
        best, second = np.full(len(chars), -np.inf), np.full(len(chars), -np.inf)
        back = np.zeros(len(chars), np.int64)
        best[begin] = 0.0
        cuts = [0, *(np.flatnonzero(np.diff(rank)) + 1).tolist(), len(rank)]
        for a, b in itertools.pairwise(cuts):  # one edge of a word at a time
            i, j, add_on = start[a:b], end[a:b], score[a:b]
            value, top = best[i] + add_on, best[j]
            second[j] = np.where(value > top, np.maximum(top, second[i] + add_on), np.maximum(second[j], value))
            best[j] = np.maximum(value, top)
            back[j] = np.where(value > top, node[a:b], back[j])
        taken, who, at = [], np.arange(len(words)), ends
        count = np.zeros(len(words), np.int64)
        while len(who):
            last = back[at]
            at = at - self.node_length[last]
            taken.append((who, last, at))
            count[who] += 1
            on = at > begin[who]
            who, at = who[on], at[on]
        behind, node = np.cumsum(count), np.empty(count.sum(), np.int64)
        for k, (who, last, at) in enumerate(taken, 1):
            last = last.copy()
            spelled = last == self.odd
            last[spelled] += at[spelled]
            node[behind[who] - k] = last
        if len(odd):  # such a character has several ids
            runs, place = [self._spelled(text[k]) for k in odd.tolist()], np.full(len(chars), 0)
            place[odd] = np.arange(len(odd))
            spelled = node >= self.odd
            node[spelled] = self.odd + place[node[spelled] - self.odd]
            size = np.concatenate([[0], np.ones(self.odd, np.int64), [len(r) // 4 for r in runs]]).astype(np.int64)
            ids, place = gathered(np.concatenate([self.node_id, np.frombuffer(b"".join(runs), "<u4")]), np.cumsum(size), node)
            count = np.diff(place[np.concatenate([[0], behind])])
        else:
            ids = self.node_id[node]
        return ids, count, best[ends], best[ends] - second[ends]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The library's ids of segments of ``split``: it sets a mark before a
        text itself, so theirs is left out."""
        lone = [self.unk_id if self.mark_id is None else self.mark_id]
        found = self.library([w[1:].replace(SPACE_MARK, " ") for w in words])
        return [ids if len(w) > 1 else lone for w, ids in zip(words, found)]

    def search(self, text: str, n: int | None = None) -> list[Path]:
        """The ``n`` best segmentations of one segment, best first: A-star from
        its end, with the forward scores as the exact rest of the way."""
        edges, best, _ = self._lattice(text)
        into: list[list[tuple[int, float, bytes]]] = [[] for _ in range(len(text) + 1)]
        for i, j, score, piece in edges:
            into[j].append((i, score, piece))
        # of equal scores the one nearest to the start goes on, so that ties don't pile up
        agenda, made, out = [(-best[-1], len(text), 0, 0.0, None)], 0, []
        while agenda and len(out) < (n or self.n):
            _, at, _, behind, chain = heapq.heappop(agenda)
            if at == 0:
                ids = []
                while chain:
                    ids.append(chain[0])
                    chain = chain[1]
                out.append((behind, b"".join(ids)))
                continue
            for start, score, piece in into[at]:
                made += 1
                total = behind + score
                heapq.heappush(agenda, (-(best[start] + total), start, made, total, (piece, chain)))
        return out

    def split(self, text: str) -> list[str]:
        """Words with the space marks before them; no piece reaches over."""
        marked = (" " + text).replace(" ", SPACE_MARK)
        if self.bridged:
            return [marked]
        parts = marked.split(SPACE_MARK)
        if SPACE_MARK * 2 not in marked:
            return [SPACE_MARK + part for part in parts[1:]]
        words, mark = [], ""
        for part in parts[1:]:  # a run of marks belongs to what follows
            mark += SPACE_MARK
            if part:
                words.append(mark + part)
                mark = ""
        return words + ([mark] if mark else [])

    def _lattice_of(self, word: str) -> tuple[bytes, float, float]:
        """``best_and_loss`` of a word, from those of its parts between
        characters that no piece holds side by side."""
        near, pairs = self.neighbours, list(map(add, word, word[1:]))
        if near.issuperset(pairs):
            return self.best_and_loss(word)
        out, scores, least, start = [], [], math.inf, 0
        ends = [k for k, pair in enumerate(pairs, 1) if pair not in near]
        ends.append(len(word))
        known = self.parts.get
        for end in ends:
            part = word[start:end]
            ids, score, loss = known(part) or self._part(part)
            out.append(ids)
            scores.append(score)
            if loss < least:
                least = loss
            start = end
        return b"".join(out), sum(scores), least

    def _part(self, part: str) -> tuple[bytes, float, float]:
        entry = self.parts.get(part)
        if entry is None:
            entry = self.best_and_loss(part)
            if len(part) <= LONGEST_KEPT:
                self.parts[part] = entry
                self.held += ENTRY_BYTES + 2 * len(part) + len(entry[0])
        return entry

    def _learn(self, words: list[str]) -> None:
        """Gives words numbers and writes down their entries: those too long to be
        kept, which come last, are searched one by one."""
        for a, b in by_bytes(map(len, words), PASS_CHARS):
            some = words[a:b]
            short = [w for w in some if len(w) <= LONGEST_KEPT]
            found = [self.best_and_losses(short)] if short else []
            for word in some[len(short) :]:
                ids, score, loss = self._lattice_of(word)
                found.append((np.frombuffer(ids, "<u4"), np.array([len(ids) // 4]), np.array([score]), np.array([loss])))
            self._note(some, *map(np.concatenate, zip(*found)))

    def _note(self, words: list[str], ids: np.ndarray, count: np.ndarray, scores: np.ndarray, losses: np.ndarray) -> None:
        own, own_count = ids, count
        if self.library:
            found = self.encode_words(words)
            own, own_count = np.array(list(itertools.chain.from_iterable(found)), "<u4"), np.array([len(i) for i in found])
        self.segments.update(zip(words, itertools.count(len(self.scores))))
        for held, new in ((self.scores, scores), (self.losses, losses), (self.best_ids, ids), (self.own_ids, own),
                          (self.best_ends, self.best_ends[-1] + np.cumsum(count)), (self.own_ends, self.own_ends[-1] + np.cumsum(own_count))):
            held.frombytes(new.tobytes())
        self.held += ENTRY_BYTES * len(words) + 2 * sum(map(len, words)) + 4 * (len(ids) + len(own))

    def _paths(self, word: str) -> list[Path]:
        """``search`` of a word, remembered as the words are: those with the
        smallest losses are often the same."""
        paths = self.searched.get(word)
        if paths is None:
            paths = self.search(word)
            if len(word) <= LONGEST_KEPT:
                self.searched[word] = paths
                self.held += ENTRY_BYTES + 2 * len(word) + sum(120 + len(ids) for _, ids in paths)
        return paths

    def _words(self, texts: list[str]) -> tuple[list[str], list[int], np.ndarray]:
        """The segments of texts, the ends of the texts in them, 0 in front, and the
        segments' numbers."""
        if self.held > CACHE_BYTES:
            self._forget()
        segments, ends = [], [0]
        for text in texts:
            segments += self.split(text) if text else []
            ends.append(len(segments))
        found = list(map(self.segments.get, segments))
        if None in found:
            new = dict.fromkeys([w for w, at in zip(segments, found) if at is None])
            try:
                self._learn(sorted(new, key=lambda w: len(w) > LONGEST_KEPT))
            except BaseException:  # nothing half noted stays
                self._forget()
                raise
            found = [self.segments[w] if at is None else at for w, at in zip(segments, found)]
        return segments, ends, np.array(found, np.int64)

    def _drop(self, segments: list[str]) -> None:
        """Forgets segments that are too long to be kept; they were noted last."""
        words = [w for w in dict.fromkeys(segments) if len(w) > LONGEST_KEPT]
        if not words:
            return
        start = min(self.segments[w] for w in words)
        self.held -= ENTRY_BYTES * len(words) + 2 * sum(map(len, words)) + 4 * (len(self.best_ids) - self.best_ends[start] + len(self.own_ids) - self.own_ends[start])
        del self.best_ids[self.best_ends[start] :], self.own_ids[self.own_ends[start] :]
        del self.best_ends[start + 1 :], self.own_ends[start + 1 :], self.scores[start:], self.losses[start:]
        for word in words:
            del self.segments[word]

    def encode(self, text: str | None) -> bytes:
        """The library's ids of a whole text."""
        segments, _, at = self._words([text or ""])
        own, _ = gathered(np.frombuffer(self.own_ids, "<u4"), np.frombuffer(self.own_ends, np.int64), at)
        self._drop(segments)
        return own.tobytes()

    def nbest(self, text: str | None) -> list[Path]:
        """The best segmentations of a whole text, best first."""
        return self.encode_and_nbest(text)[1]

    def encode_and_nbest(self, text: str | None) -> tuple[bytes, list[Path]]:
        """The library's ids of a whole text, and its best segmentations."""
        return next(self.encode_and_nbest_all([text]))

    def encode_and_nbest_all(self, texts: list[str | None]) -> Iterator[tuple[bytes, list[Path]]]:
        """:meth:`encode_and_nbest` of each text, their new words learnt together."""
        segments, ends, at = self._words([t or "" for t in texts])
        best, best_ends = gathered(np.frombuffer(self.best_ids, "<u4"), np.frombuffer(self.best_ends, np.int64), at)
        own, own_ends = gathered(np.frombuffer(self.own_ids, "<u4"), np.frombuffer(self.own_ends, np.int64), at)
        scores, losses = np.frombuffer(self.scores)[at], np.frombuffer(self.losses)[at]
        self._drop(segments)
        for a, b in itertools.pairwise(ends):
            if a == b:
                yield b"", [(0.0, b"")]
            else:
                encoded = own[own_ends[a] : own_ends[b]].tobytes()
                yield encoded, self._merged(segments[a:b], scores[a:b], losses[a:b], best[best_ends[a] : best_ends[b]].tobytes(), 4 * (best_ends[a : b + 1] - best_ends[a]))

    def _merged(self, segments: list[str], scores: np.ndarray, losses: np.ndarray, first: bytes, ends: np.ndarray) -> list[Path]:
        """The best segmentations of a text from its segments' ids ``first``, of
        which segment i has the bytes from ``ends[i]`` to ``ends[i + 1]``, scores and losses."""
        left, paths_of = losses.copy(), {}
        for _ in range(min(self.n - 1, len(left))):
            i = int(left.argmin())
            if left[i] == math.inf:
                break
            left[i] = math.inf
            paths_of[i] = self._paths(segments[i])
        merged: list[tuple[float, tuple[tuple[int, int], ...]]] = [(0.0, ())]  # loss, (segment, its path)
        for i, paths in paths_of.items():
            choices = [(loss + paths[0][0] - paths[k][0], (*taken, (i, k)) if k else taken) for loss, taken in merged for k in range(len(paths))]
            merged = heapq.nsmallest(self.n, choices, key=lambda c: c[0])
        total, out = sum(scores.tolist()), []
        for loss, taken in merged:
            ids, done = [], 0
            for i, k in sorted(taken):
                ids += [first[done : ends[i]], paths_of[i][k][1]]
                done = ends[i + 1]
            out.append((total - loss, b"".join([*ids, first[done:]])))
        return out

    def decode(self, ids: bytes) -> str:
        """The text of a sequence of ids."""
        raw, _ = gathered(self.raw_bytes, self.raw_ends, np.frombuffer(ids, "<u4").astype(np.int64))
        text = raw.tobytes().decode("utf-8", "replace").replace(SPACE_MARK, " ")
        return text[1:] if text[:1] == " " else text


def segmented(model: PieceLattice, texts: pa.Array) -> Iterator[tuple[str, bytes, list[Path]]]:
    """Texts (null: empty), the library's ids and the best segmentations, by blocks of
    about ``BLOCK_CHARS``."""
    for a, b in by_bytes(pc.fill_null(pc.utf8_length(texts), 0).to_pylist(), BLOCK_CHARS):
        some = [t or "" for t in texts.slice(a, b - a).to_pylist()]
        for text, (own, paths) in zip(some, model.encode_and_nbest_all(some)):
            yield text, own, paths


@functools.lru_cache(maxsize=2)
def lattice(path: str, n: int, scores: str = "auto") -> PieceLattice:
    return PieceLattice.load(path, n, scores)


def segmentations(text: Column, path: str, n: int = 3, scores: str = "auto") -> Column:
    """Struct of the library's ``ids`` of a text and ``paths``, an array of
    ``(score, ids)`` of the ``n`` best segmentations."""

    @F.arrow_udf("struct<ids:array<int>,paths:array<struct<score:double,ids:array<int>>>>")
    def segment(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = lattice(path, n, scores)
        ids = pa.list_(pa.int32())
        kind = pa.struct([("ids", ids), ("paths", pa.list_(pa.struct([("score", pa.float64()), ("ids", ids)])))])
        for texts in batches:
            yield pa.array([{"ids": np.frombuffer(own, "<i4"), "paths": [{"score": s, "ids": np.frombuffer(p, "<i4")} for s, p in paths]}
                            for _, own, paths in segmented(model, texts)], kind)

    return segment(text)


def decoded(ids: Column, path: str) -> Column:
    """Text of a column of id arrays (null: null)."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = lattice(path, 3)
        for rows in batches:
            yield pa.array([None if r.as_py() is None else model.decode(np.array(r.as_py(), "<u4").tobytes()) for r in rows], pa.string())

    return decode(ids)


def encode_nbest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, n: int = 3, scores: str = "auto") -> DataFrame:
    """``(id, ids, paths)``: the library's ids of every row's text, and its ``n``
    best segmentations."""
    path = model or tokenizer_path("piece_bpe_32k.model")
    return docs.select(F.col(id_col), segmentations(F.col(text_col).cast("string"), path, n, scores).alias("s")).select(id_col, "s.*")


def summarise_nbest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, n: int = 3, scores: str = "auto") -> DataFrame:
    """Per row the number and checksum of the library's ids, the number of
    pieces of the best segmentation, scores and checksums of the ``n`` best, and
    whether decoding the best gives the text back; the ids themselves stay in the
    workers."""
    path = model or tokenizer_path("piece_bpe_32k.model")
    kind = pa.struct([("n_tokens", pa.int64()), ("encoded_crc32", pa.int64()), ("n_pieces", pa.int64()), ("scores", pa.list_(pa.float64())),
                      ("ids_crc32", pa.list_(pa.int64())), ("round_trip", pa.bool_())])

    @F.arrow_udf("struct<n_tokens:bigint,encoded_crc32:bigint,n_pieces:bigint,scores:array<double>,ids_crc32:array<bigint>,round_trip:boolean>")
    def summary(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lat = lattice(path, n, scores)
        for texts in batches:
            rows = []
            for text, own, paths in segmented(lat, texts):
                rows.append({"n_tokens": len(own) // 4, "encoded_crc32": zlib.crc32(own), "n_pieces": len(paths[0][1]) // 4,
                             "scores": [s for s, _ in paths], "ids_crc32": [zlib.crc32(i) for _, i in paths],
                             "round_trip": lat.decode(paths[0][1]) == text.replace(SPACE_MARK, " ")})
            yield pa.array(rows, kind)

    return docs.select(F.col(id_col), summary(F.col(text_col).cast("string")).alias("s")).select(id_col, "s.*")

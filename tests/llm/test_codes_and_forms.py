"""Vector codes, fill-in-middle forms, byte-level ids, and the tables workers keep."""

import base64
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import public_tokenizers
from sensorweave.llm import byte_bpe, fill_in_middle, packing, vector_codes

from .cases import awkward, frame

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


# vector codes

def test_neighbours_on_the_curve_are_neighbours_in_space():
    for width, bits in ((1, 4), (2, 3), (3, 2), (4, 2)):
        points = np.array(list(itertools.product(range(1 << bits), repeat=width)))
        keys = vector_codes.hilbert_keys(points, bits)
        order = sorted(range(len(points)), key=keys.__getitem__)
        assert len(set(keys)) == len(points) and (np.abs(np.diff(points[order], axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("kind", ["f8", "i8", "object"])
def test_shortlists_lose_no_nearest_entry_and_no_tie(kind):
    rng = np.random.default_rng(1)
    shorter = 0
    for _ in range(200):
        entries = rng.integers(-6, 7, (rng.integers(1, 40), 3)).astype(kind)
        x = (rng.integers(-2, 3, (rng.integers(1, 30), 3)) + rng.integers(-4, 5, 3)).astype(kind)
        shorter += len(vector_codes.shortlist(x.min(0), x.max(0), entries)) < len(entries)
        got, distance = vector_codes.assign(x, x.min(0), x.max(0), entries)
        all_ = [[sum((a - b) ** 2 for a, b in zip(p, e)) for e in entries.tolist()] for p in x.tolist()]
        assert got.tolist() == [d.index(min(d)) for d in all_] and distance.tolist() == [min(d) for d in all_]
    assert shorter > 100


def coded_plainly(rows, parts, entries, rounds):
    """Codes, errors and codebooks by the definition, with Python's integers."""
    kept = [(i, v, g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [[math.floor(x * 1024) if abs(x) < 2**60 else int(x) * 1024 for x in v] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))
    order = [r for r in order if len(whole[r]) % parts == 0]
    width = len(whole[order[0]]) // parts if order else 0
    fits = [r for r in order if len(whole[r]) == parts * width]
    cut = {r: [whole[r][k * width : (k + 1) * width] for k in range(parts)] for r in fits}
    books = [[cut[r][k] for r in fits[:entries]] for k in range(parts)]
    far = lambda x, e: sum((a - b) ** 2 for a, b in zip(x, e))
    nearest = lambda x, book: min(range(len(book)), key=lambda e: (far(x, book[e]), e))
    for _ in range(rounds):
        for k, book in enumerate(books):
            of = {}
            for r in fits:
                of.setdefault(nearest(cut[r][k], book), []).append(cut[r][k])
            for e, own in of.items():
                book[e] = [sum(c) // len(own) for c in zip(*own)]
    out, totals = [], {}
    for r, (i, _, g) in enumerate(kept):
        code = error = None
        if r in cut:
            at = [nearest(cut[r][k], books[k]) for k in range(parts)]
            code, error = "".join(f"{e:02x}" for e in at), sum(far(cut[r][k], books[k][e]) for k, e in enumerate(at))
            totals[g] = totals.get(g, 0) + error
        out.append((i, g, code, error))
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    small = lambda v: v if v is not None and v < 2**63 else None
    return sorted(((i, g, c, small(e), small(totals.get(g))) for i, g, c, e in out), key=str), digest


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.StringType()),
                        T.StructField("uid", T.StringType()), T.StructField("part", T.StringType())])


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", None) for r in rows], VECTORS)


def some_vectors(seed, n, width, size=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, size) for _ in range(width)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, size / 9) for c in rng.choice(centres)], rng.choice(["a", "b", None])) for i in range(n)]
    rng.shuffle(rows)
    return rows


def test_codes_equal_the_definition(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", 16)
    nan, inf = float("nan"), float("inf")
    odd = [(None, [0.5] * 8, "a"), (3, [0.25] * 8, None), (3, [0.25] * 8, None), (900, None, "a"), (901, [nan] * 8, "a"), (902, [inf] + [0.0] * 7, "a"),
           (903, [None] + [0.0] * 7, "b"), (904, [0.5] * 4, "b"), (905, [], "b"), (906, [1.0] * 6, None), (907, [-0.0004] * 8, "c")]
    rows = some_vectors(1, 150, 8) + odd + [(1000 + i, [0.125] * 8, "hot") for i in range(120)]
    for entries, rounds in ((16, 3), (256, 1)):
        got, books = vector_codes.compress(vectors(spark, rows), entries=entries, rounds=rounds)
        want, digest = coded_plainly(rows, 4, entries, rounds)
        assert sorted(((r.vec_id, r.label, r.code, r.error, r.label_error) for r in got.collect()), key=str) == want
        assert books.sha256() == digest


@pytest.mark.parametrize("size", [3e4, 1e12, 1e30])
def test_large_components_stay_exact(spark, size):
    rows = some_vectors(2, 60, 4, size) + [(500, [size * 9, -size, 0.0, 1.0], "a")]
    got, books = vector_codes.compress(vectors(spark, rows), entries=5, rounds=2)
    want, digest = coded_plainly(rows, 4, 5, 2)
    assert books.sha256() == digest
    assert sorted(((r.vec_id, r.label, r.code, r.error) for r in got.collect()), key=str) == sorted((w[:4] for w in want), key=str)


def test_label_totals_by_salt_equal_broadcast_ones(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 1)
    rows = some_vectors(3, 80, 4)
    got, _ = vector_codes.compress(vectors(spark, rows), entries=4, rounds=1)
    assert sorted(((r.vec_id, r.label, r.code, r.error, r.label_error) for r in got.collect()), key=str) == coded_plainly(rows, 4, 4, 1)[0]


def test_nothing_to_code(spark):
    for rows in ([], [(1, None, "a")], [(1, [1.0, 2.0, 3.0], "a")]):
        got, books = vector_codes.compress(vectors(spark, rows))
        assert [(r.vec_id, r.code) for r in got.collect()] == [(i, None) for i, v, _ in rows if v]
        assert books.sha256() == hashlib.sha256(b"").hexdigest()
    got, _ = vector_codes.compress(vectors(spark, [(1, [], "a"), (2, [], None)]))
    assert sorted((r.vec_id, r.code, r.error) for r in got.collect()) == [(1, "00000000", 0), (2, "00000000", 0)]
    with pytest.raises(ValueError):
        vector_codes.compress(vectors(spark, []), entries=257)


# fill in middle

def formed(doc_id, text, seed=7, rearranged=100, suffix_first=50):
    text, h = text or "", hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    a, b, c, d = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    low, high = sorted((a % (len(units) + 1), b % (len(units) + 1)))
    p, m, s = ("".join(units[i:j]) for i, j in ((0, low), (low, high), (high, None)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or c % 100 >= rearranged:
        return doc_id, text, len(units), "plain", None, None, text
    form = "spm" if d % 100 < suffix_first else "psm"
    return doc_id, text, len(units), form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


def test_forms_equal_cutting_line_by_line(spark):
    rng = random.Random(4)
    texts = [t for _, t in awkward()] + ["\n", "\n\n", "a<P>b\nc", "<S>", "x<", "<\n<\nP>\nM>", "é\r\n😀\n\x85 \n"]
    texts += ["".join(rng.choice(["a", "\n", "<", "P>", "😀", " "]) for _ in range(rng.randint(0, 30))) for _ in range(150)]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(5, texts[0]), (5, texts[0])]
    for rates in ((100, 50), (40, 0), (0, 100)):
        got = fill_in_middle.rearrange(frame(spark, rows), rates=fill_in_middle.Rates(*rates))
        got = got.withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form"))).collect()
        assert all(r.back == r.text for r in got)
        assert sorted((tuple(r)[:-1] for r in got), key=str) == sorted((formed(i, t, 7, *rates) for i, t in rows), key=str)
    assert {r.form for r in got} == {"plain"} and fill_in_middle.rearrange(frame(spark, [])).count() == 0


def test_long_texts_are_matched_in_stretches(monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(fill_in_middle, "STRETCH", 7)
    for _ in range(2000):
        text = "".join(rng.choice("ab\n\né😀") for _ in range(rng.randint(0, 40)))
        assert fill_in_middle.unit_ends(text) == [m.end() for m in re.finditer(r"[^\n]*\n|[^\n]+", text)]
    monkeypatch.undo()
    assert len(fill_in_middle.unit_ends("a\n" * 4_000_000)) == 4_000_000 and fill_in_middle.unit_ends("x" * 3_000_000) == [3_000_000]


def test_sentinels_that_could_be_mistaken_are_refused():
    for marks in (("a", "b", "b"), ("", "b", "c"), ("<P>", "><S", "<M>"), ("aba", "c", "d")):
        with pytest.raises(ValueError):
            fill_in_middle.Sentinels(*marks)


# byte-level ids

@pytest.fixture(scope="module")
def library():
    import tiktoken

    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(coder, splitter, texts):
    return [np.frombuffer(c, "<i4").tolist() for c in coder.encode([splitter.split(t) for t in texts])]


def test_ids_equal_the_library_on_every_character(library):
    coder, splitter = byte_bpe.Coder(RANKS), byte_bpe.Splitter(public_tokenizers.PATTERN, byte_bpe.newer_characters())
    characters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(characters), 3000):
        texts = ["".join(f"a{c}1{c} {c}.{c}\n" for c in characters[k : k + 20]) for k in range(i, min(i + 3000, len(characters)), 20)]
        assert ids_of(coder, splitter, texts) == [library.encode_ordinary(t) for t in texts]


def test_ids_equal_the_library_on_mixed_texts(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KEPT_PRETOKENS", 50)
    rng = random.Random(6)
    coder, splitter = byte_bpe.Coder(RANKS), byte_bpe.Splitter(public_tokenizers.PATTERN, byte_bpe.newer_characters())
    parts = ["'s", " ", "  ", "\n", "\t", "don't", "éè", "日本", "😀", "the", " the", "123", "x" * 99, "<|endoftext|>", "՘", "　", "ß", "ing", "!!!", "\r\n", "Ġ", "Ā", "▁"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + ["x" * 100_000, " " * 50_000, "日" * 20_000]
    got = [ids for i in range(0, len(texts), 100) for ids in ids_of(coder, splitter, texts[i : i + 100])]
    assert got == [library.encode_ordinary(t) for t in texts]
    assert [coder.decode(i) for i in got] == [t.encode() for t in texts]
    assert len(coder.known) < 5000 and max(map(len, coder.known), default=0) <= byte_bpe.LONGEST_KEPT


def test_latin_texts_split_alike_in_both_engines():
    splitter, rng = byte_bpe.Splitter(public_tokenizers.PATTERN), random.Random(8)
    for _ in range(3000):
        text = "".join(chr(rng.choice([rng.randrange(256), 32, 10, 39, 115, 233])) for _ in range(rng.randint(0, 40)))
        assert splitter.latin.findall(text) == splitter.plain.findall(text)


def test_the_piece_model_is_the_vocabulary():
    tokens = byte_bpe.read_ranks(RANKS)
    coder = byte_bpe.Coder(RANKS)
    assert coder.bytes_of == tokens and coder.model.get_piece_size() == len(tokens) + 1
    assert all(byte_bpe.as_bytes(byte_bpe.as_letters(bytes([b]))) == bytes([b]) for b in range(256))


def test_rows_are_encoded_whole_and_decode_to_themselves(spark, library):
    got = byte_bpe.encode_documents(frame(spark, awkward()))
    rows = got.select("doc_id", "ids", byte_bpe.decoded(F.col("ids")).alias("raw")).collect()
    want = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in awkward()]
    assert sorted(((r.doc_id, list(r.ids), bytes(r.raw)) for r in rows), key=str) == sorted(want, key=str)
    both = byte_bpe.encode_documents(frame(spark, awkward()), decode=True).collect()
    assert sorted(((r.doc_id, list(r.ids), bytes(r.decoded)) for r in both), key=str) == sorted(want, key=str)
    assert byte_bpe.encode_documents(frame(spark, []), decode=True).count() == 0
    nulls = spark.createDataFrame([(None,), ([],)], "ids array<int>").select(byte_bpe.decoded(F.col("ids")).alias("raw")).collect()
    assert [r.raw for r in nulls] == [None, b""]


# what the packing worker remembers

def test_words_are_forgotten_by_bytes_and_ids_stay_equal(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, rng = Tokenizer.from_file(path), random.Random(7)
    signs = [chr(c) for c in range(0x20, 0x250)] + ["'s", "'S", "'re", "́", "İ", "ﬁ", "ǅ", "日本", "　", "½", "ª", "\x1c", "\x85", "К", "ẞ", "K", "  ", "\n", "abc", "Thing", "<|endoftext|>"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(6000)] + [None, "x" * 5000, "word " * 3000, "ab,cd." * 400]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for limit in (0, 20_000, 1 << 30):
        monkeypatch.setattr(packing, "CACHE_BYTES", limit)
        encoder = packing.WordEncoder(path)
        assert encoder.by_word and encoder.by_part
        for i in range(0, len(texts), 500):
            ids, at = encoder.encode(pa.array(texts[i : i + 500], pa.string()))
            assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want[i : i + 500]
            size = sum(packing.ENTRY_BYTES + 2 * len(w) + len(v) for w, v in encoder.known.items())
            assert size <= limit + 2_000_000 and max(map(len, encoder.known), default=0) <= packing.LONGEST_KEPT

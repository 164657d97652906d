"""Operators over the whole corpus: near-duplicates, line runs, fingerprints, packing, the pipeline."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from sensorweave.llm import components, fingerprints, line_dedup, near_dedup, packing, shingles

from .cases import WORDS, awkward, frame, prose, words_of


# shingles and sketches

def shingle_set(text, size=5):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < size else frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


@pytest.mark.parametrize("chunk", [7, 64, 1 << 20])
def test_shingle_hashes_stand_for_shingles(monkeypatch, chunk):
    monkeypatch.setattr(shingles, "CHUNK", chunk)
    shingles._powers.clear()
    rng = random.Random(1)
    parts = ["a", "B", "é", "ß", " ", "\n", "\t", "\x0b", "\x1c", "\x85", ".", " ", "Ä"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(300)] + [None, "", " ", "a b c d e", "A b c D E f"]
    got, want = shingles.shingle_sets(pa.array(texts)), [shingle_set(t) for t in texts]
    assert [len(g) for g in got] == [len(w) for w in want]
    for i in range(0, len(texts), 7):
        for j in range(len(texts)):
            assert len(np.intersect1d(got[i], got[j])) == len(want[i] & want[j])


def test_registers_hold_leading_zeros_and_mantissa_of_the_least_hash():
    rng = np.random.default_rng(3)
    hashes = np.unique(rng.integers(0, 1 << 64, 500, np.uint64))
    sketch = near_dedup.registers(hashes)
    spread = [int(x) for x in shingles.mix(hashes ^ np.uint64(0x5851F42D4C957F2D))]
    for bucket in range(near_dedup.BUCKETS):
        low = -(-(bucket << 64) // near_dedup.BUCKETS)
        high = -(-((bucket + 1) << 64) // near_dedup.BUCKETS)
        inside = [x - low for x in spread if low <= x < high]
        if not inside:
            assert sketch[bucket] == 0
            continue
        value = min(inside) >> 8  # 49 bits are kept
        bits = value.bit_length()
        below = value - (1 << bits - 1) if bits else 0
        shift = bits - 1 - near_dedup.MANTISSA
        mantissa = below >> shift if shift >= 0 else below << -shift
        assert sketch[bucket] == (50 - bits) << near_dedup.MANTISSA | mantissa & 1023


def test_estimates_are_near_the_similarity():
    rng = np.random.default_rng(4)
    for share in (0.2, 0.5, 0.8):
        errors = []
        for _ in range(60):
            both = rng.integers(0, 1 << 64, int(2000 * share), np.uint64)
            own = [np.unique(np.concatenate([both, rng.integers(0, 1 << 64, 2000 - len(both), np.uint64)])) for _ in range(2)]
            a, b = (near_dedup.registers(x)[None] for x in own)
            value, _ = near_dedup.estimate(a, b, np.array([2000]), np.array([2000]))
            errors.append(value[0] - len(both) / (4000 - len(both)))
        assert abs(np.mean(errors)) < 0.02


# near-duplicates

def grouped(rows, pct=75):
    """Components by comparing all pairs; rows of one id are one document."""
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= pct * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i in parent}


def edited(text, rng, n):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(WORDS) + str(rng.randrange(99))
    return " ".join(words)


@pytest.mark.parametrize("limits", [{}, {"SMALL_GROUP": 2, "BLOCK_MEMBERS": 3}])
def test_components_equal_comparing_all_pairs(spark, monkeypatch, limits):
    rng = random.Random(8)
    rows = list(awkward())
    for k in range(12):  # families around the threshold, chains of edits, short texts
        text = prose(50 + k, rng.choice([6, 12, 40, 150]), line=1000)
        for m in range(8):
            rows.append((1000 + 10 * k + rng.randrange(10_000) * 100, edited(text, rng, rng.randrange(0, 4))))
            if m % 2:
                text = rows[-1][1]
    rows += [(50_000 + i, "common words at the front of a text " + prose(900 + i, 40)) for i in range(30)]
    for name, value in limits.items():
        monkeypatch.setattr(near_dedup, name, value)
    docs = frame(spark, rows)
    got = near_dedup.near_duplicates(docs).collect()
    want = grouped(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
        assert r.kept == (r.doc_id is None or want[r.doc_id] == r.doc_id)
    sizes = collections.Counter((i, len(shingle_set(t))) for i, t in rows)
    assert collections.Counter((r.doc_id, r.n_shingles) for r in got) == sizes
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(i for i, _ in rows if i is None or want[i] == i)


def test_inverted_lists_find_the_linking_members():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 40, rng.integers(1, 40)).astype(np.int64)) for _ in range(60)]
    for i, linked in near_dedup.linking_pairs(sets[:25], sets, 60):
        want = [j for j, s in enumerate(sets) if 100 * len(np.intersect1d(sets[i], s)) >= 60 * len(np.union1d(sets[i], s))]
        assert linked.tolist() == want


def test_repeated_rows_and_copies_without_an_id_are_kept_once(spark):
    a, b, c = (prose(300 + i, 60) for i in range(3))
    rows = [(1, a), (1, a), (2, b), (2, c), (2, c), (3, None), (3, None), (4, ""), (4, ""), (5, a), (5, a),
            (None, a), (None, a), (None, a.upper().replace("É", "é")), (None, "  " + a), (None, "one two"), (None, ""), (None, ""), (None, None)]
    kept = near_dedup.keep_one(frame(spark, rows))
    got = collections.Counter((r.doc_id, r.text if r.doc_id is not None else tuple(sorted(shingle_set(r.text)))) for r in kept.collect())
    nameless = lambda t: (None, tuple(sorted(shingle_set(t))))
    want = {(1, a): 1, (2, b): 1, (2, c): 1, (3, None): 1, (4, ""): 1, nameless(""): 3} | {nameless(t): 1 for i, t in rows if i is None and shingle_set(t)}
    assert got == want and kept.columns == frame(spark, []).columns
    assert near_dedup.keep_one(frame(spark, [])).count() == 0


def test_large_sets_of_ids_are_joined_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BROADCAST_IDS", 0)
    text = prose(5, 80)
    got = near_dedup.near_duplicates(frame(spark, [(3, text), (1, text + " end"), (2, "other text altogether")])).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2, 3: 1}
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        near_dedup.near_duplicates(frame(spark, []), pct=50)


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 9)] + [(201, 200), (202, 201), (200, 202)]
    nodes = [*range(41), *range(100, 109), 200, 201, 202, 300]
    labels = spark.createDataFrame([(n, n) for n in nodes], "node long, comp long")
    got = {r.node: r.comp for r in components.contract(labels, spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {n: 0 if n < 41 else 100 if n < 200 else 200 if n < 300 else 300 for n in nodes}


# runs of lines

def deleted_lines(rows, least):
    """Lines inside any run with enough words that begins earlier as well,
    found by comparing every run of every document."""
    key = lambda i, t: (i is None, i or 0, t)
    docs = sorted({(i, t) for i, t in rows if t is not None}, key=lambda d: key(*d))
    lines = {d: [(k, s) for k, s in enumerate(d[1].split("\n")) if words_of(s)] for d in docs}
    first, out = {}, collections.defaultdict(set)
    for d in docs:
        own = lines[d]
        for a in range(len(own)):
            for b in range(a, len(own)):
                run = tuple(s for _, s in own[a : b + 1])
                if sum(len(words_of(s)) for s in run) >= least:
                    first.setdefault(run, (d, a))
                    if first[run] != (d, a):
                        out[d].update(range(own[a][0], own[b][0] + 1))
    return out


def test_deleted_lines_equal_comparing_all_runs(spark):
    rng = random.Random(9)
    stock = [prose(300 + i, rng.randint(1, 9), line=100) for i in range(12)]
    rows = []
    for i in range(50):
        rows.append((rng.randrange(40), "\n".join(rng.choice([*stock, "", "  "]) if rng.random() < 0.9 else prose(rng.randrange(9999), 5, 100) for _ in range(rng.randint(0, 12)))))
    rows = list({(i, t) for i, t in rows if i not in [j for j, u in rows if u != t]})  # one text for an id: order among equal ids is by a hash
    rows += [(100, None), (101, ""), (102, "\n \n"), (None, rows[0][1]), rows[1], (103, "\n".join(["same line of words"] * 20))]
    docs = frame(spark, rows)
    want = deleted_lines(rows, 12)
    done = line_dedup.dedup_lines(docs, min_words=12).select("row.doc_id", F.col("row.text").alias("old"), "text", "n_deleted", "n_lines").collect()
    assert len(done) == len(rows) and want
    for r in done:
        gone = want.get((r.doc_id, r.old), set())
        assert r.n_deleted == len(gone) and r.n_lines == (len(r.old.split("\n")) if r.old is not None else 0)
        assert r.text == (None if r.old is None else "\n".join(s for k, s in enumerate(r.old.split("\n")) if k not in gone))
    kept = line_dedup.keep_first_copies(docs, min_words=12)
    assert kept.columns == docs.columns
    alive = [i for i, t in rows if not want.get((i, t)) or words_of("\n".join(s for k, s in enumerate(t.split("\n")) if k not in want[(i, t)]))]
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(alive)


def test_line_runs_of_awkward_and_empty_tables(spark):
    done = line_dedup.dedup_lines(frame(spark, awkward())).select("row.doc_id", "text", "n_deleted").collect()
    by_id = {(r.doc_id, r.n_deleted > 0) for r in done}
    assert len(done) == len(awkward()) and {(1, False), (6, True), (12, True), (5, False), (2, False)} <= by_id
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0
    assert line_dedup.keep_first_copies(frame(spark, [(1, "no line repeats here")])).count() == 1


# fingerprints

def test_edited_rows_equal_walking_through_the_table(spark):
    rows = [(i, t) for i, t in awkward() if i is not None]
    rows = [(i, t) for i, t in rows if [j for j, u in rows if u != t].count(i) == 0]  # one text for an id
    ordered = sorted(rows, key=lambda r: -r[0])
    texts = [t or "" for _, t in ordered]
    for partitions in (1, 3, 7):
        got = sorted(fingerprints.edited_pairs(frame(spark, rows), partitions=partitions).collect(), key=lambda r: -r.doc_id)
        assert [r.doc_id for r in got] == [i for i, _ in ordered]
        prints = fingerprints.simhashes(texts)
        for k, r in enumerate(got):
            text, following = texts[k], texts[(k + 1) % len(texts)]
            edit = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
            assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edit.encode()).hexdigest())
            assert r.fingerprint == prints[k].tobytes().hex()
            assert r.edited_fingerprint == fingerprints.simhashes([edit])[0].tobytes().hex()
            assert r.near_next == float(fingerprints.likeness(prints[k], prints[(k + 1) % len(texts)]))


def test_edited_rows_of_odd_tables(spark):
    assert fingerprints.edited_pairs(frame(spark, [])).count() == 0
    one = fingerprints.edited_pairs(frame(spark, [(1, "abcd")])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    rows = [(None, "no id"), (None, None), (2, "two"), (2, "two"), (1, None)]
    assert fingerprints.edited_pairs(frame(spark, rows)).count() == 5


def test_block_tables_find_all_within_the_radius(spark):
    rng = np.random.default_rng(11)
    base = rng.integers(0, 256, (40, 16), np.uint8)
    rows = []
    for b in base:
        for flips in (0, 1, 2, 3, 4):
            bits = np.unpackbits(b)
            bits[rng.choice(128, flips, replace=False)] ^= 1
            rows.append(np.packbits(bits))
    hexes = sorted({r.tobytes().hex() for r in rows})
    frame_ = spark.createDataFrame([(h,) for h in hexes], "fingerprint string")
    near = lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1")
    for radius, blocks in ((0, 2), (3, 4), (3, 6)):
        got = {(r.query, r.fingerprint, r.distance) for r in fingerprints.neighbours(frame_, frame_.limit(60), radius, blocks).collect()}
        asked = [r.fingerprint for r in frame_.limit(60).collect()]
        assert got == {(a, b, near(a, b)) for a in asked for b in hexes if near(a, b) <= radius}


def test_probes_find_all_within_a_radius_of_more_bits_than_blocks(spark):
    rng = np.random.default_rng(12)
    rows = [np.zeros(16, np.uint8), np.full(16, 255, np.uint8)]
    for b in rng.integers(0, 256, (30, 16), np.uint8):
        for flips in (0, 1, 5, 7, 9, 13, 14, 15, 20):
            bits = np.unpackbits(b)
            bits[rng.choice(128, flips, replace=False)] ^= 1
            rows.append(np.packbits(bits))
    hexes = sorted({r.tobytes().hex() for r in rows})
    frame_ = spark.createDataFrame([(h,) for h in [*hexes, hexes[0]]], "fingerprint string")
    near = lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1")
    for radius, blocks in ((14, 5), (13, 5), (7, 4), (6, 6)):
        got = sorted(tuple(r) for r in fingerprints.neighbours(frame_, frame_.limit(60), radius, blocks).collect())
        asked = {r.fingerprint for r in frame_.limit(60).collect()}
        assert got == sorted((a, b, near(a, b)) for a in asked for b in hexes if near(a, b) <= radius)


def test_registered_near_search_names_edited_copies(spark, tmp_path):
    from sensorweave.llm import queries

    rng = random.Random(21)
    vocabulary = [f"word{i}" for i in range(3000)]
    texts, edits = {}, {}
    for k in range(1, 41):
        words = [rng.choice(vocabulary) for _ in range(200)]
        texts[50 * k] = " ".join(words)
        for at in rng.sample(range(200), 3):
            words[at] = rng.choice(vocabulary)
        texts[50 * k + 7] = " ".join(words)
        edits[50 * k] = 50 * k + 7
    texts |= {5001: texts[50], 5002: texts[57], 5050: texts[50]}  # copies of a text and of its edit
    frame(spark, list(texts.items())).write.parquet(f"{tmp_path}/documents.parquet")
    result = queries.op7_fingerprints(spark, str(tmp_path)).cache()
    prints = {i: p[0] for i, p in zip(texts, np.split(fingerprints.simhashes(list(texts.values())), len(texts)))}
    far = lambda a, b: int(np.bitwise_count(prints[a] ^ prints[b]).sum())
    expected = {(a, b, far(a, b)) for a in texts for b in texts if a % 50 == 0 and a != b and far(a, b) <= fingerprints.RADIUS}
    assert {tuple(r) for r in fingerprints.neighbour_ids(result).collect()} == expected
    assert sum((a, b) in {e[:2] for e in expected} for a, b in edits.items()) >= 36
    rows_ = {r.doc_id: r for r in result.collect()}
    assert len(rows_) == len(texts)
    for i, r in rows_.items():
        assert (r.near is None) == (r.n_near is None) == (i % 50 != 0)
        if r.near:
            assert r.n_near == sum(e[0] == i for e in expected) == sum(e.n for e in r.near) - 1
            assert all(e.first_id == min(j for j in texts if prints[j].tobytes().hex() == e.fingerprint) for e in r.near)


def test_long_range_lists_are_looked_up_in_two_steps(spark):
    bounds = sorted(random.Random(3).sample(range(1000), 37))
    df = spark.range(1000).select("id", fingerprints._range_of(F.col("id"), bounds).alias("r"))
    assert all(r.r == sum(b < r.id for b in bounds) for r in df.collect())


# packing

def test_pieces_and_sequences(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    extra = [(30, "It's <|endoftext|> here, O'K. x,y ..."), (31, "É.a é, ﬁ ½ \x1c \x85 z"), (32, "Don't. STOP.,. <|ENDOFTEXT|>")]
    rows = [*awkward(), *extra]
    got = packing.pack_documents(frame(spark, rows), capacity=64).collect()
    want = []
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(i, k, a, len(ids[a : a + 64]), zlib.crc32(ids[a : a + 64].tobytes())) for k, a in enumerate(range(0, len(ids), 64))]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    places = collections.defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack_documents(frame(spark, [])).count() == 0


def test_pieces_can_carry_their_ids(spark):
    got = packing.pack_documents(frame(spark, [(1, "some words here"), (2, None)]), with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got)


def squares_after(gaps, gap, size, capacity):
    count = collections.Counter(gaps)
    if gap is not None:
        count[gap] -= 1
    count[(capacity if gap is None else gap) - size] += 1
    return sum(n * n for g, n in count.items() if g)


def test_every_piece_goes_where_the_squares_become_smallest():
    rng = np.random.default_rng(12)
    for capacity in (10, 37):
        lengths = rng.integers(1, capacity + 1, 300)
        sequence, offset = packing.place(lengths, capacity)
        gaps: dict[int, int] = {}
        for size, s, at in zip(lengths.tolist(), sequence.tolist(), offset.tolist()):
            open_ = [g for g in gaps.values() if g]
            options = {g: squares_after(open_, g, size, capacity) for g in set(open_) if g >= size} | {None: squares_after(open_, None, size, capacity)}
            taken = None if s not in gaps else gaps[s]
            assert options[taken] == min(options.values()) and at == capacity - (capacity if taken is None else taken)
            gaps[s] = (capacity if taken is None else taken) - size
        assert min(gaps.values()) >= 0


def test_packing_loses_little(spark):
    lengths = np.sort(np.random.default_rng(13).lognormal(6.3, 1.0, 20_000).astype(int).clip(1, 4096))[::-1]
    sequence, _ = packing.place(lengths, 4096)
    assert sequence.max() + 1 <= 1.01 * -(-int(lengths.sum()) // 4096)


# the pipeline

def test_stages_keep_columns_and_each_does_its_work(spark, tmp_path):
    import corpus_pipeline

    text = prose(1, 90)
    passage = prose(77, 60, line=1000)
    rows = [(1, text), (2, text), (3, text.replace("the", "THE") + " end"), (4, passage + "\n" + prose(2, 60)), (5, prose(3, 60) + "\n" + passage),
            (6, "write to a.b@c.de " + prose(6, 50)), (7, "too short"), (8, None), (None, prose(9, 60))]
    docs = frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1), (4, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "pii", "packing"]
    state = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        state = corpus_pipeline.stored(stage(spark, state, str(tmp_path)), name)
        seen[name] = {r.doc_id: r for r in state.collect()}
        if name != "packing":
            assert state.columns == docs.columns
            assert all(r.n_chars == len(r.text) for n, r in seen[name].items() if name in ("line_dedup", "pii"))
    assert set(seen["quality_rules"]) == {1, 2, 3, 4, 5, 6, None}
    assert set(seen["line_dedup"]) == {1, 3, 4, 5, 6, None} and seen["line_dedup"][5].text == prose(3, 60)
    assert seen["line_dedup"][4].text == rows[3][1]
    assert 1 in seen["near_dedup"] and None in seen["near_dedup"]
    assert "[EMAIL]" in seen["pii"][6].text and "@" not in seen["pii"][6].text
    assert set(seen["packing"]) == set(seen["pii"])
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted((r.doc_id or -1, r.ids_crc32) for r in got.collect()) == sorted((i or -1, r.ids_crc32) for i, r in seen["packing"].items())

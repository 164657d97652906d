"""SimHash fingerprints of whole texts, and search within a Hamming radius.

The terms of a text are its words and pairs of neighbouring words; a term's
weight grows with the logarithm of its count. Every term's ``BITS``-bit hash
votes with its weight for or against each bit. ``block_keys`` cuts fingerprints
into blocks: where two differ in at most ``radius`` bits, at least
``blocks - radius`` blocks agree, so one of the tables that are keyed by that
many blocks holds both. A radius of ``blocks`` bits or more leaves no block that
must agree; then ``block_values`` keys a table by each block, and ``probes``
looks in it for all values that differ in the few bits of ``allowed``: the
allowances and one more for each block add up to ``radius + 1``, so some block of
any two within the radius keeps to its own. ``neighbours`` joins on these keys
and checks the distance, which finds every pair within the radius;
``neighbour_ids`` names the rows.

``edited_pairs`` sets each document beside the next one by descending id. Ids
are cut into ranges at quantiles; the first document of a range is sent to the
range above it as well, so one shuffle of the compressed texts brings every
document and its successor together, and a task holds two texts and a block of
rows at a time.

Defined cases: null text counts as empty; texts without words have the
fingerprint 0; rows of one id follow each other by a hash of their text; null
ids come last; a single row is followed by itself; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.llm.common import by_bytes
from sensorweave.llm.shingles import mix, word_hashes
from sensorweave.session import shuffle_partitions

BITS = 128
PAIR_WEIGHT = 1.0
#: Bits that near copies may differ in: words changed at random, 1 or 2 in a
#: hundred, flip 7 to 9 (median) and rarely more than 14; other texts nearly
#: always differ in more than 40. Five blocks may then differ in two bits each.
RADIUS = 14
BLOCKS = 5
_NUMBER_AT = 56
_VOTES_AT_ONCE = 1 << 15
_BLOCK_BYTES = 1 << 20
_SALTS = np.random.default_rng(7).integers(0, 1 << 64, BITS // 64, np.uint64)


def simhashes(texts: list[str | None]) -> np.ndarray:
    """Fingerprints as rows of ``BITS // 8`` bytes."""
    words, bounds = word_hashes(pa.array(texts, pa.large_string()))
    pairs = mix(words[:-1] * np.uint64(3) + words[1:]) if len(words) > 1 else words[:0]
    out = np.zeros((len(texts), BITS // 8), np.uint8)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if a == b:
            continue
        votes = np.zeros(BITS, np.float64)
        for terms, weight in ((words[a:b], 1.0), (pairs[a : b - 1], PAIR_WEIGHT)):
            unique, counts = np.unique(terms, return_counts=True)
            weights = (weight * (1 + np.log(counts))).astype(np.float32)
            for k in range(0, len(unique), _VOTES_AT_ONCE):
                part, w = unique[k : k + _VOTES_AT_ONCE], weights[k : k + _VOTES_AT_ONCE]
                wide = np.stack([mix(part + _SALTS[j]) for j in range(BITS // 64)], axis=1)
                bits = np.unpackbits(wide.view(np.uint8).reshape(len(part), -1), axis=1).astype(np.float32)
                votes += 2.0 * (w @ bits) - w.sum()
        out[i] = np.packbits(votes > 0)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits of rows of fingerprints."""
    return 1.0 - np.bitwise_count(a ^ b).sum(axis=-1) / BITS


def fingerprint(text: Column) -> Column:
    """Fingerprint of a text column, in hexadecimal."""

    @F.arrow_udf("string")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            sizes = [n or 0 for n in pc.binary_length(texts).to_pylist()]
            yield pa.array([row.tobytes().hex() for a, b in by_bytes(sizes, _BLOCK_BYTES)
                            for row in simhashes(texts.slice(a, b - a).to_pylist())], pa.string())

    return simhash(text)


def block_keys(hexes: Column, radius: int, blocks: int) -> Column:
    """Keys of a fingerprint in the permuted tables: one for each choice of
    ``blocks - radius`` blocks."""
    if not 0 <= radius < blocks:
        raise ValueError("there must be more blocks than bits that may differ")
    digits = BITS // 4
    cuts = [round(i * digits / blocks) for i in range(blocks + 1)]
    part = [F.substring(hexes, a + 1, b - a) for a, b in zip(cuts, cuts[1:])]
    tables = combinations(range(blocks), blocks - radius)
    return F.array(*[F.xxhash64(F.lit(t), *[part[i] for i in chosen]) for t, chosen in enumerate(tables)])


def distance(a: Column, b: Column) -> Column:
    """Hamming distance of fingerprints in hexadecimal."""
    word = lambda c, i: F.conv(F.substring(c, 8 * i + 1, 8), 16, 10).cast("long")
    return sum((F.bit_count(word(a, i).bitwiseXOR(word(b, i))) for i in range(BITS // 32)), F.lit(0))


def _bounds(blocks: int) -> list[tuple[int, int]]:
    """First bit of each block and the one after its last, from the left."""
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    return list(zip(cuts, cuts[1:]))


def allowed(radius: int, blocks: int) -> list[int]:
    """Bits that may differ in each block: of two fingerprints within the
    radius, at least one block differs in no more."""
    return [(radius + 1) // blocks - 1 + (i < (radius + 1) % blocks) for i in range(blocks)]


def block_values(high: Column, low: Column, blocks: int) -> list[Column]:
    """Number of each block (in the top bits) and its bits, of the halves of a
    fingerprint."""
    if blocks < 3:
        raise ValueError("a block and its number must fit 64 bits")
    ones = lambda n: F.lit((1 << n) - 1)
    values = []
    for i, (a, b) in enumerate(_bounds(blocks)):
        left, right = max(0, min(b, 64) - a), max(0, b - max(a, 64))  # bits of the block in either half
        value = F.lit(i << _NUMBER_AT)
        if left:
            value = value.bitwiseOR(F.shiftleft(F.shiftrightunsigned(high, 64 - min(b, 64)).bitwiseAND(ones(left)), right))
        if right:
            value = value.bitwiseOR(F.shiftrightunsigned(low, BITS - b).bitwiseAND(ones(right)))
        values.append(value)
    return values


def probes(high: Column, low: Column, radius: int, blocks: int) -> Column:
    """All values of a block that differ from its own in the allowed bits."""

    def flipped(value: Column, size: int, most: int) -> Column:
        masks = [sum(1 << bit for bit in bits) for n in range(most + 1) for bits in combinations(range(size), n)]
        return F.transform(F.expr(f"array({','.join(f'{m}L' for m in masks)})"), lambda m: value.bitwiseXOR(m))

    return F.concat(*[flipped(value, b - a, most) for value, (a, b), most in zip(block_values(high, low, blocks), _bounds(blocks), allowed(radius, blocks))])


def _probed(index: DataFrame, queries: DataFrame, radius: int, blocks: int) -> DataFrame:
    """``neighbours`` by probing; a pair is formed only by the first of its
    blocks that keeps to its allowance, so none comes twice."""
    n = shuffle_partitions(index.sparkSession)
    half = lambda i: F.conv(F.substring("fingerprint", 16 * i + 1, 16), 16, -10).cast("long")
    # distinct first, so copies of one text meet as partial results; then a given
    # number of partitions: few queries become many probes
    halves = lambda df, h, l: df.select("fingerprint").where("fingerprint is not null").distinct().repartition(n).select(half(0).alias(h), half(1).alias(l))
    asked = halves(queries, "qh", "ql").select("qh", "ql", F.explode(probes(F.col("qh"), F.col("ql"), radius, blocks)).alias("probe"))
    held = halves(index, "fh", "fl").select("fh", "fl", F.explode(F.array(*block_values(F.col("fh"), F.col("fl"), blocks))).alias("key"))
    high, low = F.col("qh").bitwiseXOR(F.col("fh")), F.col("ql").bitwiseXOR(F.col("fl"))
    apart = (F.bit_count(high) + F.bit_count(low)).cast("int")
    first = F.lit(None).cast("long")
    for i, (part, most) in reversed(list(enumerate(zip(block_values(high, low, blocks), allowed(radius, blocks))))):
        bits = F.bit_count(part.bitwiseAND(F.lit((1 << _NUMBER_AT) - 1)))
        first = F.when(bits <= most, F.lit(i).cast("long")).otherwise(first)
    # the size that is planned with is that before the probes: no broadcast of them
    near = asked.hint("merge").join(held, (F.col("probe") == F.col("key")) & (apart <= radius) & (first == F.shiftrightunsigned("key", _NUMBER_AT)))
    text = lambda h, l: F.lower(F.concat(F.lpad(F.hex(h), 16, "0"), F.lpad(F.hex(l), 16, "0")))
    return near.select(text("qh", "ql").alias("query"), text("fh", "fl").alias("fingerprint"), apart.alias("distance"))


def neighbours(index: DataFrame, queries: DataFrame, radius: int = 3, blocks: int = 4) -> DataFrame:
    """``(query, fingerprint, distance)``: for every fingerprint among
    ``queries``, the fingerprints of ``index`` within the radius (itself
    included where it is one of them). Both hold a ``fingerprint`` column;
    equal ones are compared once, however many rows share them."""
    if radius >= blocks:
        return _probed(index, queries, radius, blocks)
    keyed = lambda df, name: df.select(F.col("fingerprint").alias(name)).distinct().withColumn("key", F.explode(block_keys(F.col(name), radius, blocks)))
    near = keyed(queries, "query").join(keyed(index, "fingerprint"), "key")
    return near.withColumn("distance", distance(F.col("query"), F.col("fingerprint"))).where(F.col("distance") <= radius).drop("key").distinct()


def near_lists(marked: DataFrame, asked: Column, radius: int = RADIUS, blocks: int = BLOCKS, id_col: str = "doc_id") -> DataFrame:
    """``marked`` (rows of ids and fingerprints) with ``n_near`` and ``near``
    beside the rows for which ``asked`` holds, null beside the others: the number
    of other rows within the radius, and every distinct fingerprint within it
    (the row's own first) with its distance, its smallest id and the number of
    its rows. All ids of a listed fingerprint are the rows of the table that hold
    it, so copies are never paired with copies."""
    asked = F.coalesce(asked, F.lit(False))
    groups = marked.groupBy("fingerprint").agg(F.min(id_col).alias("first_id"), F.count("*").alias("n"))
    pairs = neighbours(marked, marked.where(asked).select("fingerprint"), radius, blocks).join(groups, "fingerprint")
    entry = F.struct("distance", "fingerprint", "first_id", "n")
    lists = pairs.groupBy("query").agg((F.sum("n") - 1).alias("n_near"), F.sort_array(F.collect_list(entry)).alias("near"))
    found = marked.where(asked).join(lists, F.col("fingerprint") == F.col("query")).drop("query")
    kinds = {f.name: f.dataType for f in lists.schema}
    rest = marked.where(~asked).withColumns({c: F.lit(None).cast(kinds[c]) for c in ("n_near", "near")})
    return rest.unionByName(found)


def neighbour_ids(listed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, near_id, distance)``: the lists of ``near_lists`` by the ids of all
    rows within the radius, without the row's own id."""
    entries = listed.where("near is not null").select(id_col, F.explode("near").alias("entry")).select(id_col, "entry.fingerprint", "entry.distance")
    members = listed.select("fingerprint", F.col(id_col).alias("near_id"))
    return entries.join(members, "fingerprint").where(~F.col("near_id").eqNullSafe(F.col(id_col))).select(id_col, "near_id", "distance")


def _range_of(order: Column, bounds: list[int]) -> Column:
    """Number of bounds below ``order``, by two steps over about sqrt(n) bounds."""
    if not bounds:
        return F.lit(0)
    width = max(1, int(len(bounds) ** 0.5))
    chunks = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    array = lambda xs: F.array(*[F.lit(x) for x in xs])
    below = lambda xs: F.size(F.filter(xs, lambda b: b < order))
    chunk = below(array([c[-1] for c in chunks]))
    inside = chunk * width + below(F.get(F.array(*[array(c) for c in chunks]), chunk))
    return F.when(chunk < len(chunks), inside).otherwise(F.lit(len(bounds)))


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)`` of every row: the edited text is its own with the
    last half replaced by the beginning of the next row's text."""
    spark = docs.sparkSession
    n = partitions or shuffle_partitions(spark)
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    ids = docs.select(order.alias("order"))
    cuts = ids.select(F.percentile_approx("order", [i / n for i in range(1, n)], 10_000)).first()[0] if n > 1 else []
    bounds = sorted(set(cuts or []))
    heads = {r[0]: r[1] for r in ids.groupBy(_range_of(F.col("order"), bounds).alias("range")).agg(F.max("order")).collect()}  # one row a range
    if not heads:
        heads = {0: 0}
    filled = sorted(heads)
    above = {r: filled[(i + 1) % len(filled)] for i, r in enumerate(filled)}  # the top range's first row follows the lowest row
    lookup = lambda values: F.array(*[F.lit(values.get(r)).cast("long") for r in range(max(filled) + 1)])

    @F.arrow_udf("binary")
    def shrink(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        for texts in batches:
            yield pa.array([press.compress((t.as_py() or "").encode()) for t in texts], pa.binary())

    rows = docs.select(F.col(id_col).alias("id"), order.alias("order"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("range", _range_of(F.col("order"), bounds).cast("long"))
    sent = F.when(F.get(lookup(heads), F.col("range").cast("int")) == F.col("order"),
                  F.array(F.struct(F.col("range").alias("to"), F.lit(False).alias("guest")),
                          F.struct(F.get(lookup(above), F.col("range").cast("int")).alias("to"), F.lit(True).alias("guest"))))
    sent = sent.otherwise(F.array(F.struct(F.col("range").alias("to"), F.lit(False).alias("guest"))))
    rows = (rows.select("id", "order", F.xxhash64("text").alias("tie"), shrink(F.col("text")).alias("packed"), F.explode(sent).alias("sent"))
            .select("id", "order", "tie", "packed", "sent.*"))
    dealt = rows.repartitionById(n, F.col("to").cast("int")).sortWithinPartitions("to", "guest", F.desc("order"), "tie")

    names = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [T.LongType(), T.StringType(), T.StringType(), T.StringType(), T.DoubleType(), T.DoubleType()]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *map(T.StructField, names, kinds)])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        plain = zstandard.ZstdDecompressor()
        waiting = None  # (range, id, text, fingerprint) of a row whose next one is to come
        for batch in batches:
            sizes = [len(x) * 4 for x in batch.column("packed").to_pylist()]
            for a, b in by_bytes(sizes, _BLOCK_BYTES):
                part = batch.slice(a, b - a)
                texts = [plain.decompress(x).decode() for x in part.column("packed").to_pylist()]
                prints = simhashes(texts)
                done = []
                for row, to, guest, text, own in zip(part.column("id"), part.column("to").to_pylist(), part.column("guest").to_pylist(), texts, prints):
                    if waiting and waiting[0] == to:
                        done.append((*waiting[1:], text, own))
                    waiting = None if guest else (to, row, text, own)
                edits = [t[: len(t) - len(t) // 2] + nxt[: len(t) // 2] for _, t, _, nxt, _ in done]
                own = np.array([d[2] for d in done], np.uint8).reshape(-1, BITS // 8)
                following = np.array([d[4] for d in done], np.uint8).reshape(-1, BITS // 8)
                edited = simhashes(edits) if edits else own
                yield pa.RecordBatch.from_arrays([
                    pa.array([d[0].as_py() for d in done], part.schema.field("id").type), pa.array([len(d[1]) for d in done], pa.int64()),
                    pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edits], pa.string()),
                    pa.array([x.tobytes().hex() for x in own], pa.string()), pa.array([x.tobytes().hex() for x in edited], pa.string()),
                    pa.array(likeness(own, edited), pa.float64()), pa.array(likeness(own, following), pa.float64())], schema.names)

    return dealt.select("id", "to", "guest", "packed").mapInArrow(compare, schema)

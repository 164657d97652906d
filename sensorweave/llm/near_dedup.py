"""Near-duplicate groups by HyperMinHash sketches, checked on full shingle sets.

A sketch has ``BUCKETS`` registers. The hash range is dealt evenly to the
buckets; a register keeps the smallest hash of its bucket as the count of its
leading zeros and the ``MANTISSA`` bits after them. Empty buckets borrow a
register along a fixed order of their own, so that a register of two sets
agrees with the probability of their similarity. Bands of ``ROWS`` registers
give candidate pairs; the number of agreeing registers, less those expected to
agree by chance, estimates a pair's similarity, and pairs far below the
threshold (``SIGMAS`` standard errors) are dropped before the check on full
sets. At similarity 0.75 all bands of a pair differ with probability 1e-8, and
the estimate drops it with less than 1e-8.

Texts of equal shingle sets are one class, and only its smallest id goes on.
Within a band's group of classes, each is first compared with the smallest one.
Of the groups that still hold several components, those of up to
``SMALL_GROUP`` members give their remaining pairs. Larger ones that share
their largest component are put together as a family: its members outside that
component are compared with all its members, by an inverted list of their
shingles, in blocks of bounded size; a block returns no more links than it has
rows. So the components are those of all links between candidates, while the
rows that are passed on follow the size of a group and not its square.

Defined cases: null, empty and blank texts have the empty set and are linked
with nothing; fewer words than a shingle form one shingle; rows of one id are
one document, linked as soon as one of its texts is; a row with a null id is
linked with nothing, has a null component and is kept; ties go to the smaller
id; an empty table gives an empty result; other columns are not read. ``keep_one``
also keeps repeated rows (one id and text) once, and rows without an id once for
each shingle set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.llm.common import BATCH_BYTES, by_bytes, stored
from sensorweave.llm.components import contract
from sensorweave.llm.shingles import mix, shingle_sets

SHINGLE_WORDS = 5
THRESHOLD_PCT = 75
BUCKETS = 192
MANTISSA = 10
ROWS = 4
BANDS = BUCKETS // ROWS
SIGMAS = 6.0
#: Members of a band's group up to which its pairs are formed.
SMALL_GROUP = 16
#: A block of a family holds about so many members, and so many shingles.
BLOCK_MEMBERS = 512
BLOCK_SHINGLES = 1 << 20
#: Ids (8 bytes each) that are broadcast instead of shuffling the texts.
BROADCAST_IDS = 1_000_000

_BOUNDS = np.array([-(-(i << 64) // BUCKETS) for i in range(BUCKETS)], np.uint64)
#: The order in which an empty bucket looks for a register, by bucket.
_ORDERS = np.stack([np.random.default_rng(1000 + i).permutation(BUCKETS) for i in range(BUCKETS)])
_WIDTH_BITS = 57  # of the widest bucket


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a sorted set of 64-bit hashes; 0 marks an empty bucket."""
    spread = np.sort(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)))
    first = np.searchsorted(spread, _BOUNDS)
    filled = first < np.append(first[1:], len(spread))
    least = (spread[first[filled]] - _BOUNDS[filled]) >> np.uint64(_WIDTH_BITS - 49)
    exponent = np.frexp(least.astype(np.float64))[1].astype(np.int64)  # bits in use, exact below 2^53
    lead = np.maximum(exponent - 1 - MANTISSA, 0).astype(np.uint64)
    pad = np.maximum(MANTISSA + 1 - exponent, 0).astype(np.uint64)
    mantissa = ((least >> lead) << pad) & np.uint64((1 << MANTISSA) - 1)
    out = np.zeros(BUCKETS, np.uint16)
    out[filled] = ((50 - exponent) << MANTISSA) | mantissa.astype(np.int64)
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit key per band over the sketch with its empty buckets filled."""
    filled = sketch > 0
    if not filled.all():
        empty = np.flatnonzero(~filled)
        orders = _ORDERS[empty]
        sketch = sketch.copy()
        sketch[empty] = sketch[orders[np.arange(len(empty)), filled[orders].argmax(axis=1)]]
    rows = sketch.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        key = mix((key << np.uint64(16)) ^ rows[:, r] ^ (key >> np.uint64(48)))
    return key


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected similarity of rows of sketches, and the number of
    buckets that it rests on. A register agrees by chance with a probability of
    about 0.1699 * 4 q / (1 + q)^2 / 2^MANTISSA, q the ratio of the set sizes."""
    used = ((a > 0) | (b > 0)).sum(axis=1)
    equal = ((a == b) & (a > 0)).sum(axis=1)
    q = np.maximum(n_a, n_b) / np.maximum(np.minimum(n_a, n_b), 1)
    chance = 0.169919487159739 * 4 * q / (1 + q) ** 2 / (1 << MANTISSA)
    n = np.maximum(used, 1)
    return (equal - chance * (used - equal)) / n, n


def _id_lists(arrays: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(x) for x in arrays]), pa.int32()), pa.array(flat.view(np.int64), pa.int64()))


def _by_size(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts in parts of a bounded number of bytes."""
    for batch in batches:
        sizes = [n or 0 for n in pc.binary_length(batch.column(1)).to_pylist()]
        for a, b in by_bytes(sizes, BATCH_BYTES):
            yield batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a)


def sketch_documents(docs: DataFrame) -> DataFrame:
    """``(node, n_shingles, set_key, sketch, bands)`` of every ``(node, text)``."""
    schema = T.StructType([
        docs.schema["node"], T.StructField("n_shingles", T.LongType()), T.StructField("set_key", T.BinaryType()),
        T.StructField("sketch", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType(), False))])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for ids, texts in _by_size(batches):
            sets = shingle_sets(texts, SHINGLE_WORDS)
            sketches = [registers(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([len(s) for s in sets], pa.int64()), pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()),
                pa.array([None if s is None else s.tobytes() for s in sketches], pa.binary()),
                _id_lists([np.empty(0, np.uint64) if s is None else band_keys(s) for s in sketches])], schema.names)

    return docs.select("node", "text").mapInArrow(sketch, schema)


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(node, shingles)`` of those ``(node, text)`` whose node is ``wanted``.
    A list of up to ``BROADCAST_IDS`` ids, counted first, is sent to the texts;
    a longer one is joined."""
    wanted = stored(wanted, "wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _by_size(batches):
            yield pa.RecordBatch.from_arrays([ids, _id_lists(shingle_sets(texts, SHINGLE_WORDS))], ["node", "shingles"])

    schema = T.StructType([docs.schema["node"], T.StructField("shingles", T.ArrayType(T.LongType(), False))])
    return stored(docs.join(wanted, "node", "left_semi").select("node", "text").mapInArrow(sets, schema), "sets")


def _likely(u: Column, v: Column, n_u: Column, n_v: Column, threshold: float) -> Column:
    """Whether the estimate leaves a pair's similarity possible."""

    @F.arrow_udf("boolean")
    def likely(a: pa.Array, b: pa.Array, n_a: pa.Array, n_b: pa.Array) -> pa.Array:
        rows = lambda x: np.frombuffer(b"".join(x.to_pylist()), np.uint16).reshape(-1, BUCKETS)
        value, n = estimate(rows(a), rows(b), n_a.to_numpy(zero_copy_only=False), n_b.to_numpy(zero_copy_only=False))
        return pa.array(value >= threshold - SIGMAS * np.sqrt(threshold * (1 - threshold) / n))

    return likely(u, v, n_u, n_v)


def confirm(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, pct: int) -> DataFrame:
    """The ``(u, v)`` of ``pairs`` whose sets have the similarity, first by the
    estimate from the sketches in ``nodes``, then on the full sets of the texts."""
    side = lambda df, name, *cols: df.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in cols])
    near = (pairs.join(side(nodes, "u", "sketch", "n_shingles"), "u").join(side(nodes, "v", "sketch", "n_shingles"), "v")
            .where("100 * least(n_shingles_u, n_shingles_v) >= %d * greatest(n_shingles_u, n_shingles_v)" % pct)
            .where(_likely(F.col("sketch_u"), F.col("sketch_v"), F.col("n_shingles_u"), F.col("n_shingles_v"), pct / 100))
            .select("u", "v").distinct())
    near = stored(near, "candidates")
    if near.isEmpty():
        return near
    sets = full_sets(docs, near.select(F.col("u").alias("node")).union(near.select("v")).distinct())
    both = F.size(F.array_intersect("shingles_u", "shingles_v"))
    whole = F.size("shingles_u") + F.size("shingles_v") - F.col("__both")
    return stored(near.join(side(sets, "u", "shingles"), "u").join(side(sets, "v", "shingles"), "v").withColumn("__both", both)
                  .where(100 * F.col("__both") >= pct * whole).select("u", "v"), "links")


def _ordered(u: str, v: str) -> list[Column]:
    return [F.least(u, v).alias("u"), F.greatest(u, v).alias("v")]


def link_components(sketched: DataFrame, nodes: DataFrame, docs: DataFrame, pct: int) -> DataFrame:
    """``(node, comp)`` of every node that shares a band with another one."""
    bands = sketched.select("node", F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last").select("key", "hub")
    groups = stored(bands.join(shared, "key").select("key", "node", "hub").distinct(), "bands")
    nodes = stored(nodes.join(groups.select("node").distinct(), "node", "left_semi"), "nodes")
    labels = nodes.select("node", F.col("node").alias("comp")).distinct()

    first = groups.where("node <> hub").select(F.col("hub").alias("u"), F.col("node").alias("v")).distinct()
    labels = contract(labels, confirm(first, nodes, docs, pct))

    # groups that still hold several components
    named = groups.select("key", "node").join(labels, "node")
    parts = named.groupBy("key", "comp").agg(F.count("*").alias("n"))
    opened = (parts.groupBy("key").agg(F.sum("n").alias("members"), F.count("*").alias("parts"), F.max(F.struct("n", "comp"))["comp"].alias("family"))
              .where("parts > 1").select("key", "members", "family"))
    left = stored(named.join(opened, "key").select("key", "node", "comp", "members", "family"), "open")
    small = left.where(F.col("members") <= SMALL_GROUP)
    movers = small.where("comp <> family").select("key", F.col("node").alias("mover"), F.col("comp").alias("mover_comp"))
    pairs = small.join(movers, "key").where("comp <> mover_comp").select(*_ordered("node", "mover")).distinct()
    large = left.where(F.col("members") > SMALL_GROUP).select("family", "node", "comp").distinct()
    return contract(labels, confirm(pairs, nodes, docs, pct).union(family_links(large, nodes, docs, pct)))


def linking_pairs(movers: list[np.ndarray], members: list[np.ndarray], pct: int) -> Iterator[tuple[int, np.ndarray]]:
    """For every mover the members whose sets have the similarity."""
    sizes = np.array([len(m) for m in members], np.int64)
    owner = np.repeat(np.arange(len(members)), sizes)
    flat = np.concatenate(members)
    order = np.argsort(flat, kind="stable")
    owner, (distinct, begin, count) = owner[order], np.unique(flat[order], return_index=True, return_counts=True)
    for i, own in enumerate(movers):
        at = np.searchsorted(distinct, own)
        at = at[(at < len(distinct)) & (distinct[np.minimum(at, len(distinct) - 1)] == own)]
        lengths = count[at]
        starts = np.repeat(begin[at] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) if len(at) else np.empty(0, np.int64)
        both = np.bincount(owner[starts + np.arange(len(starts))], minlength=len(members))
        yield i, np.flatnonzero((both > 0) & (100 * both >= pct * (len(own) + sizes - both)))


def family_links(large: DataFrame, nodes: DataFrame, docs: DataFrame, pct: int) -> DataFrame:
    """Links ``(u, v)`` that join the components ``comp`` of ``(family, node,
    comp)`` wherever a member outside the component ``family`` has the similarity
    with any other member."""
    large = stored(large, "families")
    node_type = large.schema["node"].dataType
    links = T.StructType([T.StructField("u", node_type), T.StructField("v", node_type)])
    if large.isEmpty():
        return docs.sparkSession.createDataFrame([], links)
    sets = full_sets(docs, large.select("node").distinct())
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_MEMBERS, F.sum("n_shingles") / BLOCK_SHINGLES, F.lit(1.0))).cast("int")
    sizes = large.join(nodes.select("node", "n_shingles"), "node").groupBy("family").agg(blocks.alias("blocks"))
    dealt = (large.join(sizes, "family").withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    member = dealt.select("family", "node", "comp", F.col("other").alias("a"), F.col("own").alias("b"), F.lit(False).alias("mover"))
    mover = dealt.where("comp <> family").select("family", "node", "comp", F.col("own").alias("a"), F.col("other").alias("b"), F.lit(True).alias("mover"))

    def compare(rows: pa.Table) -> pa.Table:
        sides = [rows.filter(pc.equal(rows["mover"], flag)).sort_by("node") for flag in (True, False)]
        ids = [side["node"].to_pylist() for side in sides]
        comps = [side["comp"].to_pylist() for side in sides]
        lists = [[x.values.to_numpy() for x in side["shingles"]] for side in sides]
        parent: dict = {}

        def root(x):
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        found = []
        for i, linked in linking_pairs(*lists, pct) if ids[0] and ids[1] else ():
            for j in linked.tolist():
                x, y = root(comps[0][i]), root(comps[1][j])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    found.append((ids[0][i], ids[1][j]))
        return pa.table({"u": pa.array([f[0] for f in found], rows.schema.field("node").type), "v": pa.array([f[1] for f in found], rows.schema.field("node").type)})

    rows = member.union(mover).join(sets, "node").select("family", "a", "b", "node", "comp", "mover", "shingles")
    return stored(rows.groupBy("family", "a", "b").applyInArrow(compare, links), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pct: int = THRESHOLD_PCT) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` for every row of ``docs``."""
    if pct < THRESHOLD_PCT:
        raise ValueError(f"the bands are laid out for a similarity of {THRESHOLD_PCT} % or more")
    texts = docs.select(F.col(id_col).alias("node"), F.col(text_col).cast("string").alias("text"))
    sketched = stored(sketch_documents(texts), "sketches")
    usable = sketched.where("node is not null and n_shingles > 0")
    # classes: texts of one set, and rows of one id
    classes = (usable.groupBy("set_key").agg(F.min("node").alias("first"), F.max("node").alias("last"))
               .where("first < last").select("set_key", "first"))
    members = stored(usable.select("node", "set_key").join(classes, "set_key", "left")
                     .select("node", F.coalesce("first", "node").alias("first")).distinct(), "classes")
    leads = usable.join(classes, "set_key", "left").where("first is null or first = node").drop("first", "set_key")
    linked = link_components(leads.select("node", "bands"), leads.select("node", "n_shingles", "sketch"), texts, pct)
    # an id with several texts belongs to several classes: those are one
    ties = stored(members.groupBy("node").agg(F.min("first").alias("u"), F.max("first").alias("v")).where("u < v").select("node"), "ties")
    if not ties.isEmpty():
        tied = members.join(ties, "node").select(F.col("node").alias("u"), F.col("first").alias("v")).where("u <> v").distinct()
        extra = tied.select("u").union(tied.select("v")).distinct().withColumnRenamed("u", "node")
        extra = extra.join(linked, "node", "left_anti").select("node", F.col("node").alias("comp"))
        linked = contract(stored(linked.union(extra), "components"), stored(tied, "links"))
    named = (members.join(linked.withColumnRenamed("node", "first"), "first", "left")
             .groupBy("node").agg(F.min(F.coalesce("comp", "first")).alias("component_id")).where("component_id < node"))
    return (sketched.select("node", "n_shingles").join(named, "node", "left")
            .select(F.col("node").alias(id_col), "n_shingles", F.coalesce("component_id", "node").alias("component_id"),
                    F.coalesce(F.col("node") == F.coalesce("component_id", "node"), F.lit(True)).alias("kept")))


def set_keys(texts: Column) -> Column:
    """The key of a text's shingle set; null where it is empty."""

    @F.arrow_udf("binary")
    def keys(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import hashlib

        for batch in batches:
            sizes = [n or 0 for n in pc.binary_length(batch).to_pylist()]
            yield pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for a, b in by_bytes(sizes, BATCH_BYTES)
                            for s in shingle_sets(batch.slice(a, b - a), SHINGLE_WORDS)], pa.binary())

    return keys(texts)


def drop_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each id and text, and of the rows without an id
    one of each shingle set (those of the empty set all stay)."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    least = lambda rows, *keys: rows.groupBy(*keys).agg(F.min_by(row, F.to_json(row)).alias("__row")).select("__row.*")
    text = F.col(text_col).cast("string")
    hashed = docs.withColumn("__hash", F.xxhash64(text))
    repeated = stored(hashed.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id"), F.col("__hash").alias("__of")).agg(F.count("*").alias("__n"))
                      .where("__n > 1").select("__id", "__of"), "repeated")
    out = docs
    if not repeated.isEmpty():
        same = (F.col(id_col) == F.col("__id")) & (F.col("__hash") == F.col("__of"))
        out = hashed.join(repeated, same, "left_anti").drop("__hash").unionByName(
            least(hashed.join(repeated, same, "left_semi").drop("__hash"), F.col(id_col), text))
    if not docs.where(F.col(id_col).isNull()).isEmpty():
        nameless = docs.where(F.col(id_col).isNull()).withColumn("__set", set_keys(text))
        out = (out.where(F.col(id_col).isNotNull()).unionByName(nameless.where("__set is null").drop("__set"))
               .unionByName(least(nameless.where("__set is not null"), "__set")))
    return out


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pct: int = THRESHOLD_PCT) -> DataFrame:
    """The rows of ``docs`` that are the smallest id of their group, each id and
    text once, and one of the rows without an id of each shingle set."""
    gone = near_duplicates(docs, id_col, text_col, pct).where("not kept").select(F.col(id_col).alias("__gone")).distinct()
    return drop_repeated(docs, id_col, text_col).join(gone, F.col(id_col) == F.col("__gone"), "left_anti")

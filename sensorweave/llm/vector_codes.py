"""Product codes of vectors, learned by exact integer k-means over flat blocks.

Every component becomes an integer, and a vector is cut into ``parts`` equal
consecutive parts with a codebook each. The part vectors are sorted along a
Hilbert curve and written once as flat blocks of at most ``BLOCK_ROWS`` near
neighbours with the smallest box around them and their sum. A round reads the
blocks: distances from a block's box to all entries leave a shortlist (an entry
that is farther from the nearest point of the box than another one from its
farthest point can't be anybody's nearest), and only the entries of the shortlist
are compared with the block's vectors, in whole numbers. Where one entry is left,
the block's sum counts without a look at its vectors. A round returns one row for
each part and entry, whatever the number of vectors.

Numbers are exact at any size: ordinary components are compared in doubles or
64-bit integers, whichever holds every intermediate value exactly, others in
Python's integers, and sums travel as several short limbs.

Defined cases: vectors that are null or hold null or non-finite components are
dropped; the dimension is that of the smallest id's vector whose length is a
multiple of ``parts`` (ties by the vector itself), and vectors of other lengths
are kept with null code and error; null ids come last when the codebooks start;
repeated rows and ids are coded row by row; equal vectors spread over partitions
by their row number; an error or label total beyond 64 bits is null; an empty
table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.llm.common import stored
from sensorweave.session import shuffle_partitions

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Part vectors of a block: what one shortlist is for.
BLOCK_ROWS = 256
#: Bits of a Hilbert key, shared by the components of a part.
KEY_BITS = 64
#: Bits of a limb of a sum, and the largest components that need only one.
LIMB_BITS = 24
#: Label totals (some 20 bytes each) that are broadcast; more are joined with the rows dealt by salt.
BROADCAST_LABELS = 200_000
SALTS = 64


@dataclass(frozen=True)
class Shape:
    """Components of a part, and what numbers they need."""
    width: int
    bits: int  # of the largest absolute component

    @property
    def kind(self) -> str:
        """Numbers in which squared distances, and every value on the way, are exact."""
        if self.bits > LIMB_BITS:
            return "object"
        return "f8" if 2 * self.bits + 2 + max(self.width, 1).bit_length() < 53 else "i8"

    @property
    def limbs(self) -> int:
        return 1 if self.bits <= LIMB_BITS else -(-(self.bits + 64) // LIMB_BITS)

    def dump(self, values: np.ndarray) -> bytes:
        if self.kind == "object":
            return ",".join(map(str, values.ravel().tolist())).encode()
        return values.astype("<i2" if self.bits < 15 else "<i4").tobytes()

    def load(self, raw: bytes, rows: int) -> np.ndarray:
        if self.kind == "object":
            flat = np.array([int(v) for v in raw.decode().split(",")] if raw else [], object)
        else:
            flat = np.frombuffer(raw, "<i2" if self.bits < 15 else "<i4")
        return flat.reshape(rows, self.width).astype(self.kind)


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)`` of finite numbers, as 64-bit or Python integers."""
    values = values.astype(np.float64)
    if not len(values) or np.abs(values).max() < 2.0**50:
        return np.floor(values * SCALE).astype(np.int64)
    return np.array([math.floor(v * SCALE) if abs(v) < 2.0**60 else int(v) * SCALE for v in values.tolist()], object)


def hilbert_keys(levels: np.ndarray, bits: int) -> list[bytes]:
    """Keys that sort points (rows of ``levels``, each of ``bits`` bits) in the
    order in which a Hilbert curve passes through them."""
    n, width = levels.shape
    if not width:
        return [b""] * n
    x = levels.T.astype(np.int64)
    # undo the turns of the curve's sub-cubes from the coarsest level on, then read Gray codes
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(width):
            swap = np.where(x[i] >> level & 1, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(x[i] >> level & 1, low, swap)
            x[i] ^= swap
    for i in range(1, width):
        x[i] ^= x[i - 1]
    flip = np.zeros(n, np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= flip
    planes = np.stack([x[i] >> level & 1 for level in range(bits - 1, -1, -1) for i in range(width)], axis=1)
    return [row.tobytes() for row in np.packbits(planes.astype(np.uint8), axis=1)]


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` to all rows of ``y``."""
    return (x * x).sum(1)[:, None] - 2 * x.dot(y.T) + (y * y).sum(1)[None, :]


def shortlist(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The entries (ascending) that may be nearest to some point of a box."""
    below, above = low - entries, entries - high
    nearest = np.maximum(np.maximum(below, above), 0)
    farthest = np.maximum(np.abs(below), np.abs(above))
    least, most = (nearest * nearest).sum(1), (farthest * farthest).sum(1)
    return np.flatnonzero(least <= most.min())


def assign(x: np.ndarray, low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to every row's nearest entry (of equal
    ones the lowest index)."""
    near = shortlist(low, high, entries)
    distance = squared(x, entries[near])
    best = distance.argmin(1)
    return near[best], distance[np.arange(len(x)), best]


def _usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))


def _starts(kept: DataFrame, parts: int, entries: int) -> list[list[float]]:
    """The vectors of the smallest ids, all of the first one's length."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    fit = kept.where(F.size("vector") % parts == 0).orderBy(*order).select("vec_id", "vector")
    rows = [r.vector for r in fit.limit(entries).collect()]
    if len({len(r) for r in rows}) > 1:
        rows = [r.vector for r in fit.where(F.size("vector") == len(rows[0])).limit(entries).collect()]
    return rows


def _cut_rows(kept: DataFrame, shape: Shape, parts: int, low: np.ndarray, high: np.ndarray) -> DataFrame:
    """``(part, key, uid, data, vec_id, label)``, a row for each part of each
    vector (id and label with the first only); other lengths have part ``parts``."""
    width, bits = shape.width, max(1, min(16, KEY_BITS // max(shape.width, 1)))
    used = min(width, KEY_BITS) if bits == 1 else width
    id_type, label_type = kept.schema["vec_id"].dataType, kept.schema["label"].dataType
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("key", T.BinaryType()), T.StructField("uid", T.LongType()),
                           T.StructField("data", T.BinaryType()), T.StructField("vec_id", id_type), T.StructField("label", label_type)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            vectors, n = batch.column("vector"), batch.num_rows
            if not n:
                continue
            at = vectors.offsets.to_numpy()
            fits = np.flatnonzero(np.diff(at) == parts * width)
            odd = np.flatnonzero(np.diff(at) != parts * width)
            uids, uid = np.arange(uid, uid + n), uid + n
            places = at[fits][:, None] + np.arange(parts * width)
            flat = whole_numbers(vectors.values.to_numpy(zero_copy_only=False)[places.ravel()] if width else np.empty(0))
            whole = flat.reshape(len(fits), parts, width)
            out = {"part": [], "key": [], "uid": [], "data": [], "vec_id": [], "label": []}
            for k in range(parts + 1):
                rows = fits if k < parts else odd
                nothing = pa.nulls(len(rows))
                own = pa.array(rows)
                if k < parts:
                    span = (high[k] - low[k] + 1)[:used]
                    levels = np.clip((whole[:, k, :used].astype(np.float64) - low[k][:used]) / span, 0, 1 - 2.0**-20)
                    keys = hilbert_keys((levels * (1 << bits)).astype(np.int64), bits)
                    data = [shape.dump(row) for row in whole[:, k]]
                else:
                    keys, data = [b""] * len(rows), [None] * len(rows)
                out["part"].append(pa.array(np.full(len(rows), k, np.int32)))
                out["key"].append(pa.array(keys, pa.binary()))
                out["uid"].append(pa.array(uids[rows]))
                out["data"].append(pa.array(data, pa.binary()))
                for name in ("vec_id", "label"):
                    column = batch.column(name)
                    out[name].append(column.take(own) if k in (0, parts) else nothing.cast(column.type))
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(out[f.name]) for f in schema.fields], schema.fieldNames())

    return kept.mapInArrow(cut, schema)


def _blocks(cut: DataFrame, shape: Shape, parts: int) -> DataFrame:
    """Flat blocks of near part vectors: ``(part, size, data, low, high, total,
    uids, vec_ids, labels)``. A range of the curve goes to a partition; the row
    number after the key lets many equal vectors fill several."""
    fields = {f.name: f.dataType for f in cut.schema.fields}
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("size", T.IntegerType()),
        *[T.StructField(c, T.BinaryType()) for c in ("data", "low", "high")], T.StructField("total", T.StringType()),
        T.StructField("uids", T.ArrayType(T.LongType())), T.StructField("vec_ids", T.ArrayType(fields["vec_id"])),
        T.StructField("labels", T.ArrayType(fields["label"]))])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(rows: pa.Table) -> dict:
            part, raw = rows["part"][0].as_py(), rows["data"].to_pylist()
            if shape.kind == "object":
                values = np.concatenate([shape.load(r, 1) for r in raw])
            else:
                values = shape.load(b"".join(raw), len(raw))
            own = values if shape.kind == "object" else values.astype(np.int64)
            return {"part": part, "size": len(raw), "data": shape.dump(own), "low": shape.dump(own.min(0)), "high": shape.dump(own.max(0)),
                    "total": ",".join(map(str, own.sum(0).tolist())), "uids": rows["uid"].to_pylist(),
                    "vec_ids": rows["vec_id"].to_pylist() if part == 0 else [], "labels": rows["label"].to_pylist() if part == 0 else []}

        types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.string(), pa.list_(pa.int64())]

        def sent(blocks: list[dict], of: pa.Schema) -> pa.RecordBatch:
            kinds = [*types, pa.list_(of.field("vec_id").type), pa.list_(of.field("label").type)]
            return pa.RecordBatch.from_arrays([pa.array([b[c] for b in blocks], k) for c, k in zip(schema.fieldNames(), kinds)], schema.fieldNames())

        waiting: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if waiting is None else pa.concat_tables([waiting, rows])
            part = rows["part"].to_numpy()
            starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            done, start = [], 0
            for a, b in zip(starts, starts[1:]):
                last = b == len(part)
                for start in range(a, b, BLOCK_ROWS):
                    if last and start + BLOCK_ROWS > b:
                        break
                    done.append(block(rows.slice(start, min(BLOCK_ROWS, b - start))))
                    start += BLOCK_ROWS
            waiting = rows.slice(min(start, len(part))) if start < len(part) else None
            if done:
                yield sent(done, batch.schema)
        if waiting is not None and waiting.num_rows:
            yield sent([block(waiting)], waiting.schema)

    ranges = cut.where(F.col("part") < parts).repartitionByRange(shuffle_partitions(cut.sparkSession), "part", "key", "uid")
    return ranges.sortWithinPartitions("part", "key", "uid").mapInArrow(gather, schema)


def _round(blocks: DataFrame, shape: Shape, books: list[np.ndarray]) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Number and sums of the part vectors nearest to each entry."""
    width, limbs = shape.width, shape.limbs
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("entry", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("sums", T.ArrayType(T.LongType()))])
    wide = shape.kind == "object"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [b.astype(shape.kind) for b in books]
        n = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros((len(b), width), object if wide else np.int64) for b in books]
        for batch in batches:
            for row in batch.to_pylist():
                k, size = row["part"], row["size"]
                low, high = shape.load(row["low"], 1)[0], shape.load(row["high"], 1)[0]
                near = shortlist(low, high, own[k])
                if len(near) == 1:
                    n[k][near[0]] += size
                    sums[k][near[0]] += np.array([int(v) for v in row["total"].split(",") if v], sums[k].dtype)
                    continue
                x = shape.load(row["data"], size)
                to = near[squared(x, own[k][near]).argmin(1)]
                order = np.argsort(to, kind="stable")
                firsts = np.flatnonzero(np.diff(to[order], prepend=-1))
                hit = to[order][firsts]
                n[k][hit] += np.diff(firsts, append=size)
                if width:
                    x = x if wide else x.astype(np.int64)
                    sums[k][hit] += np.add.reduceat(x[order], firsts, axis=0)
        mask, out = (1 << LIMB_BITS) - 1, []
        for k, counts in enumerate(n):
            for e in np.flatnonzero(counts).tolist():
                values = sums[k][e].tolist()
                out.append((k, e, int(counts[e]), [int(v) >> LIMB_BITS * i & mask if i < limbs - 1 else int(v) >> LIMB_BITS * i for v in values for i in range(limbs)]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))], schema.fieldNames())

    found = blocks.select("part", "size", "data", "low", "high", "total").mapInArrow(count, schema)
    found = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width * limbs)]).alias("sums"))
    return {(r.part, r.entry): (r.n, [sum(v << LIMB_BITS * i for i, v in enumerate(r.sums[j : j + limbs])) for j in range(0, width * limbs, limbs)])
            for r in found.collect()}  # at most parts x entries rows


@dataclass
class Codebooks:
    """Entries by part, as whole numbers."""
    books: list[np.ndarray]

    def sha256(self) -> str:
        text = ",".join(str(int(v)) for book in self.books for v in book.ravel().tolist())
        return hashlib.sha256(text.encode()).hexdigest()


def _coded(blocks: DataFrame, shape: Shape, books: list[np.ndarray]) -> DataFrame:
    """``(uid, part, entry, error, vec_id, label)`` for every part vector."""
    fields = {f.name: f.dataType for f in blocks.schema.fields}
    schema = T.StructType([T.StructField("uid", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("entry", T.IntegerType()),
                           T.StructField("error", T.LongType()), T.StructField("vec_id", fields["vec_ids"].elementType),
                           T.StructField("label", fields["labels"].elementType)])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [b.astype(shape.kind) for b in books]
        for batch in batches:
            for i in range(batch.num_rows):
                k, size, raw, low, high = (batch.column(c)[i].as_py() for c in ("part", "size", "data", "low", "high"))
                entry, error = assign(shape.load(raw, size), shape.load(low, 1)[0], shape.load(high, 1)[0], own[k])
                errors = [int(v) if v < 2**63 else None for v in error.tolist()]
                ids, labels = (batch.column(c)[i].values for c in ("vec_ids", "labels"))
                if k:
                    ids, labels = (pa.nulls(size).cast(v.type) for v in (ids, labels))
                yield pa.RecordBatch.from_arrays([batch.column("uids")[i].values, pa.array(np.full(size, k, np.int32)), pa.array(entry.astype(np.int32)),
                                                  pa.array(errors, pa.int64()), ids, labels], schema.fieldNames())

    return blocks.drop("total").mapInArrow(code, schema)


def _with_label_totals(rows: DataFrame) -> DataFrame:
    """``label_error``: the errors of equal labels added up, nulls together."""
    totals = stored(rows.groupBy("label").agg(F.try_sum("error").alias("label_error")), "label-totals").withColumnRenamed("label", "_label")
    if totals.count() <= BROADCAST_LABELS:
        return rows.join(F.broadcast(totals), F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
    totals = totals.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("_at", F.pmod(F.hash("uid"), F.lit(SALTS)))
    return rows.join(totals, F.col("label").eqNullSafe(F.col("_label")) & (F.col("_at") == F.col("_salt")), "left").drop("_label", "_salt", "_at")


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """``(vec_id, label, code, error, label_error)`` for every usable vector,
    and the codebooks. ``code`` holds two hex digits for each part."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits for each part: at most 256 entries")
    kept = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label")).where(_usable(F.col("vector")))
    first = _starts(kept, parts, entries)
    width = len(first[0]) // parts if first else 0
    peak = kept.where(F.size("vector") == parts * width).agg(F.max(F.array_max(F.transform("vector", F.abs))).alias("peak")).first().peak or 0.0
    # the largest absolute component in whole numbers; rounding down may add one to a negative one
    shape = Shape(width, (math.floor(peak) * SCALE + SCALE + 1 if peak < 2.0**50 else int(peak) * SCALE + SCALE).bit_length())
    whole = [whole_numbers(np.array(v, np.float64)).reshape(parts, width) for v in first]
    books = [np.array([w[k] for w in whole], object).reshape(len(whole), width) for k in range(parts)]
    low = [b.min(0).astype(np.float64) if len(b) else np.zeros(width) for b in books]
    high = [b.max(0).astype(np.float64) if len(b) else np.zeros(width) for b in books]
    cut = stored(_cut_rows(kept, shape, parts, low, high), "vector-parts")
    blocks = stored(_blocks(cut, shape, parts), "vector-blocks")
    for _ in range(rounds):
        for (k, e), (n, sums) in _round(blocks, shape, books).items():
            books[k][e] = [s // n for s in sums]
    coded = _coded(blocks, shape, books).groupBy("uid").agg(
        F.any_value("vec_id", True).alias("vec_id"), F.any_value("label", True).alias("label"),
        F.concat(*[F.lpad(F.lower(F.hex(F.max(F.when(F.col("part") == k, F.col("entry"))))), 2, "0") for k in range(parts)]).alias("code"),
        F.when(F.count("error") == parts, F.try_sum("error")).alias("error"))
    odd = cut.where(F.col("part") == parts).select("uid", "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    rows = stored(coded.unionByName(odd), "vector-codes")
    return _with_label_totals(rows).drop("uid"), Codebooks(books)

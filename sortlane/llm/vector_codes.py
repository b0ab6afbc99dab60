"""Vectors as one byte a part: codebooks learned in integers, parts assigned by two trees.

A vector is cut into 16 parts and each part is replaced by the number of the nearest entry of
its codebook. Both the parts of a batch and the entries of a codebook stand in trees whose nodes
know their bounding boxes. Pairs of nodes go down together: a pair whose least distance is above
another pair's largest one is dropped, a node of parts with a single entry left is assigned as
a whole, from the count and the sums that the node keeps, and only leaves with several entries
left are compared part by part. Components are integers, so every distance and sum is exact and
neither the order of rows nor the number of tasks changes a result.

What moves are the sums of each entry, one row for each (part, entry, component); the driver
holds the codebooks, whose size is that of 64 vectors.

Defined cases: vectors that are null, or hold null or non-finite components, are dropped.
Shorter vectors count as filled up with zeros to the longest one's length, and all of them to a
multiple of 16. Rows with a null vec_id are smaller than none; rows that share a vec_id are in
the order of their components. With fewer than 64 rows a codebook has as many entries. An error
beyond 64 bits is null. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortlane.llm.tables import stored
from sortlane.plans.bounded import lookup_join

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LEAF = 8
# Squared distances of smaller components fit 64 bits with room for a vector's sum.
MOST_COMPONENT = 1 << 26
# Vectors that are taken together.
BATCH = 8192
LIMB_BITS = 40
LIMB = pa.struct([("k", pa.int32()), ("place", pa.int32()), ("value", pa.int64())])


def integers(values: np.ndarray) -> np.ndarray:
    """floor(256 * x): 64-bit integers, or Python's where those could overflow later on."""
    if not values.size or np.abs(values).max() < MOST_COMPONENT / SCALE:
        return np.floor(values * SCALE).astype(np.int64)
    ratios = [float(x).as_integer_ratio() for x in values.ravel()]
    return np.array([n * SCALE // d for n, d in ratios], dtype=object).reshape(values.shape)


class Tree:
    """A balanced tree over points: level l has 2**l nodes of equal size, in the order ``order``.

    Points that fill it up are copies of the first one and count nothing.
    """

    def __init__(self, points: np.ndarray, leaf: int, cached: bool = False):
        n = len(points)
        self.depth = max(0, int(np.ceil(np.log2(max(n / leaf, 1)))))
        self.leaf = -(-n // (1 << self.depth))
        total = self.leaf << self.depth
        order = np.concatenate([np.arange(n), np.zeros(total - n, dtype=np.int64)])
        real = np.arange(total) < n
        for level in range(self.depth):
            blocks = points[order].reshape(1 << level, -1, points.shape[1])
            widest = (blocks.max(axis=1) - blocks.min(axis=1)).argmax(axis=1)
            values = np.take_along_axis(blocks, widest[:, None, None], axis=2)[:, :, 0]
            turn = values.argsort(axis=1, kind="stable")
            order = np.take_along_axis(order.reshape(1 << level, -1), turn, axis=1)
            real = np.take_along_axis(real.reshape(1 << level, -1), turn, axis=1).ravel()
            order = order.ravel()
        self.order, self.real = order, real
        self.points = points[order]
        shape = (1 << self.depth, self.leaf, points.shape[1])
        low, high = [self.points.reshape(shape).min(axis=1)], [self.points.reshape(shape).max(axis=1)]
        for _ in range(self.depth):
            low.append(np.minimum(low[-1][0::2], low[-1][1::2]))
            high.append(np.maximum(high[-1][0::2], high[-1][1::2]))
        self.low, self.high = low[::-1], high[::-1]
        if cached:
            sums = [(self.points * real[:, None]).reshape(shape).sum(axis=1)]
            count = [real.reshape(shape[:2]).sum(axis=1)]
            for _ in range(self.depth):
                sums.append(sums[-1][0::2] + sums[-1][1::2])
                count.append(count[-1][0::2] + count[-1][1::2])
            self.sums, self.count = sums[::-1], count[::-1]


def _bounds(low: np.ndarray, high: np.ndarray, other_low: np.ndarray, other_high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared distance between the points of two boxes."""
    gap = np.maximum(np.maximum(low - other_high, other_low - high), 0)
    reach = np.maximum(np.abs(high - other_low), np.abs(other_high - low))
    return (gap * gap).sum(axis=1), (reach * reach).sum(axis=1)


def _first_of_runs(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))


def assign(points: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest entry of every point, and count and sums of the points of every entry.

    Points are in the order of their tree. Of equally near entries the one with the lower number
    is taken. The last value is how many points were compared one by one.
    """
    # An entry equal to an earlier one is never the nearest with the lowest number.
    _, distinct = np.unique(entries.astype("U") if entries.dtype == object else entries, axis=0, return_index=True)
    distinct = np.sort(distinct)
    of = Tree(entries[distinct], 1)
    codes = np.zeros(len(points.order), dtype=np.int64)
    count = np.zeros(len(entries), dtype=np.int64)
    sums = np.zeros(entries.shape, dtype=points.points.dtype)
    node, other, level, below, compared = np.zeros(1, np.int64), np.zeros(1, np.int64), 0, 0, 0
    while True:
        least, most = _bounds(points.low[level][node], points.high[level][node], of.low[below][other], of.high[below][other])
        first = _first_of_runs(node)
        run = np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(node)]])))
        kept = least <= np.minimum.reduceat(most, first)[run]
        node, other = node[kept], other[kept]
        if below == of.depth:
            # Filled-up entries are copies of the first one.
            entry = distinct[of.order[other]]
            once = np.lexsort((entry, node))
            node, other, entry = node[once], other[once], entry[once]
            new = np.concatenate([[True], (node[1:] != node[:-1]) | (entry[1:] != entry[:-1])])
            node, other, entry = node[new], other[new], entry[new]
            first = _first_of_runs(node)
            size = np.diff(np.concatenate([first, [len(node)]]))
            alone = first[size == 1]
            span = points.leaf << (points.depth - level)
            codes.reshape(-1, span)[node[alone]] = entry[alone][:, None]
            np.add.at(count, entry[alone], points.count[level][node[alone]])
            np.add.at(sums, entry[alone], points.sums[level][node[alone]])
            left = np.repeat(size > 1, size)
            node, other, entry = node[left], other[left], entry[left]
            if not len(node) or level == points.depth:
                break
        if level < points.depth:
            level += 1
            node, other = np.concatenate([2 * node, 2 * node + 1]), np.concatenate([other, other])
        if below < of.depth:
            below += 1
            node, other = np.concatenate([node, node]), np.concatenate([2 * other, 2 * other + 1])
        again = np.argsort(node, kind="stable")
        node, other = node[again], other[again]
    if len(node):
        first = _first_of_runs(node)
        each = points.points.reshape(-1, points.leaf, entries.shape[1])
        offset = each[node] - entries[entry][:, None, :]
        distance = (offset * offset).sum(axis=2)
        run = np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(node)]])))
        nearest = distance == np.minimum.reduceat(distance, first, axis=0)[run]
        best = np.minimum.reduceat(np.where(nearest, entry[:, None], len(entries)), first, axis=0)
        codes.reshape(-1, points.leaf)[node[first]] = best
        real = points.real.reshape(-1, points.leaf)[node[first]]
        compared = int(real.sum())
        np.add.at(count, best[real], 1)
        np.add.at(sums, best[real], each[node[first]][real])
    return codes, count, sums, compared


def _kept(embeddings: DataFrame) -> DataFrame:
    """(vec, label, v) with finite vectors of doubles."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec"), "label", F.col("embedding").cast("array<double>").alias("v"))

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    return rows.filter(F.col("v").isNotNull() & F.forall("v", finite))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows of integers, filled up with zeros to ``width``."""
    lengths = np.asarray(column.value_lengths(), dtype=np.int64)
    values = integers(np.asarray(column.flatten(), dtype=np.float64))
    if len(lengths) and (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(lengths), width), dtype=values.dtype)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH):
            yield batch.slice(start, BATCH)


def _parts(x: np.ndarray) -> np.ndarray:
    return x.reshape(len(x), PARTS, -1).transpose(1, 0, 2)


def _limbs(k: int, value: int) -> list[tuple[int, int, int]]:
    """A sum of any size as digits to the base 2**40, each with the sum's sign, so that sums add up by place."""
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value or not out:
        out.append((k, len(out), sign * (value & ((1 << LIMB_BITS) - 1))))
        value >>= LIMB_BITS
    return out


def _updated(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each entry the floor of the mean of its parts."""
    width = books.shape[0] * books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(books.shape[:2], dtype=object)
        sums = np.zeros(books.shape, dtype=object)
        for batch in _batches(batches):
            for p, points in enumerate(_parts(_matrix(batch.column("v"), width))):
                _, n, s, _ = assign(Tree(points, LEAF, cached=True), books[p])
                count[p] += n
                sums[p] += s
        parts, entries = np.nonzero(count)
        n = pa.array([int(v) for v in count[parts, entries]], pa.int64())
        limbs = [[x for k, v in enumerate(row) for x in _limbs(k, int(v))] for row in sums[parts, entries]]
        columns = [pa.array(parts, pa.int32()), pa.array(entries, pa.int32()), n, pa.array(limbs, pa.list_(LIMB))]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "limbs"])

    kind = "array<struct<k: int, place: int, value: long>>"
    partial = vectors.select("v").mapInArrow(run, f"part int, entry int, n long, limbs {kind}")
    # Every task tells the lowest place of each component, so its rows hold each part once.
    places = partial.select("part", "entry", "n", F.inline("limbs")).groupBy("part", "entry", "k", "place")
    places = places.agg(F.sum("value").alias("value"), F.sum("n").alias("n"))
    lowest = F.max(F.when((F.col("k") == 0) & (F.col("place") == 0), F.col("n"))).alias("n")
    grouped = places.groupBy("part", "entry").agg(lowest, F.collect_list(F.struct("k", "place", "value")).alias("limbs"))
    out = books.astype(object)
    # At most one row for each entry of each codebook.
    for r in grouped.collect():
        total = [0] * books.shape[2]
        for x in r["limbs"]:
            total[x["k"]] += x["value"] << (x["place"] * LIMB_BITS)
        out[r["part"], r["entry"]] = [s // r["n"] for s in total]
    return _compact(out)


def _compact(x: np.ndarray) -> np.ndarray:
    """64-bit integers where they are small enough for exact distances."""
    small = all(-MOST_COMPONENT < v < MOST_COMPONENT for v in x.ravel().tolist())
    return x.astype(np.int64) if small else x.astype(object)


def learn(vectors: DataFrame, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (part, entry, component) from rows (vec, label, v); None without rows."""
    longest = vectors.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return None
    width = -(-max(longest, 1) // PARTS) * PARTS
    first = vectors.orderBy(F.col("vec").asc_nulls_last(), "v").limit(ENTRIES).select("v").collect()
    rows = [np.pad(np.array(r["v"], dtype=np.float64), (0, width - len(r["v"]))) for r in first]
    books = _compact(_parts(integers(np.stack(rows))))
    for _ in range(rounds):
        books = _updated(vectors, books)
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in books.ravel()).encode()).hexdigest()


def _coded(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec, label, code, error) of every row."""
    width = books.shape[0] * books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            x = _matrix(batch.column("v"), width)
            codes, error = np.zeros((len(x), PARTS), dtype=np.uint8), np.zeros(len(x), dtype=object)
            for p, points in enumerate(_parts(x)):
                tree = Tree(points, LEAF, cached=True)
                found = assign(tree, books[p])[0]
                codes[tree.order[tree.real], p] = found[tree.real]
                offset = points - books[p][codes[:, p]]
                error = error + (offset * offset).sum(axis=1)
            text = [row.tobytes().hex() for row in codes]
            error = [int(e) if e < 1 << 63 else None for e in error]
            columns = [batch.column("vec"), batch.column("label"), pa.array(text, pa.string()), pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec", "label", "code", "error"])

    kind = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec long, label {kind}, code string, error long")


def encode(embeddings: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray | None]:
    """(vec_id, label, code, error, label_error) of every kept row, and the codebooks."""
    vectors = stored(_kept(embeddings), "vector-codes-kept")
    books = learn(vectors, rounds)
    if books is None:
        empty = vectors.select(F.col("vec").alias("vec_id"), "label", F.lit("").alias("code"), *[F.lit(0).cast("long").alias(c) for c in ("error", "label_error")])
        return empty, None
    # Null is a label like the others.
    coded = stored(_coded(vectors, books), "vector-codes").withColumn("_key", F.concat(F.lit("="), F.col("label").cast("string")))
    coded = coded.withColumn("_key", F.coalesce("_key", F.lit("")))
    totals = coded.groupBy("_key").agg(F.expr("try_sum(error)").alias("label_error"))
    rows = lookup_join(coded, totals, "_key", "vec")
    return rows.select(F.col("vec").alias("vec_id"), "label", "code", "error", "label_error"), books

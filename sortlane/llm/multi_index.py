"""Embedding near-dedup with an inverted multi-index.

Each half of the unit vectors has a codebook of its own; a vector's cell is the pair of its
halves' nearest codes. Every vector is indexed in its cell and asks the cells nearest to it, in
the order of the multi-sequence traversal (sums of both halves' distances), until the target
recall is reached. How many cells that takes is measured on the sample that the codebooks are
fitted on: each sampled vector gets a neighbour in a random direction at exactly the threshold,
the farthest that has to be found, and the rank of the neighbour's cell is looked up.

Vectors with the same label that meet in a cell are compared by their cosine in double
precision. Cells are compared in blocks, so a cell may hold any number of vectors; a block gives
counts of links and what is connected, not all pairs. Equal vectors are compared once.

That a vector asks another's cell does not mean that the other asks back, so a pair may meet in
one cell or in two. A question carries the cell of its vector, and an indexed vector the cells
that it asks: where they tell that a pair meets twice, one of the two meetings counts it, and
always for both vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortlane.llm import arrays as A
from sortlane.llm.components import components, smallest_ids
from sortlane.llm.tables import NULL_ID, map_arrow, stored

THRESHOLD = 0.93
TARGET_RECALL = 0.995
SAMPLE = 10_000
MOST_CODES = 64
CELL_VECTORS = 200
BLOCK = 512

ROWS = "vec long, node long, label int, size int, raw binary"


@dataclass(frozen=True)
class MultiIndex:
    """Codebooks of both halves by vector length, and how many cells a vector asks."""

    codes: dict[int, tuple[np.ndarray, np.ndarray]]
    cells: int


def units(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _distances(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ codes.T + (codes * codes).sum(axis=1)[None, :]


def _codebook(x: np.ndarray, k: int) -> np.ndarray:
    """k-means with a fixed start."""
    codes = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(12):
        own = _distances(x, codes).argmin(axis=1)
        for c in range(k):
            if (own == c).any():
                codes[c] = x[own == c].mean(axis=0)
    return codes


def _halves(x: np.ndarray, codes: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    half = (x.shape[1] + 1) // 2
    return _distances(x[:, :half], codes[0]), _distances(x[:, half:], codes[1])


def own_cells(x: np.ndarray, codes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    left, right = _halves(x, codes)
    return left.argmin(axis=1) * len(codes[1]) + right.argmin(axis=1)


def nearest_cells(x: np.ndarray, codes: tuple[np.ndarray, np.ndarray], cells: int) -> np.ndarray:
    """The nearest cells of each vector, nearest first.

    The multi-sequence front: the n least sums of two sorted rows lie at ranks (i, j) with
    (i + 1) * (j + 1) <= n, so only those are summed.
    """
    left, right = _halves(x, codes)
    first, second = left.argsort(axis=1, kind="stable"), right.argsort(axis=1, kind="stable")
    cells = min(cells, left.shape[1] * right.shape[1])
    i, j = np.divmod(np.arange(left.shape[1] * right.shape[1]), right.shape[1])
    front = (i + 1) * (j + 1) <= cells
    i, j = i[front], j[front]
    sums = np.take_along_axis(left, first, 1)[:, i] + np.take_along_axis(right, second, 1)[:, j]
    best = sums.argsort(axis=1, kind="stable")[:, :cells]
    return np.take_along_axis(first, i[best], 1) * right.shape[1] + np.take_along_axis(second, j[best], 1)


def fit(nodes: DataFrame, threshold: float, target: float) -> MultiIndex:
    """Codebooks and number of cells from at most ``SAMPLE`` vectors, those with the least numbers."""
    largest = nodes.groupBy("label", "size").count().agg(F.max("count")).first()[0] or 0
    k = int(np.clip(np.sqrt(largest / CELL_VECTORS), 1, MOST_CODES))
    rows = nodes.orderBy("node").limit(SAMPLE).select("size", "raw").collect()
    codes, needed = {}, 1
    for size in sorted({r["size"] for r in rows}):
        x = units([bytes(r["raw"]) for r in rows if r["size"] == size])
        half = (size + 1) // 2
        own = min(k, len(x))
        codes[size] = (_codebook(x[:, :half], own), _codebook(x[:, half:], own if size > 1 else 1))
        if size < 2:
            continue
        turn = np.random.default_rng(size).normal(size=x.shape)
        turn -= (turn * x).sum(axis=1, keepdims=True) * x
        near = threshold * x + np.sqrt(1 - threshold**2) * turn / np.sqrt((turn * turn).sum(axis=1, keepdims=True))
        goal, found = own_cells(near, codes[size]), len(codes[size][0]) * len(codes[size][1])
        ranks = np.concatenate([
            (nearest_cells(x[a : a + 500], codes[size], found) == goal[a : a + 500, None]).argmax(axis=1) for a in range(0, len(x), 500)
        ])
        needed = max(needed, int(np.quantile(ranks, target, method="higher")) + 1)
    return MultiIndex(codes, needed)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Valid vectors as doubles with a number for each distinct (label, vector); others have no bytes."""
    for batch in batches:
        vec = np.asarray(batch.column("vec"), dtype=np.int64)
        labels, raws, sizes = batch.column("label").to_pylist(), [], []
        for label, value in zip(labels, batch.column("embedding")):
            x = None
            if label is not None and value.is_valid and value.values.null_count == 0 and len(value.values):
                x = np.asarray(value.values, dtype=np.float64) + 0.0
                if not np.isfinite(x).all() or not (0 < (x * x).sum() < np.inf):
                    x = None
            raws.append(None if x is None else x.astype("<f8").tobytes())
            sizes.append(0 if x is None else len(x))
        data, offsets = A.flat(pa.array(raws, pa.binary()))
        same = A.span_hash(A.rolling(data), offsets[:-1], offsets[1:]) + A.mix(np.array([x or 0 for x in labels], dtype=np.int64).view(np.uint64))
        node = A.mix(np.where(np.array(sizes) > 0, same, vec.view(np.uint64) + np.uint64(0x5851F42D4C957F2D))).view(np.int64)
        columns = [pa.array(vec), pa.array(node), pa.array(labels, pa.int32()), pa.array(sizes, pa.int32()), pa.array(raws, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["vec", "node", "label", "size", "raw"])


# ``back``: of a question the cell of its vector, of an indexed vector the cells that it asks.
ENTRY = "label int, size int, cell int, asks boolean, node long, copies long, raw binary, back binary"


def _entries(nodes: DataFrame, index: MultiIndex) -> DataFrame:
    """Each vector in its own cell, and as a question in the cells that it asks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column("size"))
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                codes = index.codes.get(size)
                for part in np.array_split(at, -(-len(at) // 500)):
                    rows = batch.take(pa.array(part))
                    x = units(rows.column("raw").to_pylist())
                    if codes is None:  # a length that the sample doesn't have: one cell
                        cells = np.zeros((len(x), 1), dtype="<i4")
                    else:
                        cells = nearest_cells(x, codes, index.cells).astype("<i4")
                    own = cells[:, :1]
                    for asks, where, others in ((False, own, cells), (True, cells, own)):
                        of = pa.array(np.repeat(np.arange(len(x)), where.shape[1]))
                        each = rows.take(of)
                        yield pa.RecordBatch.from_arrays(
                            [
                                each.column("label"),
                                each.column("size"),
                                pa.array(where.ravel()),
                                pa.array(np.full(where.size, asks)),
                                each.column("node"),
                                each.column("copies"),
                                each.column("raw"),
                                pa.array([o.tobytes() for o in others], pa.binary()).take(of),
                            ],
                            names=["label", "size", "cell", "asks", "node", "copies", "raw", "back"],
                        )

    return map_arrow(nodes.select("label", "size", "node", "copies", "raw"), run, ENTRY)


def _compared(entries: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root): links of a vector that count in a block, and the root it is connected with there.

    Indexed vectors and questions of a cell are dealt into blocks of about ``BLOCK``; each block
    of the one meets each block of the other.
    """
    cell = ["label", "size", "cell"]
    sizes = entries.groupBy(*cell).agg(
        F.ceil(F.count_if(~F.col("asks")) / BLOCK).cast("int").alias("indexed"), F.ceil(F.count_if("asks") / BLOCK).cast("int").alias("asking")
    )
    sizes = stored(sizes.filter("indexed > 0 AND asking > 0"), "multi-index-sizes")
    dealt = entries.join(sizes, cell)
    own = F.pmod(F.xxhash64("node"), F.when(F.col("asks"), F.col("asking")).otherwise(F.col("indexed")).cast("long")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("asks"), F.col("indexed")).otherwise(F.col("asking")) - 1))
    dealt = dealt.withColumn("own", own).withColumn("other", other)
    dealt = dealt.withColumn("i", F.when(F.col("asks"), F.col("other")).otherwise(F.col("own")))
    dealt = dealt.withColumn("q", F.when(F.col("asks"), F.col("own")).otherwise(F.col("other")))
    keys = [*cell, "i", "q"]
    ordered = dealt.select(*keys, "asks", "node", "copies", "raw", "back").repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:5] != last and rows:
                    yield from out(rows)
                    rows = []
                last = row[:5]
                rows.append(row[5:])
        if rows:
            yield from out(rows)

    def out(rows: list) -> Iterator[pa.RecordBatch]:
        asking, indexed = [r for r in rows if r[0]], [r for r in rows if not r[0]]
        if not asking or not indexed:
            return
        a, b = (np.array([r[1] for r in side], dtype=np.int64) for side in (asking, indexed))
        linked = (units([r[3] for r in asking]) @ units([r[3] for r in indexed]).T >= threshold) & (a[:, None] != b[None, :])
        if not linked.any():
            return
        x, y = linked.any(axis=1), linked.any(axis=0)
        a, b, linked = a[x], b[y], linked[x][:, y]
        asking, indexed = [r for r, on in zip(asking, x) if on], [r for r, on in zip(indexed, y) if on]
        # A pair that meets in both vectors' cells counts where the lesser number asks.
        own = np.frombuffer(b"".join([r[4] for r in asking]), "<i4")
        asked = np.frombuffer(b"".join([r[4] for r in indexed]), "<i4").reshape(len(b), -1)
        back = np.zeros((len(b), max(own.max(), asked.max()) + 1), dtype=bool)
        np.put_along_axis(back, asked.astype(np.int64), True, axis=1)
        counted = linked & (~back[:, own].T | (a[:, None] < b[None, :]))
        copies_a, copies_b = (np.array([r[2] for r in side], dtype=np.int64) for side in (asking, indexed))
        counts = np.concatenate([counted @ copies_b, copies_a @ counted])
        # The least number that each vector is connected with inside this block.
        top = np.iinfo(np.int64).max
        left, right = a.copy(), b.copy()
        while True:
            right = np.minimum(right, np.where(linked, left[:, None], top).min(axis=0))
            lower = np.minimum(left, np.where(linked, right[None, :], top).min(axis=1))
            if (lower == left).all():
                break
            left = lower
        nodes, roots = np.concatenate([a, b]), np.concatenate([left, right])
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(counts), pa.array(roots)], names=["node", "links", "root"])

    return map_arrow(ordered, run, "node long, links long, root long")


def grouped(vectors: DataFrame, threshold: float = THRESHOLD, target: float = TARGET_RECALL) -> DataFrame:
    """(vec, vec_id, n_links, component, component_id) of every row of (vec_id, label, embedding).

    Vectors are linked if their labels are equal and not null, their lengths are equal and the
    cosine is at least ``threshold``. Null, zero and empty vectors and such with null or
    non-finite components are linked with nothing. A null vec_id counts as smaller than any
    other; rows that share a vec_id are different vectors in the count of links.
    """
    rows = vectors.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NULL_ID)).alias("vec"), F.col("label").cast("int").alias("label"), "embedding")
    rows = stored(map_arrow(rows, _vectors, ROWS), "multi-index-rows")
    valid = rows.filter("raw IS NOT NULL").groupBy("node")
    nodes = stored(
        valid.agg(F.first("label").alias("label"), F.first("size").alias("size"), F.first("raw").alias("raw"), F.count("*").alias("copies"), F.min("vec").alias("first")),
        "multi-index-nodes",
    )
    entries = stored(_entries(nodes, fit(nodes, threshold, target)), "multi-index-entries")
    found = stored(_compared(entries, threshold), "multi-index-found")
    labels = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    by_node = smallest_ids(stored(labels, "multi-index-labels"), nodes.select("node", "first"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.select("node", "copies").join(counts, "node", "left").join(by_node, "node")
    known = stored(known.select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component"), "multi-index-known")
    result = rows.select("vec", "node").join(known, "node", "left")
    null = F.lit(NULL_ID)
    return result.select(
        "vec",
        F.nullif("vec", null).alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component", "vec").alias("component"),
        F.nullif(F.coalesce("component", "vec"), null).alias("component_id"),
    )

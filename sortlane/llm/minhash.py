"""MinHash near-dedup by fast similarity sketching, banding and exact verification.

A document's set is its distinct word shingles. Its sketch has ``BINS`` coordinates: in round i
each shingle is thrown into one bin with the value (round, hash); a bin keeps its least value. In
the rounds after the first ``BINS`` every shingle goes into one given bin, so each coordinate is
filled after at most 2 * ``BINS`` rounds, and mostly after a few. Two sketches agree in a
coordinate with the similarity of their sets as probability, closely concentrated.

Sets that share the ``ROWS`` coordinates of one of ``BANDS`` bands meet in a bucket. At a
similarity of 0.8 a pair is missed with a probability of 1.3e-5, at 0.85 of 1e-8. Links are
confirmed on full sets, made anew from both texts. Not all pairs of a bucket are tried: first
each set with one smaller partner, then, in buckets that still hold several components, each set
with its nearest partners by sketch, pair by pair. At last every pair of different components whose
sketches agree in ``LEAST_AGREED`` of their coordinates (or more) is confirmed or refused. A pair
at 0.8 falls below that with a probability under 1e-6. Those pairs are never rows: the sets that
are near another one travel to their blocks with their texts, and a block tries its pairs itself,
each in the first bucket that it shares, the nearest first, and none that its links connect already.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sortlane.llm import arrays as A
from sortlane.llm.components import components, merged, smallest_ids
from sortlane.llm.superkmers import ranges
from sortlane.llm.tables import NULL_ID, doc_key, keyed, likely_among, map_arrow, part_key, stored

BANDS = 48
ROWS = 7
BINS = BANDS * ROWS
LEAST_AGREED = 0.68
# Rounds of pairs: which part of the buckets, and how many of the nearest partners in a block.
ROUNDS = ((12, 2), (1, 2))
BLOCK = 256
# Hashes of shingles that a block holds at a time.
MOST_HELD = 8_000_000

SKETCH = "doc long, part long, n_shingles long, node long, bands binary, short binary"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each row, sorted, and where each row's begin.

    A row of fewer words than ``width`` has its whole sequence as one shingle, a row without
    words none.
    """
    data = A.lowered(data)
    starts, ends, first = A.word_bounds(data, offsets)
    prefix = A.token_prefix(A.word_hashes(data, starts, ends))
    words = np.diff(first)
    count = np.where(words >= width, words - width + 1, np.minimum(words, 1))
    at = ranges(first[:-1], count)
    row = np.repeat(np.arange(len(words)), count)
    length = np.minimum(width, words)[row]
    shingles = A.span_hash(prefix, at, at + length)
    order = np.lexsort((shingles, row))
    shingles, row = shingles[order], row[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (row[1:] != row[:-1])
    return shingles[new], np.searchsorted(row[new], np.arange(len(words) + 1))


def sketches(shingles: np.ndarray, first: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Fast similarity sketches, a row for each set; an empty set's row is all zeros."""
    n = len(first) - 1
    out = np.zeros((n, bins), dtype=np.uint64)
    sizes = np.diff(first)
    rows = np.flatnonzero(sizes)
    empty = np.iinfo(np.uint64).max
    for i in range(2 * bins):
        if not len(rows):
            break
        own = ranges(first[rows], sizes[rows])
        of = np.repeat(np.arange(len(rows)), sizes[rows])
        value = A.mix(shingles[own] + np.uint64((0x9E3779B97F4A7C15 * (i + 1)) % (1 << 64)))
        now = np.full(len(rows) * bins, empty, dtype=np.uint64)
        if i < bins:
            place = of * bins + (A.mix(value) % np.uint64(bins)).astype(np.int64)
        else:
            place = of * bins + (i - bins)
        np.minimum.at(now, place, value)
        now = now.reshape(len(rows), bins)
        have = out[rows]
        fresh = (have == 0) & (now != empty)
        # Only empty bins take a value: those of earlier rounds are smaller by their round.
        have[fresh] = now[fresh] | np.uint64(1)
        out[rows] = have
        rows = rows[(have == 0).any(axis=1)]
    return out


def bands(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """The key of each band: a hash of its number and coordinates."""
    parts = sketch.reshape(len(sketch), sketch.shape[1] // rows, rows)
    key = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(rows):
        key = A.mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key


def _nodes(shingles: np.ndarray, first: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """A number for each set: equal for equal sets; sets without shingles get one of their own."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(A.mix(shingles), dtype=np.uint64)])
    sizes = np.diff(first).astype(np.uint64)
    sums = total[first[1:]] - total[first[:-1]]
    return A.mix(np.where(sizes > 0, A.mix(sums) + sizes, docs.view(np.uint64))).view(np.int64)


def sketched(texts: DataFrame, width: int) -> DataFrame:
    """The sketch table; a task gives the bands of equal sets once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for piece in A.slices(batches, "text", 1_000_000):
            shingles, first = shingle_sets(*A.flat(piece.column("text")), width)
            docs = np.asarray(piece.column("doc"), dtype=np.int64)
            nodes, sizes = _nodes(shingles, first, docs), np.diff(first)
            new = np.zeros(len(nodes), dtype=bool)
            for i, node in enumerate(nodes.tolist()):
                if sizes[i] and node not in seen:
                    seen.add(node)
                    new[i] = True
            chosen = np.flatnonzero(new)
            own = shingles[ranges(first[chosen], sizes[chosen])]
            sketch = sketches(own, np.concatenate([[0], np.cumsum(sizes[chosen])]))
            keys, short = bands(sketch), (sketch >> np.uint64(8)).astype(np.uint8)
            band_column, short_column = [None] * len(nodes), [None] * len(nodes)
            for j, i in enumerate(chosen.tolist()):
                band_column[i], short_column[i] = keys[j].astype("<i8" if keys.dtype == np.int64 else "<u8").tobytes(), short[j].tobytes()
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc"), piece.column("part"), pa.array(sizes.astype(np.int64)), pa.array(nodes), pa.array(band_column, pa.binary()), pa.array(short_column, pa.binary())],
                names=["doc", "part", "n_shingles", "node", "bands", "short"],
            )

    return map_arrow(texts.select("doc", "part", "text"), run, SKETCH)


def _exploded(sketch: DataFrame) -> DataFrame:
    """(key, node) of every band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = b"".join(batch.column("bands").to_pylist())
            keys = np.frombuffer(raw, "<i8")
            nodes = np.repeat(np.asarray(batch.column("node"), dtype=np.int64), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes)], names=["key", "node"])

    return map_arrow(sketch.filter("bands IS NOT NULL").select("node", "bands"), run, "key long, node long")


def confirmed(pairs: DataFrame, packed: DataFrame, width: int, per_cent: int) -> DataFrame:
    """Of the pairs (a, b) those whose full sets are similar enough: 100 * shared >= per_cent * all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = zstandard.ZstdDecompressor()
        for batch in batches:
            a, b = (batch.column(i).to_pylist() for i in range(2))
            left, right = batch.column("left"), batch.column("right")
            good = []
            for at in range(0, batch.num_rows, 128):
                # Pairs come sorted by a, so texts repeat within a piece: each is cut up once.
                index: dict[bytes, int] = {}
                sides = [[index.setdefault(c[i].as_py(), len(index)) for i in range(at, min(at + 128, batch.num_rows))] for c in (left, right)]
                texts = [decompressor.decompress(x) for x in index]
                offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
                shingles, first = shingle_sets(np.frombuffer(b"".join(texts), np.uint8), offsets, width)
                sets = [shingles[i:j] for i, j in zip(first[:-1], first[1:])]
                for x, y in zip(*sides):
                    both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    good.append(100 * both >= per_cent * (len(sets[x]) + len(sets[y]) - both))
            keep = [i for i, g in enumerate(good) if g]
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], names=["a", "b"])

    left = packed.select(F.col("node").alias("a"), F.col("packed").alias("left"))
    right = packed.select(F.col("node").alias("b"), F.col("packed").alias("right"))
    sides = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "left", "right")
    return map_arrow(sides, run, "a long, b long")


def _wanted(sketch: DataFrame, members: DataFrame) -> DataFrame:
    """(node, doc, part): one document of each set that is in a bucket with another."""
    one = sketch.filter("bands IS NOT NULL").groupBy("node").agg(F.min(F.struct("doc", "part")).alias("at"))
    wanted = one.join(members.select("node").distinct(), "node", "left_semi")
    return stored(wanted.select("node", F.col("at.doc").alias("doc"), F.col("at.part").alias("part")), "minhash-wanted")


def _met(sketch: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, bands, short) of the sets in ``wanted``, each once."""
    rows = likely_among(sketch.filter("bands IS NOT NULL").select("node", "bands", "short"), wanted, ["node"])
    # Not a semi join, which would be pushed below the bitmap.
    return stored(rows.join(wanted.select("node"), "node").dropDuplicates(["node"]), "minhash-met")


def _packed(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, packed): the compressed texts of the documents in ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=3)
        for piece in A.slices(batches, "text"):
            data, offsets = A.flat(piece.column("text"))
            raw, at = data.tobytes(), offsets.tolist()
            blobs = pa.array([compressor.compress(raw[a:b]) for a, b in zip(at, at[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([piece.column("doc"), piece.column("part"), blobs], names=["doc", "part", "packed"])

    likely = likely_among(texts.select("doc", "part", "text"), wanted, ["doc", "part"])
    blobs = map_arrow(likely, run, "doc long, part long, packed binary")
    found = blobs.join(wanted, ["doc", "part"]).select("node", "packed")
    if texts.several:  # rows that are equal throughout
        found = found.dropDuplicates(["node"])
    return stored(found, "minhash-packed")


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    joined = members.join(labels, "node", "left")
    return joined.select("key", "node", F.coalesce("label", "node").alias("label"))


def _by_block(function: Callable[[list], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``function`` over the rows of each block, which arrive sorted by (key, i, q); it sees the columns after these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows = None, []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for key, row in zip(zip(*columns[:3]), zip(*columns)):
                if key != last and rows:
                    yield from function(rows)
                    rows = []
                last = key
                rows.append(row)
        if rows:
            yield from function(rows)

    return run


def _sides(rows: list) -> tuple[list, list, np.ndarray]:
    """The askers of a block, the sets asked, and in how many coordinates they agree; -1 below the least and for equal labels."""
    asking, others = ([r for r in rows if r[3] == asks] for asks in (True, False))
    if not asking or not others:
        return asking, others, np.zeros((len(asking), len(others)), np.int64)
    short = [np.frombuffer(b"".join([r[6] for r in own]), np.uint8).reshape(len(own), BINS) for own in (asking, others)]
    label = [np.array([r[5] for r in own], dtype=np.int64) for own in (asking, others)]
    agreed = np.stack([(short[1] == own).sum(axis=1) for own in short[0]])
    return asking, others, np.where((agreed >= LEAST_AGREED * BINS) & (label[0][:, None] != label[1][None, :]), agreed, -1)


def _dealt(blocks: DataFrame) -> DataFrame:
    return blocks.repartition("key", "i", "q").sortWithinPartitions("key", "i", "q")


def _nearest(blocks: DataFrame, most: int) -> DataFrame:
    """Pairs (a, b) of different labels: for each asking set its ``most`` nearest partners in a block."""

    def out(rows: list) -> Iterator[pa.RecordBatch]:
        asking, others, near = _sides(rows)
        if not (near >= 0).any():
            return
        a, b = (np.array([r[4] for r in own], dtype=np.int64) for own in (asking, others))
        order = np.lexsort((np.broadcast_to(b, near.shape), -near), axis=1)[:, :most]
        left = np.repeat(np.arange(len(a)), order.shape[1])
        right = order.ravel()
        good = near[left, right] >= 0
        x, y = a[left[good]], b[right[good]]
        pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    return map_arrow(_dealt(blocks), _by_block(out), "a long, b long")


def _near_rows(blocks: DataFrame) -> DataFrame:
    """The rows of ``blocks`` whose set has a near partner of another label in its block."""

    def out(rows: list) -> Iterator[pa.RecordBatch]:
        asking, others, near = _sides(rows)
        if not (near >= 0).any():
            return
        chosen = [asking[x] for x in np.flatnonzero((near >= 0).any(axis=1))]
        chosen += [others[y] for y in np.flatnonzero((near >= 0).any(axis=0))]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
        names = ["key", "i", "q", "asks", "node", "label", "short"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*chosen), kinds)], names=names)

    schema = "key long, i int, q int, asks boolean, node long, label long, short binary"
    return map_arrow(_dealt(blocks), _by_block(out), schema)


def _linked(blocks: DataFrame, width: int, per_cent: int) -> DataFrame:
    """Links (a, b) between the labels of all near pairs of a block that are similar enough on full sets.

    ``blocks`` are rows of ``_near_rows`` with ``bands`` and ``packed``. A pair is tried where its first
    common band meets, and only while the block's own links do not connect it.
    """

    def out(rows: list) -> Iterator[pa.RecordBatch]:
        asking, others, near = _sides(rows)
        if not (near >= 0).any():
            return
        here = np.int64(rows[0][0])
        bands_of = np.stack([np.frombuffer(r[7], "<i8") for r in others])
        decompressor, held, at = zstandard.ZstdDecompressor(), {}, {"size": 0}

        def full(wanted: list) -> list[np.ndarray]:
            new = [r for r in {r[4]: r for r in wanted}.values() if r[4] not in held]
            if at["size"] > MOST_HELD:
                keep = {r[4] for r in wanted}
                for node in [n for n in held if n not in keep]:
                    at["size"] -= len(held.pop(node))
            texts = [decompressor.decompress(r[8]) for r in new]
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            shingles, first = shingle_sets(np.frombuffer(b"".join(texts), np.uint8), offsets, width)
            for r, i, j in zip(new, first[:-1], first[1:]):
                held[r[4]] = shingles[i:j].copy()
                at["size"] += int(j - i)
            return [held[r[4]] for r in wanted]

        group: dict[int, int] = {}

        def root(label: int) -> int:
            while (up := group.get(label, label)) != label:
                group[label] = label = group.get(up, up)
            return label

        a_labels, b_labels = [], []
        for x, asker in enumerate(asking):
            partners = np.flatnonzero(near[x] >= 0)
            if not len(partners):
                continue
            same = bands_of[partners] == np.frombuffer(asker[7], "<i8")
            first_shared = bands_of[partners, same.argmax(axis=1)]
            partners = partners[same.any(axis=1) & (first_shared == here)]
            partners = partners[np.argsort(-near[x][partners], kind="stable")].tolist()
            for start in range(0, len(partners), 64):
                some = [others[y] for y in partners[start : start + 64] if root(others[y][5]) != root(asker[5])]
                if not some:
                    continue
                own, *sets = full([asker, *some])
                lengths = np.array([len(s) for s in sets])
                every = np.concatenate(sets)
                place = np.minimum(np.searchsorted(own, every), len(own) - 1)
                both = np.add.reduceat((own[place] == every).astype(np.int64), np.cumsum(lengths) - lengths)
                for i in np.flatnonzero(100 * both >= per_cent * (len(own) + lengths - both)).tolist():
                    low, high = sorted((root(asker[5]), root(some[i][5])))
                    if low != high:
                        group[high] = low
                        a_labels.append(asker[5])
                        b_labels.append(some[i][5])
        if a_labels:
            yield pa.RecordBatch.from_arrays([pa.array(a_labels, pa.int64()), pa.array(b_labels, pa.int64())], names=["a", "b"])

    return map_arrow(_dealt(blocks), _by_block(out), "a long, b long")


def _open(at: DataFrame, part: int) -> DataFrame:
    """(key, label, blocks, asking): buckets with several labels, the most frequent one, and how many
    blocks all of their sets and those with other labels make."""
    if part > 1:
        at = at.filter(F.pmod(F.xxhash64("key"), F.lit(part)) == 0)
    sizes = at.groupBy("key", "label").count().groupBy("key")
    sizes = sizes.agg(F.sum("count").alias("all"), F.max(F.struct("count", "label")).alias("top")).filter(F.col("all") > F.col("top.count"))
    blocks = F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks")
    asking = F.ceil((F.col("all") - F.col("top.count")) / BLOCK).cast("int").alias("asking")
    return sizes.select("key", F.col("top.label").alias("top"), blocks, asking)


def _blocks(at: DataFrame, open_: DataFrame, met: DataFrame) -> DataFrame:
    """The sets of open buckets in blocks, and those outside the largest component as questions to
    every block, with their short sketches."""
    found = at.join(open_, "key").withColumn("hash", F.xxhash64("node"))

    def dealt(rows: DataFrame, asks: bool) -> DataFrame:
        own_blocks, other_blocks = ("asking", "blocks") if asks else ("blocks", "asking")
        own = F.pmod(F.col("hash"), F.col(own_blocks).cast("long")).cast("int")
        rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col(other_blocks) - 1)))
        i, q = ("other", "own") if asks else ("own", "other")
        return rows.select("key", F.col(i).alias("i"), F.col(q).alias("q"), F.lit(asks).alias("asks"), "node", "label")

    both = dealt(found, False).unionByName(dealt(found.filter(F.col("label") != F.col("top")), True))
    rows = both.join(met.select("node", "short"), "node")
    return rows.select("key", "i", "q", "asks", "node", "label", "short")


def links_and_labels(texts: DataFrame, sketch: DataFrame, width: int, per_cent: int) -> DataFrame:
    """(node, label) of all sets that are linked with another one."""
    rows = _exploded(sketch)
    shared = stored(rows.groupBy("key").count().filter("count > 1").select("key"), "minhash-keys")
    members = stored(rows.join(shared, "key").distinct(), "minhash-members")
    wanted = _wanted(sketch, members)
    met, packed = _met(sketch, wanted), _packed(texts, wanted)
    least = stored(members.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a < z"), "minhash-least")
    pairs = members.join(least, "key").filter("node > a").groupBy("a", F.col("node").alias("b")).count()
    often = pairs.groupBy("b").agg(F.max(F.struct("count", -F.col("a"))).alias("best"))
    first = stored(often.select((-F.col("best.col2")).alias("a"), "b"), "minhash-pairs")
    links = stored(confirmed(first, packed, width, per_cent), "minhash-links")
    labels = stored(components(links), "minhash-labels")
    for part, most in ROUNDS:
        at = stored(_labelled(members, labels), "minhash-labelled")
        open_ = stored(_open(at, part), "minhash-open")
        near = stored(_nearest(_blocks(at, open_, met), most).distinct(), "minhash-pairs")
        if near.isEmpty():
            if part == 1:
                return labels  # no bucket has near sets of different components
            continue
        new = stored(confirmed(near, packed, width, per_cent), "minhash-links")
        if not new.isEmpty():
            labels = stored(merged(labels, new), "minhash-labels")
    at = stored(_labelled(members, labels), "minhash-labelled")
    open_ = stored(_open(at, 1), "minhash-open")
    rows = stored(_near_rows(_blocks(at, open_, met)), "minhash-near")
    if not rows.isEmpty():
        near = rows.select("node").distinct()
        banded = met.select("node", "bands").join(near, "node", "left_semi")
        whole = rows.join(banded.join(packed, "node"), "node").select(*rows.columns, "bands", "packed")
        new = stored(_linked(whole, width, per_cent).distinct(), "minhash-links")
        if not new.isEmpty():
            labels = stored(merged(labels, new), "minhash-labels")
    return labels


def grouped(documents: DataFrame, shingle: int = 2, per_cent: int = 80) -> DataFrame:
    """(doc, part, doc_id, n_shingles, group, component, component_id) of every row.

    Documents are linked if their sets' similarity is at least ``per_cent``; ``component_id`` is
    the smallest doc_id that links lead to. A null, empty or blank text has an empty set and is
    linked with nothing. A null doc_id counts as smaller than any other. Rows that share a doc_id
    but not the text are different documents; rows equal in both are linked like copies.
    """
    texts, _ = keyed(documents)
    sketch = stored(sketched(texts, shingle), "minhash-sketches")
    labels = links_and_labels(texts, sketch, shingle, per_cent)
    sets = stored(sketch.filter("n_shingles > 0").groupBy("node").agg(F.min("doc").alias("first")), "minhash-sets")
    by_node = smallest_ids(labels, sets)
    rows = sketch.select("doc", "part", "n_shingles", "node").join(by_node, "node", "left")
    null = F.lit(NULL_ID)
    return rows.select(
        "doc",
        "part",
        F.nullif("doc", null).alias("doc_id"),
        "n_shingles",
        F.coalesce("label", "node").alias("group"),
        F.coalesce("component", "doc").alias("component"),
        F.nullif(F.coalesce("component", "doc"), null).alias("component_id"),
    )


def keep_one(documents: DataFrame, shingle: int = 5, per_cent: int = 80) -> DataFrame:
    """The rows of ``documents`` without near copies: of each group the row with the smallest doc_id.

    Of several texts with that doc_id one stays.
    Documents without words are no copies of each other and stay.
    """
    texts, _ = keyed(documents)
    found = grouped(documents, shingle, per_cent)
    one = found.filter("n_shingles > 0").groupBy("group").agg(F.min(F.struct("doc", "part")).alias("at"))
    lone = found.filter("n_shingles = 0").select("doc", "part").distinct()
    kept = one.select("at.doc", "at.part").unionByName(lone)
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(A.WORD)) > 0
    rows = documents.select(F.struct("*").alias("row"), doc_key().alias("doc"), part_key(texts).alias("part"), words.alias("words"))
    rows = rows.join(kept, ["doc", "part"], "left_semi")
    if texts.several:
        same = Window.partitionBy("doc", "part").orderBy(F.lit(1))
        rows = rows.withColumn("nth", F.when(F.col("words"), F.row_number().over(same)).otherwise(1)).filter("nth = 1")
    return rows.select("row.*")

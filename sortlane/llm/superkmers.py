"""Super-k-mer partitioning: equal windows meet in one bucket, packed with their neighbours.

A window is ``k`` consecutive units (words or bytes) of one text. Its minimiser is the least hash
of the grams of ``m`` units in it, so equal windows have equal minimisers. Consecutive windows
that share the minimiser at one place travel as one string to the minimiser's bucket.

A gram that stands in very many places would fill one bucket. Such grams are counted first and
rank last: they are a window's minimiser only if all of the window's grams are among them, which
holds for the inside of passages that many texts share; there the strings are equal, and equal
strings are joined into one before the shuffle. The list of such grams is bounded, because each
holds more than a fixed share of all grams.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortlane.llm import arrays as A
from sortlane.llm.tables import map_arrow, pack_texts, stored

# Bytes of text that a task packs together, and bytes of strings wanted in a bucket.
FLUSH_BYTES = 4_000_000
BUCKET_BYTES = 3_000_000
# Not many more grams than this are listed as frequent: each holds such a share of all places.
MOST_FREQUENT = 500_000

PACKED = "bucket int, blob binary, doc binary, part binary, start binary, windows binary"
SPANS = "doc long, part long, start long, length long"


@dataclass(frozen=True)
class Scheme:
    """How texts are cut: window and gram width in units, and the units."""

    k: int
    m: int
    # (bytes, row bounds) -> (bytes to cut from, starts of units, ends of units, first unit of rows, gram hashes)
    units: Callable

    @property
    def width(self) -> int:
        return self.k - self.m + 1


@dataclass
class Strings:
    """Packed windows: of the document (doc, part), from unit ``start`` on, and their bytes."""

    doc: np.ndarray
    part: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    minimiser: np.ndarray
    data: np.ndarray
    at: np.ndarray
    length: np.ndarray

    FIELDS = ("doc", "part", "start", "windows", "minimiser", "at", "length")

    def take(self, index: np.ndarray) -> Strings:
        return Strings(**{f: getattr(self, f)[index] for f in self.FIELDS}, data=self.data)

    def __len__(self) -> int:
        return len(self.doc)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))


def join(parts: list[Strings]) -> Strings:
    shift = np.cumsum([0, *[len(p.data) for p in parts]])
    columns = {f: np.concatenate([getattr(p, f) for p in parts]) for f in Strings.FIELDS if f != "at"}
    at = np.concatenate([p.at + s for p, s in zip(parts, shift)])
    return Strings(**columns, at=at, data=np.concatenate([p.data for p in parts]))


def in_order(strings: Strings) -> Strings:
    """By (doc, part, start), each place once: rows that are equal throughout are one document."""
    order = np.lexsort((strings.start, strings.part, strings.doc))
    keys = [getattr(strings, f)[order] for f in ("doc", "part", "start")]
    new = np.ones(len(order), dtype=bool)
    if len(order) > 1:
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return strings.take(order[new])


class Frequent:
    """Tells which grams are in a sorted list."""

    BITS = 22

    def __init__(self, grams: np.ndarray):
        self.grams = grams
        self.seen = np.zeros(1 << self.BITS, dtype=bool)
        self.seen[self._top(grams)] = True

    def _top(self, grams: np.ndarray) -> np.ndarray:
        return (grams >> np.uint64(64 - self.BITS)).astype(np.int64)

    def mark(self, grams: np.ndarray) -> np.ndarray:
        out = np.zeros(len(grams), dtype=bool)
        if len(self.grams):
            near = np.flatnonzero(self.seen[self._top(grams)])
            place = np.minimum(np.searchsorted(self.grams, grams[near]), len(self.grams) - 1)
            out[near[self.grams[place] == grams[near]]] = True
        return out


def strings_of(piece: pa.RecordBatch, scheme: Scheme, frequent: Frequent) -> Strings:
    """All windows of the rows of a slice with the columns doc, part and text."""
    data, starts, ends, first, grams = scheme.units(*A.flat(piece.column("text")))
    order = grams >> np.uint64(1) | frequent.mark(grams).astype(np.uint64) << np.uint64(63)
    low = A.sliding_min(order, scheme.width)
    windows = np.maximum(np.diff(first) - scheme.k + 1, 0)
    at = ranges(first[:-1], windows)
    row = np.repeat(np.arange(len(windows)), windows)
    least = low[at]
    new = np.ones(len(at), dtype=bool)
    # A string's windows hold their first minimiser at one place, so no two of them are equal.
    moved = order[np.maximum(at[1:] - 1, 0)] == least[1:]
    new[1:] = moved | (least[1:] != least[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(at)))
    unit, row = at[begin], row[begin]
    left, right = starts[unit], ends[unit + count + scheme.k - 2] if len(unit) else unit
    doc, part = (np.asarray(piece.column(c), dtype=np.int64) for c in ("doc", "part"))
    return Strings(doc[row], part[row], unit - first[row], count, least[begin], data, left, right - left)


def _planes(values: np.ndarray) -> bytes:
    """Integers byte plane by byte plane, which packs small ones well."""
    return values.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplaned(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(8, n).T.copy().view("<i8").ravel()


def packed(strings: Strings, compressor: zstandard.ZstdCompressor) -> bytes:
    numbers = [strings.doc, strings.part, strings.start, strings.windows, strings.minimiser.view(np.int64), strings.length]
    body = b"".join(_planes(x) for x in numbers) + A.gather(strings.data, strings.at, strings.length).tobytes()
    return struct.pack("<q", len(strings)) + compressor.compress(body)


def unpacked(blob: bytes, decompressor: zstandard.ZstdDecompressor) -> Strings:
    (n,) = struct.unpack_from("<q", blob)
    raw = decompressor.decompress(blob[8:])
    doc, part, start, windows, minimiser, length = (_unplaned(raw[8 * n * i : 8 * n * (i + 1)], n) for i in range(6))
    at = np.cumsum(length) - length
    return Strings(doc, part, start, windows, minimiser.view(np.uint64), np.frombuffer(raw, np.uint8, offset=48 * n), at, length)


def fingerprints(strings: Strings) -> np.ndarray:
    """Hashes of the strings' bytes, with their minimiser."""
    own = A.span_hash(A.rolling(strings.data), strings.at, strings.at + strings.length)
    return A.mix(own + strings.minimiser)


def buckets_for(texts: DataFrame, size: int, scheme: Scheme) -> int:
    """Enough buckets for their strings to stay small, and for all reducers to have some."""
    spread = 1 + (scheme.k - 1) / ((scheme.width + 1) / 2)
    reducers = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return int(max(8 * reducers, size * spread // BUCKET_BYTES + 1))


def frequent_grams(texts: DataFrame, scheme: Scheme) -> np.ndarray:
    """Grams that hold more than about 1 / MOST_FREQUENT of all places, sorted.

    A task tells the grams that stand twice or more in what it packs together, if they hold a
    quarter of that share there.
    """
    shares = MOST_FREQUENT

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for piece in A.slices(batches, "text"):
            data, offsets = A.flat(piece.column("text"))
            _, _, _, first, grams = scheme.units(data, offsets)
            waiting.append(grams[ranges(first[:-1], np.maximum(np.diff(first) - scheme.m + 1, 0))])
            size += len(data)
            if size >= FLUSH_BYTES:
                yield from told(waiting)
                waiting, size = [], 0
        yield from told(waiting)

    def told(waiting: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if waiting:
            grams = np.concatenate(waiting)
            waiting.clear()
            grams.sort()
            edge = np.flatnonzero(grams[1:] != grams[:-1]) + 1
            bounds = np.concatenate([[0], edge, [len(grams)]]) if len(grams) else np.zeros(1, np.int64)
            n = np.diff(bounds)
            often = n >= max(2, len(grams) // (4 * shares))
            own = grams[bounds[:-1][often]].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *own.tolist()], pa.int64()), pa.array([len(grams), *n[often].tolist()], pa.int64())],
                names=["gram", "n"],
            )

    shares_told = map_arrow(texts.select("text"), count, "gram long, n long")
    sums = stored(shares_told.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    total = sums.filter("gram is null").agg(F.sum("n")).first()[0] or 0
    limit = max(2, 3 * total // (4 * shares))
    rows = sums.filter(F.col("gram").isNotNull() & (F.col("n") > limit)).select("gram").collect()
    return np.sort(np.array([r["gram"] for r in rows], dtype=np.int64).view(np.uint64))


def to_buckets(texts: DataFrame, scheme: Scheme, buckets: int, combine: Callable) -> DataFrame:
    """Blobs of strings by bucket, dealt out and sorted by bucket.

    ``combine(strings)`` joins equal strings of a task: it gives the strings that travel and
    those whose windows are known to be repeated, which travel as bare numbers.
    """
    frequent = texts.sparkSession.sparkContext.broadcast(frequent_grams(texts, scheme))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor, known = zstandard.ZstdCompressor(level=3), Frequent(frequent.value)
        waiting, size = [], 0
        for piece in A.slices(batches, "text"):
            waiting.append(strings_of(piece, scheme, known))
            size += len(waiting[-1].data)
            if size >= FLUSH_BYTES:
                yield from flush(waiting, compressor)
                waiting, size = [], 0
        yield from flush(waiting, compressor)

    def flush(waiting: list[Strings], compressor: zstandard.ZstdCompressor) -> Iterator[pa.RecordBatch]:
        if not sum(map(len, waiting)):
            return
        travelling, known = combine(join(waiting))
        rows: dict[int, list] = {}
        for strings, key in ((travelling, travelling.minimiser), (known, known.doc.view(np.uint64))):
            bucket = (A.mix(key) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order])) + 1
            for own in np.split(order, edges) if len(order) else []:
                row = rows.setdefault(int(bucket[own[0]]), [None, b"", b"", b"", b""])
                if strings is travelling:
                    row[0] = packed(strings.take(own), compressor)
                else:
                    row[1:] = [getattr(strings, f)[own].astype("<i8").tobytes() for f in ("doc", "part", "start", "windows")]
        columns = [pa.array(list(rows), pa.int32())]
        columns += [pa.array([r[i] for r in rows.values()], pa.binary()) for i in range(5)]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "blob", "doc", "part", "start", "windows"])

    blobs = map_arrow(texts.select("doc", "part", "text"), pack, PACKED)
    return blobs.repartition("bucket").sortWithinPartitions("bucket")


def repeated_spans(dealt: DataFrame, scheme: Scheme, find: Callable) -> DataFrame:
    """Spans of units (doc, part, start, length) covered by repeated windows.

    ``find(strings)`` gets all strings of a bucket and gives them back with a mark for each of
    their windows, in order.
    """

    def spans(strings: Strings, marked: np.ndarray) -> list[np.ndarray]:
        """Runs of marked windows of a string as spans."""
        hits = np.flatnonzero(marked)
        string = np.repeat(np.arange(len(strings)), strings.windows)[hits]
        new = np.ones(len(hits), dtype=bool)
        new[1:] = (np.diff(hits) != 1) | (np.diff(string) != 0)
        begin = np.flatnonzero(new)
        of = string[begin]
        offset = hits[begin] - (np.cumsum(strings.windows) - strings.windows)[of]
        length = np.diff(np.append(begin, len(hits))) + scheme.k - 1
        return [strings.doc[of], strings.part[of], strings.start[of] + offset, length]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = zstandard.ZstdDecompressor()
        bucket, waiting = None, []
        for batch in batches:
            numbers = [[np.frombuffer(x or b"", "<i8") for x in batch.column(i).to_pylist()] for i in range(2, 6)]
            known = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in numbers]
            if len(known[0]):
                yield out([*known[:3], known[3] + scheme.k - 1])
            for b, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if b != bucket and waiting:
                    yield out(spans(*find(join(waiting))))
                    waiting = []
                bucket = b
                if blob.is_valid:
                    waiting.append(unpacked(blob.as_py(), decompressor))
        if waiting:
            yield out(spans(*find(join(waiting))))

    def out(columns: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["doc", "part", "start", "length"])

    return map_arrow(dealt, run, SPANS)


def with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``rows``, with keys _doc and _part, and all spans of their document as ``_starts`` and ``_lengths``.

    The texts are compressed for the shuffle; ``unpack_texts`` gives them back.
    """
    per_doc = spans.groupBy("doc", "part").agg(F.collect_list(F.struct("start", "length")).alias("_spans"))
    joined = pack_texts(rows).join(per_doc.withColumnsRenamed({"doc": "_doc", "part": "_part"}), ["_doc", "_part"], "left")
    return joined.withColumns({"_starts": F.col("_spans.start"), "_lengths": F.col("_spans.length")}).drop("_spans", "_doc", "_part")


def covered(piece: pa.RecordBatch, first: np.ndarray) -> np.ndarray:
    """For each unit of a slice's rows whether a span covers it."""
    begin, length = piece.column("_starts"), piece.column("_lengths")
    n = np.array([len(x) if x.is_valid else 0 for x in begin], dtype=np.int64)
    row = np.repeat(np.arange(piece.num_rows), n)
    left = first[row] + np.asarray(begin.flatten(), dtype=np.int64)
    change = np.zeros(int(first[-1]) + 1, dtype=np.int64)
    np.add.at(change, left, 1)
    np.add.at(change, left + np.asarray(length.flatten(), dtype=np.int64), -1)
    return np.cumsum(change[:-1]) > 0

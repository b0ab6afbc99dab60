"""Substring dedup by super-k-mers: words covered by a window that stands earlier are removed.

Windows are ``WINDOW`` consecutive words of one document. Within a bucket all windows are sorted
by two independent 64-bit hashes of their words; of equal windows the one with the smallest
(doc_id, start) stays, all others are removed. Windows are judged on the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortlane.llm import arrays as A
from sortlane.llm import superkmers as S
from sortlane.llm.tables import doc_key, keyed, map_arrow, part_key, unpack_texts

WINDOW = 20
GRAM = 4


def normal_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words with one blank after each: bytes, starts, ends and first words of the rows."""
    starts, ends, first = A.word_bounds(data, offsets)
    length = ends - starts
    out = A.gather(np.append(data, np.uint8(32)), starts, length + 1)
    stop = np.cumsum(length + 1) - 1
    out[stop] = 32
    return out, stop - length, stop, first


def scheme(window: int = WINDOW, gram: int = GRAM) -> S.Scheme:
    def units(data, offsets):
        normal, starts, ends, first = normal_words(data, offsets)
        words = A.word_hashes(normal, starts, ends)
        return normal, starts, ends, first, A.gram_hash(A.token_prefix(words), gram)

    return S.Scheme(window, gram, units)


def _combine(strings: S.Strings) -> tuple[S.Strings, S.Strings]:
    """Of equal strings the first travels; the windows of the others stand earlier, in the first."""
    strings = S.in_order(strings)
    _, first = np.unique(S.fingerprints(strings), return_index=True)
    later = np.ones(len(strings), dtype=bool)
    later[first] = False
    return strings.take(np.sort(first)), strings.take(np.flatnonzero(later))


def _finder(window: int):
    def find(strings: S.Strings) -> tuple[S.Strings, np.ndarray]:
        strings = S.in_order(strings)
        data = A.gather(strings.data, strings.at, strings.length)
        offsets = np.concatenate([[0], np.cumsum(strings.length)])
        starts, ends, first = A.word_bounds(data, offsets)
        words = A.word_hashes(data, starts, ends)
        at = S.ranges(first[:-1], strings.windows)
        one = A.gram_hash(A.token_prefix(words), window)[at]
        two = A.gram_hash(A.token_prefix(words, 1), window)[at]
        order = np.argsort(one)
        if (one[order][1:] == one[order][:-1])[two[order][1:] != two[order][:-1]].any():
            order = np.lexsort((two, one))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        later = np.ones(len(order), dtype=bool)
        # The strings are in order, so the least number among equal windows is the first place.
        later[np.minimum.reduceat(order, np.flatnonzero(new))] = False
        return strings, later

    return find


def spans(texts: DataFrame, size: int, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Spans of words (doc, part, start, length) that stand earlier; ``texts`` from ``keyed``."""
    cut = scheme(window, gram)
    dealt = S.to_buckets(texts, cut, S.buckets_for(texts, size, cut), _combine)
    return S.repeated_spans(dealt, cut, _finder(window))


def _kept(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Numbers of words and of removed words, and the kept words joined by one blank."""
    normal, starts, ends, first = normal_words(*A.flat(piece.column("text")))
    gone = S.covered(piece, first)
    stay = np.flatnonzero(~gone)
    out = A.gather(normal, starts[stay], ends[stay] - starts[stay] + 1).tobytes()
    bounds = np.concatenate([[0], np.cumsum(ends[stay] - starts[stay] + 1)])
    at = bounds[np.searchsorted(stay, first)].tolist()
    removed = np.concatenate([[0], np.cumsum(gone)])[first]
    return np.diff(first), np.diff(removed), [out[a : b - 1] if b > a else b"" for a, b in zip(at, at[1:])]


def remove(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row; ``kept`` is the kept words joined by one blank.

    A null, empty or short text has no window and loses nothing. A null doc_id comes before any
    other; rows that share a doc_id but not the text are different documents, in the order of a
    hash of their texts; rows equal in both are one document and give equal results.
    """
    texts, size = keyed(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in unpack_texts(batches):
            n_words, n_removed, kept = _kept(piece)
            columns = [piece.column("doc_id"), pa.array(n_words), pa.array(n_removed), pa.array([k.decode() for k in kept], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept"])

    rows = texts.select(F.col("doc").alias("_doc"), F.col("part").alias("_part"), "doc_id", "text")
    marked = S.with_spans(rows, spans(texts, size, window))
    return map_arrow(marked, run, "doc_id long, n_words long, n_removed long, kept string")


def deduplicated(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``documents``; a text that loses words becomes its kept words joined by one blank."""
    texts, size = keyed(documents)
    others = [c for c in documents.columns if c != "text"]
    # The documents' own columns travel in one, so no name can meet another.
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), "text", doc_key().alias("_doc"), part_key(texts).alias("_part"))
    marked = S.with_spans(rows, spans(texts, size, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in unpack_texts(batches):
            _, n_removed, kept = _kept(piece)
            old = piece.column("text").to_pylist()
            text = pa.array([k.decode() if n else t for n, k, t in zip(n_removed, kept, old)], pa.string())
            yield pa.RecordBatch.from_arrays([piece.column("row"), text], names=["row", "text"])

    kept = marked.mapInArrow(run, rows.select("row", "text").schema)
    return kept.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in documents.columns])

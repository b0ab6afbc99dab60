"""Suffix-array dedup: bytes covered by a string of ``THRESHOLD`` bytes that stands twice go.

Suffixes are ordered through their first ``THRESHOLD`` bytes only, by most-significant-digit
passes. The first pass deals them out over the cluster: its digit is the suffix's minimiser, on
which equal beginnings agree, and suffixes whose minimiser stands once in the corpus are done.
Inside a bucket the digits are blocks of ``DIGIT`` bytes (64-bit hashes of them): each pass sorts
the suffixes still in play by (group, digit) and drops groups of one. What is left after the last
digit are exactly the beginnings that stand more than once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortlane.llm import arrays as A
from sortlane.llm import superkmers as S
from sortlane.llm.tables import keyed, map_arrow, unpack_texts

THRESHOLD = 400
DIGIT = 100


def scheme(threshold: int = THRESHOLD, digit: int = DIGIT) -> S.Scheme:
    def units(data, offsets):
        at = np.arange(len(data))
        return data, at, at + 1, offsets, A.gram_hash(A.rolling(data), digit)

    return S.Scheme(threshold, digit, units)


def _groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each distinct value, by value, and how often each stands."""
    order = np.argsort(values)
    new = np.zeros(len(values), dtype=np.int64)
    new[1:] = values[order][1:] != values[order][:-1]
    number = np.empty(len(values), dtype=np.int64)
    number[order] = np.cumsum(new)
    return number, np.bincount(number) if len(number) else np.zeros(0, np.int64)


def _combine(strings: S.Strings) -> tuple[S.Strings, S.Strings]:
    """Equal strings of a task are repeated, all of them; one travels, to meet those of other tasks."""
    number, times = _groups(S.fingerprints(strings))
    _, first = np.unique(number, return_index=True)
    return strings.take(np.sort(first)), strings.take(np.flatnonzero(times[number] > 1))


def repeated(data: np.ndarray, at: np.ndarray, threshold: int, digit: int) -> np.ndarray:
    """Which of the suffixes that begin at ``at`` share their first ``threshold`` bytes with another."""
    digits = A.gram_hash(A.rolling(data), digit)
    active, group = np.arange(len(at)), np.zeros(len(at), dtype=np.int64)
    for depth in [*range(0, threshold - digit, digit), threshold - digit]:
        key = A.mix(digits[at[active] + depth] + A.mix(group.astype(np.uint64)))
        number, times = _groups(key)
        rest = times[number] > 1
        active, group = active[rest], number[rest]
    out = np.zeros(len(at), dtype=bool)
    out[active] = True
    return out


def _finder(threshold: int, digit: int):
    def find(strings: S.Strings) -> tuple[S.Strings, np.ndarray]:
        number, times = _groups(strings.minimiser)
        strings = strings.take(np.flatnonzero(times[number] > 1))
        whole, copies = _groups(S.fingerprints(strings))
        marks = np.repeat(copies[whole] > 1, strings.windows) if len(strings) else np.zeros(0, bool)
        # One of equal strings stands for all; it needs sorting only beside others of its minimiser.
        _, first = np.unique(whole, return_index=True)
        number, times = _groups(strings.minimiser[first])
        chosen = first[times[number] > 1]
        some = strings.take(chosen)
        data = A.gather(some.data, some.at, some.length)
        at = S.ranges(np.cumsum(some.length) - some.length, some.windows)
        place = S.ranges((np.cumsum(strings.windows) - strings.windows)[chosen], some.windows)
        marks[place] |= repeated(data, at, threshold, digit) if len(at) else False
        return strings, marks

    return find


def remove(documents: DataFrame, threshold: int = THRESHOLD, digit: int = DIGIT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row; ``kept`` is the remaining bytes.

    All places of a repeated string go, the first included; overlapping places count; matches
    stay within a row. A null text is empty and a text below the threshold loses nothing. Rows
    that share a doc_id are different documents; rows that are equal throughout repeat each
    other and lose everything that is at least ``threshold`` bytes long.
    """
    texts, size = keyed(documents)
    cut = scheme(threshold, digit)
    dealt = S.to_buckets(texts, cut, S.buckets_for(texts, size, cut), _combine)
    spans = S.repeated_spans(dealt, cut, _finder(threshold, digit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in unpack_texts(batches):
            data, offsets = A.flat(piece.column("text"))
            gone = S.covered(piece, offsets)
            new = np.append(True, ~gone)  # a run can't go on from the byte before
            new[offsets] = True
            begins = gone & new[:-1]
            before = lambda flags: np.concatenate([[0], np.cumsum(flags)])[offsets]
            out, at = data[~gone].tobytes(), before(~gone).tolist()
            kept = pa.array([out[a:b] for a, b in zip(at, at[1:])], pa.binary())
            columns = [piece.column("doc_id"), pa.array(np.diff(offsets)), pa.array(np.diff(before(gone))), pa.array(np.diff(before(begins))), kept]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    rows = texts.select(F.col("doc").alias("_doc"), F.col("part").alias("_part"), "doc_id", "text")
    marked = S.with_spans(rows, spans)
    return map_arrow(marked, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")

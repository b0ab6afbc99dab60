"""Toxicity by compression distance: two Zstandard dictionaries, one of toxic and one of ordinary text.

A text becomes symbols, one for each four bytes in a row (lower case, one blank between words),
so that only passages of five or more bytes can match a dictionary. Each dictionary holds the
segments that cover the texts of its label best and are rare in the other's: the segment that
covers most is taken, what it covers counts half, and so on until none covers enough. Those of
the toxic dictionary may reach over the edges of words. Windows of ``WINDOW`` symbols are
compressed with either dictionary; a window begins with an anchor that both hold, which makes
the saving of a match the same wherever it stands. The score of a document is a calibrated
function of its windows' greatest and second greatest savings and differences.

Dictionaries and calibration are learned on bounded samples of labelled rows: at most
``DICTIONARY_ROWS`` and ``CALIBRATION_ROWS`` of each label, different ones, those with the least
hash of their id.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortlane.llm import arrays as A
from sortlane.llm.quality import sigmoid
from sortlane.llm.substring import normal_words
from sortlane.llm.tables import map_arrow

DICTIONARY_ROWS = 500
CALIBRATION_ROWS = 800
# Text in each dictionary at most.
DICTIONARY_BYTES = 32_768
SEGMENT_BYTES = range(5, 10)
# Segments are counted in one pass for each so many bytes of text, which bounds the memory.
PART_BYTES = 4_000_000
WINDOW = 64
OVERLAP = 8
# A window counts as a hit from this saving on, in bytes.
HIT = 8
ANCHOR = np.random.default_rng(7).integers(0, 256, 96, dtype=np.uint8).tobytes()


@dataclass(frozen=True)
class ToxicityModel:
    """Segments of both dictionaries and the weights of the features; ``weights`` None: nothing known."""

    toxic: tuple[bytes, ...] = ()
    ordinary: tuple[bytes, ...] = ()
    weights: tuple[float, ...] | None = None
    prior: float = 0.0


def symbols(data: np.ndarray) -> np.ndarray:
    """A 32-bit hash of each four bytes in a row."""
    wide = data.astype(np.uint64)
    if len(wide) < 4:
        return np.zeros(0, dtype="<u4")
    grams = wide[3:] | wide[2:-1] << np.uint64(8) | wide[1:-2] << np.uint64(16) | wide[:-3] << np.uint64(24)
    return (A.mix(grams) >> np.uint64(32)).astype("<u4")


def row_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[bytes, list[tuple[int, int]]]:
    """The symbols of a slice and, in symbols, where each row's begin and end."""
    words, starts, ends, first = normal_words(A.lowered(data), offsets)
    padded = np.concatenate([np.full(1, 32, np.uint8), words])
    coded = symbols(padded)
    bounds = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        # From the blank before the first word to the one after the last.
        bounds.append((int(starts[a]), max(int(starts[a]), int(ends[b - 1]) - 1)) if b > a else (0, 0))
    return coded.tobytes(), bounds


def compressor(segments: tuple[bytes, ...]) -> zstandard.ZstdCompressor:
    raw = b"".join(symbols(np.frombuffer(s, np.uint8)).tobytes() for s in reversed(segments)) + ANCHOR
    settings = zstandard.ZstdCompressionParameters(
        window_log=18, hash_log=15, chain_log=15, search_log=4, min_match=6, target_length=32,
        strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_dict_id=False,
    )
    known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=known, compression_params=settings)


FEATURES = 8


def features(coded: bytes, bounds: list[tuple[int, int]], toxic: zstandard.ZstdCompressor, ordinary: zstandard.ZstdCompressor) -> np.ndarray:
    """What the windows of each row save with the toxic dictionary, and more than with the ordinary one."""
    out = np.zeros((len(bounds), FEATURES))
    one, other = toxic.compress, ordinary.compress
    for row, (begin, end) in enumerate(bounds):
        saved, ahead = [0, 0], [0, 0]
        for at in range(begin, end, WINDOW):
            window = ANCHOR + coded[4 * at : 4 * min(at + WINDOW + OVERLAP, end)]
            length = len(one(window))
            saved.append(len(window) - len(ANCHOR) - length)
            ahead.append(len(other(window)) - length)
        n = len(saved) - 2
        # A window without a match saves a negative constant; what counts is above it.
        least = min(saved[2:], default=0)
        saved = sorted((s - least for s in saved[2:]), reverse=True)[:2] + [0, 0]
        hits = sum(a >= HIT for a in ahead[2:])
        ahead.sort(reverse=True)
        out[row] = [1, ahead[0], ahead[1], min(ahead[0], 20), min(ahead[1], 12), saved[1], hits, np.log1p(n)]
    return out


def held_out(doc_id: int | None) -> bool:
    """Rows whose labels are never learned from; a null id counts as the text ''."""
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 5 == 0


def _held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _segments(texts: list[bytes], n: int, phrases: bool, part: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, place) of the distinct segments of ``n`` bytes of each text, sorted by hash; one part of the hashes."""
    found = []
    for i, text in enumerate(texts):
        data = np.frombuffer(b" " + text + b" ", np.uint8)
        at = np.arange(max(len(data) - n + 1, 0))
        if not phrases:
            blanks = np.concatenate([[0], np.cumsum(data == 32)])
            at = at[blanks[at + n - 1] == blanks[at + 1]]
        h = A.span_hash(A.rolling(data), at, at + n)
        own = h % np.uint64(parts) == part
        h, first = np.unique(h[own], return_index=True)
        found.append((h, np.full(len(h), i, np.int32), at[own][first]))
    h, of, at = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(h, kind="stable")
    return h[order], of[order], at[order]


def cover(texts: list[bytes], others: list[bytes], rarer: float, phrases: bool = False) -> tuple[bytes, ...]:
    """Segments that cover the texts and are ``rarer`` times as rare in the others, best first.

    Those inside a word and its blanks, with ``phrases`` also such that reach over the edges of
    words. They are taken until none covers enough or the dictionary is full.
    """
    least = max(2, len(texts) // 300)
    share = len(texts) / max(len(others), 1)
    open_: dict[bytes, np.ndarray] = {}
    parts = sum(map(len, texts + others)) // PART_BYTES + 1
    for n in SEGMENT_BYTES:
        for part in range(parts):
            h, of, at = _segments(texts, n, phrases, part, parts)
            known, first, count = np.unique(h, return_index=True, return_counts=True)
            # Each known one once more than the others have it.
            both, times = np.unique(np.concatenate([_segments(others, n, phrases, part, parts)[0], known]), return_counts=True)
            elsewhere = times[np.searchsorted(both, known)] - 1
            for i in np.flatnonzero((count >= least) & (count > rarer * share * (elsewhere + 0.5))):
                text, place = b" " + texts[of[first[i]]] + b" ", at[first[i]]
                open_[text[place : place + n]] = of[first[i] : first[i] + count[i]]
    weight, chosen, joined = np.ones(len(texts)), [], b""
    # Weights only fall: a segment whose gain is still what it was when it was queued is the best.
    queue = [(-float(len(at) * (len(s) - 3)), s) for s, at in open_.items()]
    heapq.heapify(queue)
    while queue and len(joined) < DICTIONARY_BYTES:
        gain, best = heapq.heappop(queue)
        covers = weight[open_[best]].sum()
        if covers < least or best in joined:
            continue
        if -covers * (len(best) - 3) > gain:
            heapq.heappush(queue, (-covers * (len(best) - 3), best))
            continue
        chosen.append(best)
        joined += b"\n" + best
        weight[open_[best]] *= 0.5
    return tuple(chosen)


def _sample(documents: DataFrame, labels: DataFrame, rows: int) -> tuple[dict[int, list[bytes]], dict[int, int]]:
    """Texts of at most ``rows`` learnable rows of each label, and the number of such rows."""
    spark = documents.sparkSession
    agreed = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    agreed = agreed.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~_held_out())
    agreed = agreed.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).filter("toxic = other")
    counts = {r["toxic"]: r["count"] for r in agreed.groupBy("toxic").count().collect()}
    ids = []
    for toxic in (0, 1):
        least = agreed.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        ids += [(r["doc_id"], toxic, i) for i, r in enumerate(least.collect())]
    texts: dict[int, list[bytes]] = {0: [], 1: []}
    if len(counts) == 2:
        chosen = F.broadcast(spark.createDataFrame(ids, "doc_id long, toxic int, place int"))
        own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        for r in sorted(own.join(chosen, "doc_id").collect(), key=lambda r: (r["place"], r["text"])):
            texts[r["toxic"]].append(r["text"].encode())
    return texts, counts


def _plain(text: bytes) -> bytes:
    return b" ".join(text.translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split())


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Newton steps of a logistic regression with a small ridge; the first column is constant."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    scale[0] = 1.0
    x, at = x / scale, np.zeros(x.shape[1])
    ridge = np.full(len(at), 0.5)
    ridge[0] = 1e-6
    for _ in range(40):
        p = sigmoid(x @ at)
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(bend, x.T @ (weight * (p - y)) + ridge * at)
        at = at - step * min(1.0, 3 / max(np.abs(step).max(), 1e-9))
    return at / scale


def fit(documents: DataFrame, labels: DataFrame, dictionary_rows: int = DICTIONARY_ROWS, calibration_rows: int = CALIBRATION_ROWS) -> ToxicityModel:
    """Learned from labelled rows that aren't held out; whole texts.

    Labels other than 0 and 1, null ids and ids with both labels are left out. Without rows of
    both labels every score is the share of toxic rows (0 if there are none).
    """
    texts, counts = _sample(documents, labels, dictionary_rows + calibration_rows)
    known = sum(counts.values())
    prior = counts.get(1, 0) / known if known else 0.0
    # Where there are few rows, three fifths of each label make the dictionaries.
    cut = {c: min(dictionary_rows, 3 * len(texts[c]) // 5) for c in texts}
    learn = {c: [_plain(t) for t in texts[c][: cut[c]]] for c in texts}
    test = {c: texts[c][cut[c] :] for c in texts}
    if not all(learn.values()) or not all(test.values()):
        return ToxicityModel(prior=prior)
    toxic, ordinary = cover(learn[1], learn[0], 20.0, phrases=True), cover(learn[0], learn[1], 1.5)
    raw = test[0] + test[1]
    y = np.array([0] * len(test[0]) + [1] * len(test[1]))
    one, other = compressor(toxic), compressor(ordinary)
    x = np.concatenate([_row_features(t, one, other) for t in raw])
    weight = np.where(y == 1, prior / len(test[1]), (1 - prior) / len(test[0])) * len(y)
    return ToxicityModel(toxic, ordinary, tuple(_logistic(x, y, weight).tolist()), prior)


def _row_features(text: bytes, one, other) -> np.ndarray:
    return features(*row_symbols(np.frombuffer(text, np.uint8), np.array([0, len(text)])), one, other)


def score(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; only the text decides the score.

    A null or empty text has no windows and gets a score like any other; rows with equal ids stay
    apart. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, other = compressor(model.toxic), compressor(model.ordinary)
        for piece in A.slices(batches, "text"):
            if model.weights is None:
                p = np.full(piece.num_rows, model.prior)
            else:
                p = sigmoid(features(*row_symbols(*A.flat(piece.column("text"))), one, other) @ np.array(model.weights))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(p, pa.float64())], names=["doc_id", "score"])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = map_arrow(texts, run, "doc_id long, score double")
    return scored.select("doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

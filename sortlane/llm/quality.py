"""Quality rules: fixed counts, and a calibrated classifier over hashed n-grams.

The classifier is a logistic regression over three families of hashed n-grams (three-byte
grams, words, pairs of words), each as shares of the text's grams. It is fitted on a bounded
sample of labelled rows (``PER_CLASS`` of each label, those with the least hash of their id),
its scores are turned into probabilities on a part of the sample that it was not fitted on, and
a document is kept if its probability of being good is at least ``KEEP``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortlane.llm import arrays as A
from sortlane.llm.tables import map_arrow

FEWEST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words
REPEAT_WINDOW = 5
SYMBOLS = "#*$%&|<>"
PER_CLASS = 1000
KEEP = 0.5
FAMILY_BITS = 16
FAMILIES = 3
DIMENSIONS = FAMILIES << FAMILY_BITS
STEPS = 200

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class QualityModel:
    """Weights of the hashed grams and the calibration of their sum; ``weights`` None: no verdict."""

    weights: np.ndarray | None
    slope: float = 1.0
    shift: float = 0.0


def _families(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each family the feature numbers of all grams of a slice, and where each row's begin."""
    top = np.uint64(64 - FAMILY_BITS)
    starts, ends, first = A.word_bounds(data, offsets)
    wide = data.astype(np.uint64)
    grams = wide[2:] | wide[1:-1] << np.uint64(8) | wide[:-2] << np.uint64(16) if len(data) > 2 else wide[:0]
    inside = np.ones(len(grams), dtype=bool)
    for back in (1, 2):  # grams that would run over the end of a row
        edge = offsets[1:-1] - back
        inside[edge[(edge >= 0) & (edge < len(grams))]] = False
    at = np.concatenate([[0], np.cumsum(inside)])
    yield (A.mix(grams[inside]) >> top).astype(np.int64), at[np.minimum(offsets, len(grams))]
    words = A.word_hashes(data, starts, ends)
    yield (words >> top).astype(np.int64) + (1 << FAMILY_BITS), first
    pairs = A.gram_hash(A.token_prefix(words), 2)
    inside = np.ones(len(pairs), dtype=bool)
    edge = first[1:-1] - 1
    inside[edge[(edge >= 0) & (edge < len(pairs))]] = False
    at = np.concatenate([[0], np.cumsum(inside)])
    yield (pairs[inside] >> top).astype(np.int64) + (2 << FAMILY_BITS), at[np.minimum(first, len(pairs))]


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the values of each row, of which ``starts`` has the n + 1 bounds."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[starts[1:]] - total[starts[:-1]]


def scores(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    out = np.zeros(len(offsets) - 1)
    for numbers, starts in _families(data, offsets):
        out += _sums(weights[numbers].astype(np.float64), starts) / np.maximum(np.diff(starts), 1)
    return out


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    starts, ends, first = A.word_bounds(data, offsets)
    new_char = ((data & 0xC0) != 0x80) & ~A.SEPARATOR[data]
    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS.encode())] = True
    repeated = np.zeros(len(starts), dtype=np.int64)
    windows = A.gram_hash(A.token_prefix(A.word_hashes(data, starts, ends)), REPEAT_WINDOW)
    if len(windows):
        row = np.searchsorted(first[1:], np.arange(len(windows)), "right")
        valid = np.flatnonzero(np.arange(len(windows)) + REPEAT_WINDOW <= first[1:][row])
        key = A.mix(windows[valid] + A.mix(row[valid].astype(np.uint64)))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        cover = np.zeros(len(starts) + 1, dtype=np.int64)
        np.add.at(cover, valid[twice], 1)
        np.add.at(cover, valid[twice] + REPEAT_WINDOW, -1)
        repeated = (np.cumsum(cover[:-1]) > 0).astype(np.int64)
    return {
        "n_words": np.diff(first),
        "word_chars": _sums(new_char.astype(np.int64), offsets),
        "n_symbols": _sums(symbol[data].astype(np.int64), offsets),
        "n_dup_lines": _dup_lines(data, offsets),
        "n_repeat_words": _sums(repeated, first),
    }


def _dup_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    raw = data.tobytes()
    out = np.zeros(len(offsets) - 1, dtype=np.int64)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        lines = [x for x in raw[a:b].split(b"\n") if x and not x.isspace()]
        out[i] = len(lines) - len(set(lines))
    return out


def _base_failed(n_words: np.ndarray, n_repeat: np.ndarray) -> np.ndarray:
    return (n_words < FEWEST_WORDS) | (100 * n_repeat > MOST_REPEATED * n_words)


def _sample(documents: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame | None, dict[int, int]]:
    """Texts of at most ``per_class`` rows of each label, and the number of rows of each."""
    spark = documents.sparkSession
    agreed = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("good"))
    agreed = agreed.filter(F.col("doc_id").isNotNull() & F.col("good").isin(0, 1))
    agreed = agreed.groupBy("doc_id").agg(F.min("good").alias("good"), F.max("good").alias("other")).filter("good = other")
    counts = {r["good"]: r["count"] for r in agreed.groupBy("good").count().collect()}
    if len(counts) < 2:
        return None, counts
    ids = []
    for good in (0, 1):
        least = agreed.filter(F.col("good") == good).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        ids += [(r["doc_id"], good) for r in least.collect()]
    chosen = F.broadcast(spark.createDataFrame(ids, "doc_id long, good int"))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(chosen, "doc_id"), counts


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in A.slices(batches, "text"):
        data, offsets = A.flat(piece.column("text"))
        families = list(_families(data, offsets))
        numbers, shares = [], []
        for i in range(piece.num_rows):
            n, s = [], []
            for all_numbers, starts in families:
                own = all_numbers[starts[i] : starts[i + 1]]
                found, times = np.unique(own, return_counts=True)
                n.append(found.astype(np.int32))
                s.append((times / max(len(own), 1)).astype(np.float32))
            numbers.append(np.concatenate(n).tobytes())
            shares.append(np.concatenate(s).tobytes())
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), piece.column("good"), pa.array(numbers, pa.binary()), pa.array(shares, pa.binary())],
            names=["doc_id", "good", "numbers", "shares"],
        )


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def calibrate(score: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the probability over the score, by Newton steps with smoothed labels."""
    up, down = weight[good == 1].sum(), weight[good == 0].sum()
    wanted = np.where(good == 1, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.stack([score, np.ones_like(score)])
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(at @ x)
        gradient = x @ (weight * (p - wanted)) + 1e-6 * at
        bend = (x * (weight * p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        at = at - np.clip(np.linalg.solve(bend, gradient), -5, 5)
    return float(max(at[0], 1e-3)), float(at[1])


def fit(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> QualityModel:
    """Fitted on at most ``per_class`` labelled documents of each label; whole texts.

    Labels other than 0 and 1, null ids and ids with both labels are left out. Without both
    labels there is no verdict.
    """
    texts, counts = _sample(documents, labels, per_class)
    if texts is None:
        return QualityModel(None)
    rows = map_arrow(texts, _features, "doc_id long, good int, numbers binary, shares binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["numbers"])))
    good = np.array([r["good"] for r in rows])
    if len(set(good.tolist())) < 2:
        return QualityModel(None)
    lengths = [len(r["numbers"]) // 4 for r in rows]
    numbers = np.concatenate([np.frombuffer(r["numbers"], np.int32) for r in rows])
    shares = np.concatenate([np.frombuffer(r["shares"], np.float32) for r in rows])
    row = np.repeat(np.arange(len(rows)), lengths)
    held = np.arange(len(rows)) % 4 == 0
    if len(set(good[held].tolist())) < 2 or len(set(good[~held].tolist())) < 2:
        held[:] = False
    share = np.array([(good[~held] == g).sum() for g in (0, 1)])
    balance = np.where(held, 0.0, 0.5 / np.maximum(share[good], 1))
    weights, mean, square = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    for step in range(1, STEPS + 1):
        score = np.bincount(row, shares * weights[numbers], len(rows))
        error = balance * (sigmoid(score) - good)
        gradient = np.bincount(numbers, shares * error[row], DIMENSIONS) + 1e-7 * weights
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        weights -= 0.3 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    score = np.bincount(row, shares * weights[numbers], len(rows))
    used = held if held.any() else np.ones(len(rows), dtype=bool)
    in_sample = np.array([(good[used] == g).sum() for g in (0, 1)])
    true_share = np.array([counts[0], counts[1]]) / (counts[0] + counts[1])
    weight = (true_share * used.sum() / np.maximum(in_sample, 1))[good[used]]
    slope, shift = calibrate(score[used], good[used], weight)
    return QualityModel(weights.astype(np.float32), slope, shift)


def score(documents: DataFrame, model: QualityModel, keep: float = KEEP) -> DataFrame:
    """doc_id, the counts, ``base_failed``, ``probability`` of being good and ``kept``, a row per row.

    A null or empty text has no words and fails the fixed rules. Without a model the probability
    is null and what the fixed rules let through is kept. Rows with equal ids stay apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in A.slices(batches, "text"):
            data, offsets = A.flat(piece.column("text"))
            counts = base_counts(data, offsets)
            failed = _base_failed(counts["n_words"], counts["n_repeat_words"])
            if model.weights is None:
                probability, kept = pa.nulls(len(failed), pa.float64()), ~failed
            else:
                p = sigmoid(model.slope * scores(data, offsets, model.weights) + model.shift)
                probability, kept = pa.array(p), ~failed & (p >= keep)
            columns = [piece.column("doc_id"), *[pa.array(counts[c].astype(np.int64)) for c in COUNTS]]
            columns += [pa.array(failed), probability, pa.array(kept)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *COUNTS, "base_failed", "probability", "kept"])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, probability double, kept boolean"
    return map_arrow(texts, run, schema)


def keep_good(documents: DataFrame, model: QualityModel, keep: float = KEEP) -> DataFrame:
    """The rows of ``documents`` that the rules and the model keep; all columns, no shuffle."""
    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in A.slices(batches, "text"):
            data, offsets = A.flat(piece.column("text"))
            counts = base_counts(data, offsets)
            kept = ~_base_failed(counts["n_words"], counts["n_repeat_words"])
            if model.weights is not None:
                kept &= sigmoid(model.slope * scores(data, offsets, model.weights) + model.shift) >= keep
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(kept)) for c in piece.columns], names=names)

    return documents.mapInArrow(run, documents.schema)

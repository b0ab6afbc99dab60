"""How five filters interact: what each removes in every order, and what it would remove alone.

A document's survival word has 32 bits, one for each subset of the filters; a bit is set if the
document passes all filters of its subset. Counting, for every part and label, how many words
have each bit gives the survivors of every subset, and the whole report is arithmetic on those
32 numbers. The counts are positional popcounts by carry-save addition: three words of the same
weight become one of that weight and one of twice it, so most words are added 32 bits at a time.

Which text a smaller id holds already is decided over the whole table: digests meet their least
doc_id, and only the (digest, doc_id) pairs that hold it pass. Both keys of that join hold the
id, so a text that stands in a third of all rows is spread like any other.

Defined cases: a null text is empty; a null source is the part ''; a null doc_id is smaller than
no other and has no label, so its text is never a repetition and makes none; rows that repeat a
doc_id count each; a doc_id with several label rows is good or toxic if one of them says so. An
empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortlane.llm import arrays as A
from sortlane.llm.tables import stored

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
# Least words, least share of distinct words and largest share of capitals in per
# cent, and the symbols of a code-like text.
LEAST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 2
SYMBOLS = b"#$%&*|"

REPEATED = 1 << FILTERS.index("E")
# The subset of a bit of the word is the bit's number, filter A being its lowest bit.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not failing & s) for failing in range(SUBSETS)], dtype=np.uint32)
ALL_WEIGHTS = 63

_CAPITAL = np.zeros(256, dtype=np.uint8)
_CAPITAL[65:91] = 1
_SYMBOL = np.zeros(256, dtype=np.uint8)
_SYMBOL[list(SYMBOLS)] = 1


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each row's values."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def failing(column: pa.Array) -> np.ndarray:
    """Which of the filters A to D each text fails, as the low four bits."""
    data, offsets = A.flat(column)
    starts, ends, first = A.word_bounds(data, offsets)
    words = np.diff(first)
    row = np.repeat(np.arange(len(words)), words)
    hashes = A.word_hashes(data, starts, ends)
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(row), dtype=np.int64)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    distinct = np.bincount(row, new, len(words)).astype(np.int64)
    points = _sums((data & 0xC0) != 0x80, offsets)
    capitals, symbols = _sums(_CAPITAL[data], offsets), _sums(_SYMBOL[data], offsets)
    fails = [words < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * words, 100 * capitals > MOST_CAPITALS * points, symbols > 0]
    return sum(np.where(hit, 1 << bit, 0) for bit, hit in enumerate(fails))


def positional_popcounts(words: np.ndarray, segment: np.ndarray, times: np.ndarray, segments: int) -> np.ndarray:
    """How often each bit is set among the words of each segment: (segments, 32) counts.

    A word counts ``times`` times. Words are added by carry-save: in every segment, three words
    of one weight become their sum bits and, at twice the weight, their carry bits, until at
    most two are left of each weight.
    """
    counts = np.zeros((segments, 32), dtype=np.int64)
    order = np.argsort(segment, kind="stable")
    words, segment, times = words[order], segment[order], times[order]
    carried: list[tuple[np.ndarray, np.ndarray]] = []
    for weight in range(ALL_WEIGHTS):
        at = (times >> weight) & 1 == 1
        pieces = [(words[at], segment[at]), *carried]
        w, s = (np.concatenate([p[i] for p in pieces]) for i in (0, 1))
        if weight and len(pieces) > 1:
            again = np.argsort(s, kind="stable")
            w, s = w[again], s[again]
        carried = []
        while len(w):
            first = np.searchsorted(s, s)
            rank = np.arange(len(s)) - first
            size = np.searchsorted(s, s, "right") - first
            whole = rank < size - size % 3
            if not whole.any():
                break
            a, b, c = (w[whole][k::3] for k in range(3))
            own = s[whole][::3]
            carried.append(((a & b) | (c & (a ^ b)), own))
            w, s = np.concatenate([a ^ b ^ c, w[~whole]]), np.concatenate([own, s[~whole]])
            again = np.argsort(s, kind="stable")
            w, s = w[again], s[again]
        if len(w):
            bits = np.unpackbits(w.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
            np.add.at(counts, s, bits.astype(np.int64) << weight)
        if not carried and not (times >> (weight + 1)).any():
            break
    return counts


def measured(documents: DataFrame) -> DataFrame:
    """(doc, part, digest, fails, n): documents with the same values are one row that counts n times."""
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).withColumn("digest", F.when(F.col("doc").isNotNull(), F.unhex(F.sha2("text", 256))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in A.slices(batches, "text"):
            fails = pa.array(failing(piece.column("text")).astype(np.int32))
            columns = [piece.column(c) for c in ("doc", "part", "digest")]
            yield pa.RecordBatch.from_arrays([*columns, fails], names=["doc", "part", "digest", "fails"])

    keys = ["doc", "part", "digest", "fails"]
    return rows.mapInArrow(run, "doc long, part string, digest binary, fails int").groupBy(*keys).agg(F.count("*").alias("n"))


def _with_repetition(rows: DataFrame) -> DataFrame:
    """Set the bit of E where a smaller doc_id holds the same text."""
    least = rows.filter(F.col("doc").isNotNull()).groupBy("digest").agg(F.min("doc").alias("doc")).withColumn("_least", F.lit(True))
    known = rows.filter(F.col("doc").isNotNull()).join(least, ["digest", "doc"], "left")
    repeated = known.withColumn("fails", F.when(F.col("_least"), F.col("fails")).otherwise(F.col("fails").bitwiseOR(REPEATED)))
    names = ["doc", "part", "fails", "n"]
    return repeated.select(*names).unionByName(rows.filter(F.col("doc").isNull()).select(*names))


def _with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``good`` and ``toxic``."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc"), "quality", "toxic").filter(F.col("doc").isNotNull())
    marks = marks.groupBy("doc").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    known = rows.filter(F.col("doc").isNotNull()).join(marks, "doc", "left").select("part", "fails", "n", "good", "toxic")
    unknown = rows.filter(F.col("doc").isNull()).select("part", "fails", "n", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    return known.unionByName(unknown)


def survivors(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, everyone, good, toxic): three arrays with the survivors of each of the 32 subsets."""
    rows = _with_labels(_with_repetition(stored(measured(documents), "filter-audit-measured")), labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("part").dictionary_encode()
            names, part = parts.dictionary, np.asarray(parts.indices, dtype=np.int64)
            words, times = WORDS[np.asarray(batch.column("fails"))], np.asarray(batch.column("n"))
            counts = []
            for mark in (None, "good", "toxic"):
                at = slice(None) if mark is None else np.asarray(batch.column(mark).fill_null(False).to_numpy(zero_copy_only=False), dtype=bool)
                counts.append(positional_popcounts(words[at], part[at], times[at], len(names)))
            table = np.stack(counts, axis=1).reshape(-1)
            at = np.repeat(np.arange(len(names)), 3 * SUBSETS)
            slot = np.tile(np.arange(3 * SUBSETS, dtype=np.int32), len(names))
            held = table > 0
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(at[held])), pa.array(slot[held]), pa.array(table[held])], names=["part", "slot", "n"]
            )

    partial = rows.mapInArrow(run, "part string, slot int, n long")
    total = partial.groupBy("part", "slot").agg(F.sum("n").alias("n"))
    # At most 96 entries for a part.
    slots = total.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("slot", "n"))).alias("slots"))

    def filled(start: int) -> Column:
        each = F.sequence(F.lit(start), F.lit(start + SUBSETS - 1))
        return F.transform(each, lambda s: F.coalesce(F.try_element_at("slots", s), F.lit(0).cast("long")))

    return slots.select("part", filled(0).alias("everyone"), filled(SUBSETS).alias("good"), filled(2 * SUBSETS).alias("toxic"))


def _steps() -> Column:
    """Every step of every order: the subset applied before it and the bit of its filter."""
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            rows.append({"filter_order": "".join(order), "step": step, "before": before, "bit": bit})
            before |= bit
    schema = "array<struct<filter_order: string, step: int, before: int, bit: int>>"
    return F.from_json(F.lit(json.dumps(rows)), schema)


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step."""
    parts = survivors(documents, labels)
    steps = parts.select("*", F.inline(_steps()))

    def of(counts: str, subset: Column) -> Column:
        return F.get(F.col(counts), subset)

    before, bit = F.col("before"), F.col("bit")
    after, others = before.bitwiseOR(bit), F.lit(SUBSETS - 1).bitwiseXOR(bit)
    nothing, everything = F.lit(0), F.lit(SUBSETS - 1)

    def lost(counts: str) -> Column:
        return of(counts, before) - of(counts, after)

    # A subset of size s stands before the filter in s! (4 - s)! orders.
    weight = [factorial(bin(s).count("1")) * factorial(max(len(FILTERS) - 1 - bin(s).count("1"), 0)) for s in range(SUBSETS)]
    weights = F.array(*[F.lit(w).cast("long") for w in weight])
    without = F.filter(F.sequence(nothing, everything), lambda s: s.bitwiseAND(bit) == 0)
    shapley = F.aggregate(
        without, F.lit(0).cast("long"),
        lambda total, s: total + F.get(weights, s) * (of("everyone", s) - of("everyone", s.bitwiseOR(bit))),
    )
    return steps.select(
        "part",
        "filter_order",
        "step",
        of("everyone", after).alias("kept"),
        lost("everyone").alias("removed"),
        (of("everyone", nothing) - of("everyone", bit) - lost("everyone")).alias("redundant"),
        (of("everyone", others) - of("everyone", everything)).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        shapley.alias("shapley"),
    )

"""Mixing sources to target weights by balanced (cube) sampling.

Every document gets ``ratio = target / size`` of its source in copies: the whole part for sure,
the fraction by chance. The chances are moved through the null space of two constraints, the
number of documents and the number of words (flight phase), until all but a few per block are 0
or 1. The undecided documents of all blocks of a source meet in new blocks, and so on, until one
block per source is left, whose last few are settled by rounding (landing).
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sortlane.llm.arrays import WORD
from sortlane.llm.tables import NULL_ID, stored

# The weights of the sources in their order, repeating; most copies of a text.
WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3.0
# Documents per block of the flight phase.
BLOCK = 2000
# One row for each source is collected and broadcast; more sources than this are refused.
MOST_SOURCES = 100_000

UNITS = "source string, doc_id long, key long, size long, copies int, chance double"


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, most: float = MOST_COPIES) -> dict:
    """Words wanted of each source: shares by weight of all words, at most ``most`` times its own.

    What is above a source's limit goes to the others by weight, until none is above.
    """
    ordered = sorted(sizes, key=lambda s: (s[0] is None, [ord(c) for c in s[0] or ""]))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(ordered)}
    limit = {s: most * n for s, n in ordered}
    left, out, free = float(sum(n for _, n in ordered)), {}, [s for s, _ in ordered]
    while free:
        total = sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / total > limit[s]]
        if not above:
            return out | {s: left * weight[s] / total for s in free}
        for s in above:
            out[s] = limit[s]
        left -= sum(limit[s] for s in above)
        free = [s for s in free if s not in out]
    return out


def flight(chance: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """Chances moved so that at most two stay fractional; sum and size-weighted sum are kept.

    Three fractional documents at a time: a vector u with sum(u) = 0 and sum(u * size) = 0 is
    followed one way or the other until a chance reaches 0 or 1; that document is replaced by
    the next. The way is drawn so that the expected chances stay as they are.
    """
    p, size = chance.tolist(), size.tolist()
    waiting = [i for i in range(len(p)) if 0.0 < p[i] < 1.0]
    draws = np.random.default_rng(seed % (1 << 63)).random(len(waiting) + 1).tolist()
    waiting.reverse()
    active: list[int] = []
    while True:
        while len(active) < 3 and waiting:
            active.append(waiting.pop())
        if len(active) < 3:
            return np.array(p)
        a, b, c = active
        u = (size[b] - size[c], size[c] - size[a], size[a] - size[b])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        ways = [(i, v) for i, v in zip(active, u) if v]
        up = min((1 - p[i]) / v if v > 0 else p[i] / -v for i, v in ways)
        down = min(p[i] / v if v > 0 else (1 - p[i]) / -v for i, v in ways)
        step = up if draws.pop() * (up + down) < down else -down
        for i, v in ways:
            p[i] += step * v
        # The one that met its bound; what rounding left over is settled with it.
        near = min((i for i, _ in ways), key=lambda i: min(p[i], 1 - p[i]))
        p[near] = 0.0 if p[near] < 0.5 else 1.0
        for i in active:
            if p[i] < 1e-9 or p[i] > 1 - 1e-9:
                p[i] = 0.0 if p[i] < 0.5 else 1.0
        active = [i for i in active if 0.0 < p[i] < 1.0]


def land(chance: np.ndarray, size: np.ndarray, wanted: float) -> np.ndarray:
    """Settles the last two or fewer: the documents' total is given up, the words' total is met.

    The open ones are rounded so that the words come nearest to ``wanted``; then single
    documents of the block are put in or out for as long as that brings the words nearer.
    """
    p = chance.copy()
    open_ = [i for i in range(len(p)) if 0.0 < p[i] < 1.0]
    p[open_] = 0.0
    left = wanted - float(p @ size)
    choices = range(1 << len(open_))
    sums = [sum(size[i] for k, i in enumerate(open_) if bits >> k & 1) for bits in choices]
    best = min(choices, key=lambda bits: (abs(left - sums[bits]), bits))
    for k, i in enumerate(open_):
        p[i] = float(best >> k & 1)
    left -= sums[best]
    for _ in range(len(p)):
        change = (1 - 2 * p) * size
        i = int(np.argmin(np.abs(left - change)))
        if abs(left - change[i]) >= abs(left):
            break
        p[i], left = 1 - p[i], left - change[i]
    return p


def _flown(last: bool):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.drop(columns="block")
        key = block["key"].to_numpy()
        order = np.lexsort((block["doc_id"].to_numpy(), key, -block["size"].to_numpy()))
        p, size = block["chance"].to_numpy(float)[order], block["size"].to_numpy(float)[order]
        wanted = float(p @ size)
        p = flight(p, size, int(np.bitwise_xor.reduce(key)))
        if last:
            p = land(p, size, wanted)
        out = np.empty(len(p))
        out[order] = p
        return block.assign(chance=out)

    return run


def _blocks(units: DataFrame, counts: DataFrame, level: int) -> DataFrame:
    """Blocks of about BLOCK documents; the number of a source's blocks follows from its count."""
    salt = F.xxhash64("doc_id", "key", "size", F.lit(level))
    of = F.pmod(salt, F.ceil(F.col("n") / BLOCK).cast("long"))
    joined = units.alias("u").join(F.broadcast(counts).alias("c"), F.col("u.source").eqNullSafe(F.col("c.source")))
    return joined.select("u.*", of.alias("block"))


def mix(documents: DataFrame, weights: Iterable[float] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """(source, doc_id, key, size, source_size, target, copies) of every row of ``documents``.

    ``size`` is the number of words of the text, ``key`` a hash of the text. A null text has no
    words; a null source is a source of its own and comes last; equal rows are drawn one by one;
    rows without words are never taken; an empty table gives an empty result. Equal tables give
    equal results. Of the sources only one row each (name, words) reaches the driver.
    """
    spark = documents.sparkSession
    units = documents.select(
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
        F.xxhash64("text").alias("key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    units = stored(units, "mixing-sizes")
    totals = units.groupBy("source").agg(F.sum("size").alias("size")).limit(MOST_SOURCES + 1).collect()
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    wanted = targets([(r["source"], r["size"]) for r in totals], tuple(weights), most)
    shares = spark.createDataFrame(
        [(r["source"], r["size"], float(wanted[r["source"]]), wanted[r["source"]] / r["size"] if r["size"] else 0.0) for r in totals],
        "source string, source_size long, target double, ratio double",
    )
    near = F.when(F.abs(F.col("ratio") - F.round("ratio")) < 1e-12, F.round("ratio")).otherwise(F.col("ratio"))
    rows = units.alias("u").join(F.broadcast(shares).alias("s"), F.col("u.source").eqNullSafe(F.col("s.source")))
    rows = rows.select("u.source", "doc_id", "key", "size", F.floor(near).cast("int").alias("copies"), (near - F.floor(near)).alias("chance"))
    fraction = (F.col("chance") > 0) & (F.col("chance") < 1) & (F.col("size") > 0)
    settled = [rows.filter(~fraction).withColumn("chance", F.lit(0.0))]
    open_, level = rows.filter(fraction), 0
    while True:
        counts = open_.groupBy("source").agg(F.count("*").alias("n")).collect()
        largest = max((r["n"] for r in counts), default=0)
        if not largest:
            break
        sizes = spark.createDataFrame([(r["source"], r["n"]) for r in counts], "source string, n long")
        last = largest <= BLOCK
        flown = _blocks(open_, sizes, level).groupBy("source", "block").applyInPandas(_flown(last), UNITS)
        flown = stored(flown, f"mixing-level-{level}")
        settled.append(flown.filter((F.col("chance") <= 0) | (F.col("chance") >= 1)))
        if last:
            break
        open_, level = flown.filter((F.col("chance") > 0) & (F.col("chance") < 1)), level + 1
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    out = out.select("source", "doc_id", "key", "size", (F.col("copies") + F.col("chance").cast("int")).alias("copies"))
    joined = out.alias("o").join(F.broadcast(shares).alias("s"), F.col("o.source").eqNullSafe(F.col("s.source")))
    return joined.select("o.*", "source_size", "target").withColumn("doc_id", F.nullif("doc_id", F.lit(NULL_ID)))


def mixed_documents(documents: DataFrame, weights: Iterable[float] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """The rows of ``documents``, each as often as the mix takes it; its columns are kept."""
    def keys(key):
        of_source = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("none")).alias("_source")
        return [of_source, F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("_doc"), key.alias("_key")]

    drawn = mix(documents, weights, most).filter("copies > 0").select(*keys(F.col("key")), "copies")
    drawn = drawn.groupBy("_source", "_doc", "_key").agg(F.sum("copies").alias("_copies"))
    rows = documents.select(F.struct("*").alias("_row"), *keys(F.xxhash64("text")))
    taken = rows.join(drawn, ["_source", "_doc", "_key"])
    # Equal rows share their copies: the first stands for all.
    first = Window.partitionBy("_source", "_doc", "_key").orderBy(F.lit(1))
    once = taken.withColumn("_first", F.row_number().over(first)).filter("_first = 1")
    return once.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("_row.*")

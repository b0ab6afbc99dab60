"""All heads with all their evaluations fitted together, as squared-hinge SVMs.

A head needs a fit for each fold, one for its gate and the final one, each over three calibration
splits and all classes. Here all of them share one stored table of term counts: a pass over the
terms gives the vocabularies of every fit, one set of tasks solves all columns (``svm``), one
table of margins gives every sigmoid and all out-of-fold predictions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sortlane.operators import svm
from sortlane.operators.splits import fold_of, held_out
from sortlane.operators.tfidf import most_frequent
from sortlane.plans.workspace import materialise
from sortlane.rules import labels as fixed

# Classes with fewer groups are dealt over the calibration splits one group at a time.
THIN_CLASS = 300
SIGMOID_STEPS = 60
# Rows whose terms are counted at once.
COUNTED = 5000


@dataclass
class JointFit:
    """``predictions``: (head, kind, row_id, fold, y, p, conf) of rows outside of their fit."""

    fits: list[svm.Fit]
    fitted: svm.Fitted
    classes: list[list[str]]
    terms: list[str]
    idf: np.ndarray
    dimensions: int
    sigmoids: dict[int, list]
    predictions: DataFrame
    sizes: dict[tuple[int, str], int]


def _targets(df: DataFrame, labels: list[str], floors: list[int]) -> list[list[str]]:
    """Learnable classes of every head, in order."""
    pairs = F.array(*[F.struct(F.lit(h).alias("head"), F.col(c).cast("string").alias("y")) for h, c in enumerate(labels)])
    counts = df.select(F.inline(pairs)).filter("y IS NOT NULL").groupBy("head", "y").agg(F.count("*").alias("n"))
    found: list[list[str]] = [[] for _ in labels]
    for r in counts.filter(F.col("n") >= F.get(F.array(*[F.lit(f) for f in floors]), F.col("head"))).collect():
        found[r["head"]].append(r["y"])
    return [sorted(c) for c in found]


def _dealt_groups(rows: DataFrame, splits: int) -> DataFrame:
    """Add ``split``: the calibration split of the row's group, for each head.

    A hash decides, but the groups of thin classes are dealt out in turn.
    """
    spark = rows.sparkSession
    by_hash = F.pmod(F.xxhash64("group"), F.lit(splits)).cast("int")
    each = rows.select("group", F.posexplode("y").alias("head", "c")).filter("c >= 0").distinct()
    thin = each.groupBy("head", "c").agg(F.count("*").alias("n")).filter(F.col("n") < THIN_CLASS)
    # At most THIN_CLASS groups for each class of each head.
    listed = each.join(F.broadcast(thin.select("head", "c")), ["head", "c"]).groupBy("head", "group").agg(F.min("c").alias("c"))
    turns: dict[tuple[int, int], int] = {}
    dealt = []
    for r in sorted(listed.collect(), key=lambda r: (r["head"], r["c"], r["group"])):
        turn = turns.get((r["head"], r["c"]), 0)
        turns[r["head"], r["c"]] = turn + 1
        dealt.append((r["group"], r["head"], turn % splits))
    hashed = F.transform("y", lambda _: by_hash)
    if not dealt:
        return rows.withColumn("split", hashed)
    kind = f"group {rows.schema['group'].dataType.simpleString()}, head int, turn int"
    lookup = spark.createDataFrame(dealt, kind).groupBy("group").agg(F.map_from_entries(F.collect_list(F.struct("head", "turn"))).alias("_turns"))
    joined = rows.join(F.broadcast(lookup), "group", "left")
    own = F.transform(hashed, lambda s, h: F.coalesce(F.try_element_at("_turns", h), s))
    return joined.withColumn("split", own).drop("_turns")


def _counted_cells(rows: DataFrame) -> DataFrame:
    """Corpus and document count of every term by cell, (term, mask, fold, held_out, cf, df)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, COUNTED) for b in batches for i in range(0, b.num_rows, COUNTED)):
            lists = batch.column("terms")
            each = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
            facts = np.stack([np.asarray(batch.column(c).cast(pa.int32())) for c in ("mask", "fold", "held_out")])
            cells, cell = np.unique(facts, axis=1, return_inverse=True)
            words = lists.flatten().dictionary_encode()
            size = max(len(words.dictionary), 1)
            # Terms of a row, then those of a cell: once each, with how often they came.
            term = np.asarray(words.indices, dtype=np.int64)
            pair, n = np.unique(np.repeat(np.arange(batch.num_rows), each) * size + term, return_counts=True)
            found, at, df = np.unique(cell.ravel()[pair // size] * size + pair % size, return_inverse=True, return_counts=True)
            cf = np.bincount(at.ravel(), n, len(found)).astype(np.int64)
            own = cells[:, found // size].astype(np.int32)
            columns = [words.dictionary.take(pa.array(found % size)), pa.array(own[0]), pa.array(own[1]), pa.array(own[2] > 0), pa.array(cf), pa.array(df)]
            yield pa.RecordBatch.from_arrays(columns, names=["term", "mask", "fold", "held_out", "cf", "df"])

    kind = "term string, mask int, fold int, held_out boolean, cf long, df long"
    return rows.select("terms", "mask", "fold", "held_out").mapInArrow(run, kind)


def _included(fits: list[svm.Fit], mask: np.ndarray, fold: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Whether the rows of cells are in the training parts of fits, (cells, fits)."""
    return np.stack([(mask >> f.head & 1 > 0) & svm.trained_on(f, fold, held) for f in fits], axis=1)


def _by_fit(by_term: DataFrame, fits: list[svm.Fit], min_df: int) -> DataFrame:
    """What each fit may see of a term, the sum over its cells: (fit, term, cf, df)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("cells")
            flat = lists.flatten()
            mask, fold, held, cf, df = (np.asarray(flat.field(c).cast(pa.int64())) for c in ("mask", "fold", "held_out", "cf", "df"))
            cells, cell = np.unique(np.stack([mask, fold, held]), axis=1, return_inverse=True)
            inside = _included(fits, cells[0], cells[1], cells[2] > 0).astype(np.float64)
            n, k = batch.num_rows, cells.shape[1]
            at = np.repeat(np.arange(n), np.asarray(lists.value_lengths())) * k + cell.ravel()
            # Whole numbers far below 2^53, so the sums are exact.
            all_cf, all_df = (np.bincount(at, x, n * k).reshape(n, k) @ inside for x in (cf, df))
            row, fit = np.nonzero(all_df >= min_df)
            values = [pa.array(fit, pa.int32()), batch.column("term").take(pa.array(row))]
            values += [pa.array(x[row, fit].astype(np.int64)) for x in (all_cf, all_df)]
            yield pa.RecordBatch.from_arrays(values, names=["fit", "term", "cf", "df"])

    return by_term.select("term", "cells").mapInArrow(run, "fit int, term string, cf long, df long")


def vocabularies(rows: DataFrame, fits: list[svm.Fit], sizes: list[int], min_df: int, max_features: int) -> tuple[list[str], np.ndarray]:
    """Terms that any fit knows and their idf, (terms, fits), 0 where a fit doesn't know one.

    The corpus is counted once, by term and cell; a cell is a set of heads, a fold and a side of
    the gate. What a fit may see is the sum over its cells.
    """
    bits = F.transform("y", lambda c, h: F.when(c >= 0, F.pow(F.lit(2), h).cast("int")).otherwise(0))
    mask = F.aggregate(bits, F.lit(0), lambda a, x: a + x)
    # Dealt by term once, for both sums.
    counts = _counted_cells(rows.withColumn("mask", mask)).repartition("term").groupBy("term", "mask", "fold", "held_out").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))
    cells = F.collect_list(F.struct("mask", "fold", "held_out", "cf", "df")).alias("cells")
    # At most one entry for each cell that has rows.
    by_term = counts.groupBy("term").agg(cells, F.sum("df").alias("all_df")).filter(F.col("all_df") >= min_df)
    statistics = _by_fit(by_term, fits, min_df)
    kept = most_frequent(materialise(statistics, "fit-terms"), max_features, ["fit"])
    documents = F.get(F.array(*[F.lit(n) for n in sizes]), F.col("fit"))
    weights = kept.select("term", "fit", (F.log((1 + documents) / (1 + F.col("df"))) + 1).alias("idf"))
    # At most max_features rows for each fit.
    table = weights.groupBy("term").agg(F.collect_list("fit").alias("fits"), F.collect_list("idf").alias("idf")).toArrow().sort_by("term")
    terms = table.column("term").to_pylist()
    idf = np.zeros((len(terms), len(fits)))
    if terms:
        lists = table.column("fits").combine_chunks()
        at = np.repeat(np.arange(len(terms)), np.asarray(lists.value_lengths()))
        idf[at, np.asarray(lists.flatten())] = np.asarray(table.column("idf").combine_chunks().flatten())
    return terms, idf


def counted(rows: DataFrame, terms: list[str]) -> DataFrame:
    """Add ``idx`` and ``tf``, a row's known terms and their damped counts, for ``terms``."""
    listed = rows.sparkSession.sparkContext.broadcast(pa.array(terms, pa.string()))
    names = [c for c in rows.columns if c != "terms"]
    schema = rows.select(*names).schema.add("idx", T.ArrayType(T.IntegerType())).add("tf", T.ArrayType(T.FloatType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = listed.value
        for batch in batches:
            lists = batch.column("terms")
            at = pc.index_in(lists.flatten(), known)
            row = np.repeat(np.arange(batch.num_rows), np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))
            valid = np.asarray(at.is_valid())
            key = row[valid] * len(known) + np.asarray(at.drop_null(), dtype=np.int64)
            key, n = np.unique(key, return_counts=True)
            offsets = pa.array(np.searchsorted(key, np.arange(batch.num_rows + 1) * len(known)), pa.int32())
            idx = pa.ListArray.from_arrays(offsets, pa.array(key % max(len(known), 1), pa.int32()))
            tf = pa.ListArray.from_arrays(offsets, pa.array(1 + np.log(n), pa.float32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), idx, tf], names=[*names, "idx", "tf"])

    return rows.select(*names, "terms").mapInArrow(run, schema)


def _training_cells(cells: list, fit: svm.Fit) -> np.ndarray:
    """Rows of a fit's training part by (split, class)."""
    out = np.zeros((fixed.CALIBRATION_FOLDS, fit.classes), dtype=np.int64)
    for r in cells:
        if r["head"] == fit.head and bool(svm.trained_on(fit, np.array(r["fold"]), np.array(r["held_out"]))):
            out[r["split"], r["c"]] += r["n"]
    return out


def _costs(counts: np.ndarray, c: float) -> tuple[np.ndarray, np.ndarray]:
    """Costs of a class's own and of other rows: balanced weights over what a split trains on."""
    used = counts.sum(axis=0) - counts
    n, k = used.sum(axis=1, keepdims=True), (used > 0).sum(axis=1, keepdims=True)
    own = np.where(used > 0, c * n / np.maximum(k * used, 1), 0)
    others = own[:, ::-1] if counts.shape[1] == 2 else np.full(own.shape, c)
    return own, others


def _sigmoids(margins: DataFrame, fits: list[svm.Fit], counts: dict[int, np.ndarray]) -> dict[int, list]:
    """(slope, offset) for each split and class of every fit, or the class's share where one can't be fitted.

    Newton steps for all columns at once over one table of held-out margins, with smoothed
    targets; a step that doesn't lower a column's loss is halved.
    """
    splits = fixed.CALIBRATION_FOLDS
    first = np.cumsum([0] + [splits * f.classes for f in fits])
    total = int(first[-1])
    hits, misses, share = np.zeros(total), np.zeros(total), np.zeros(total)
    usable = np.zeros(total, dtype=bool)
    for f in fits:
        n = counts[f.number]
        used = n.sum(axis=0) - n
        at = slice(first[f.number], first[f.number + 1])
        hits[at], misses[at] = n.ravel(), (n.sum(axis=1, keepdims=True) - n).ravel()
        share[at] = np.tile(n.sum(axis=0) / max(n.sum(), 1), splits)
        rest = (used.sum(axis=1, keepdims=True) - used).ravel()
        usable[at] = (hits[at] > 0) & (misses[at] > 0) & (used.ravel() > 0) & (rest > 0)
    starts = F.array(*[F.lit(int(x)) for x in first])
    width = F.array(*[F.lit(f.classes) for f in fits])
    own = F.slice("m", F.col("split") * F.get(width, F.col("fit")) + 1, F.get(width, F.col("fit")))
    column = F.get(starts, F.col("fit")) + F.col("split") * F.get(width, F.col("fit"))
    held = margins.filter("train").select(column.alias("_at"), "y", F.posexplode(own).alias("c", "x"))
    long = materialise(held.select((F.col("_at") + F.col("c")).alias("column"), "x", (F.col("y") == F.col("c")).alias("hit")), "held-out-margins")
    high, low = (hits + 1) / (hits + 2), 1 / (misses + 2)
    best = np.stack([np.zeros(total), np.log((hits + 1) / (misses + 1))], axis=1)
    trial, least, step = best.copy(), np.full(total, np.inf), np.zeros((total, 2))
    for _ in range(SIGMOID_STEPS):
        values = [(j, *map(float, v)) for j, v in enumerate(zip(trial[:, 0], trial[:, 1], high, low))]
        # A row for each column of each fit.
        params = long.sparkSession.createDataFrame(values, "column int, a double, b double, high double, low double")
        z = F.col("a") * F.col("x") + F.col("b")
        target = F.when(F.col("hit"), F.col("high")).otherwise(F.col("low"))
        put = long.join(F.broadcast(params), "column").select("column", "x", z.alias("z"), target.alias("t"))
        p = 1 / (1 + F.exp(-F.col("z")))
        loss = F.greatest("z", F.lit(0.0)) - F.col("t") * F.col("z") + F.log1p(F.exp(-F.abs("z")))
        d, h = (p - F.col("t")), p * (1 - p)
        sums = put.groupBy("column").agg(
            F.sum(loss).alias("f"), F.sum(d * F.col("x")).alias("ga"), F.sum(d).alias("gb"),
            F.sum(h * F.col("x") * F.col("x")).alias("haa"), F.sum(h * F.col("x")).alias("hab"), F.sum(h).alias("hbb"),
        ).collect()
        moved = 0.0
        for r in sums:
            j = r["column"]
            if r["f"] <= least[j] + 1e-10:
                gain = least[j] - r["f"]
                least[j], best[j] = r["f"], trial[j]
                haa, hbb, hab = r["haa"] + 1e-9, r["hbb"] + 1e-9, r["hab"]
                det = haa * hbb - hab * hab
                if gain < 1e-7 * max(1.0, r["f"]) or det <= 0:
                    step[j] = 0
                else:
                    step[j] = [-(hbb * r["ga"] - hab * r["gb"]) / det, -(haa * r["gb"] - hab * r["ga"]) / det]
            else:
                step[j] /= 2
            trial[j] = best[j] + step[j]
            if usable[j]:
                moved = max(moved, float(np.abs(step[j]).max()))
        if moved < 1e-6:
            break
    found = {}
    for f in fits:
        at = range(first[f.number], first[f.number + 1])
        found[f.number] = [(float(best[j, 0]), float(best[j, 1])) if usable[j] else float(share[j]) for j in at]
    return found


def shares(scores: Column, classes: Column) -> Column:
    """Sigmoids of one split scaled to sum up to one."""
    whole = F.aggregate(scores, F.lit(0.0), lambda a, x: a + x)
    return F.transform(scores, lambda x: F.when(whole > 0, x / whole).otherwise(1.0 / classes))


def _predictions(margins: DataFrame, fits: list[svm.Fit], classes: list[list[str]], sigmoids: dict[int, list]) -> DataFrame:
    """Best class and confidence of rows outside of their fit's training part."""
    splits = fixed.CALIBRATION_FOLDS
    lists = [(
        f.number, f.head, f.kind, classes[f.head],
        [s[0] if isinstance(s, tuple) else 0.0 for s in sigmoids[f.number]],
        [s[1] if isinstance(s, tuple) else 0.0 for s in sigmoids[f.number]],
        [None if isinstance(s, tuple) else s for s in sigmoids[f.number]],
    ) for f in fits if f.kind != "final"]
    kind = "fit int, head int, kind string, names array<string>, slopes array<double>, offsets array<double>, constant array<double>"
    known = F.broadcast(margins.sparkSession.createDataFrame(lists, kind))
    rows = margins.filter("NOT train").join(known, "fit")
    scores = F.transform("m", lambda x, i: F.coalesce(F.get("constant", i), 1 / (1 + F.exp(-(F.get("slopes", i) * x + F.get("offsets", i))))))
    rows = rows.withColumns({"_scores": scores, "_k": F.size("names")})
    for s in range(splits):
        rows = rows.withColumn(f"_s{s}", F.slice("_scores", F.col("_k") * s + 1, F.col("_k")))
        rows = rows.withColumn(f"_p{s}", shares(F.col(f"_s{s}"), F.col("_k")))
    mean = F.transform("_p0", lambda x, i: (x + sum(F.get(f"_p{s}", i) for s in range(1, splits))) / splits)
    rows = rows.withColumn("_mean", mean).withColumn("conf", F.array_max("_mean"))
    top = F.array_position("_mean", F.col("conf")).cast("int") - 1
    return rows.select("head", "kind", "row_id", "fold", F.get("names", F.col("y")).alias("y"), F.get("names", top).alias("p"), "conf")


def fit_jointly(
    df: DataFrame, specs: list, only_final: bool = False, vocab: list | None = None, classes: list[list[str]] | None = None, final: bool = True
) -> JointFit | None:
    """Fits of all heads in ``specs``; with ``only_final`` without folds and gates, without ``final`` only those.

    ``df`` holds ``row_id``, ``group``, the labels, ``terms`` and possibly ``embedding``; ``fold``
    and ``held_out`` are added where they are missing. ``vocab`` are (term, idf) rows to use
    instead of fitting vocabularies, ``classes`` the classes of each head. Heads with fewer than two learnable classes have no fit.
    """
    first = specs[0]
    if classes is None:
        classes = _targets(df, [s.label for s in specs], [s.floor for s in specs])
    keep = [h for h, c in enumerate(classes) if len(c) > 1]
    if not keep:
        return None
    index = [
        F.coalesce(F.array_position(F.array(*[F.lit(c) for c in classes[h]]), F.col(s.label).cast("string")).cast("int") - 1, F.lit(-1)) if h in keep else F.lit(-1)
        for h, s in enumerate(specs)
    ]
    vector = F.col("embedding").cast("array<float>") if "embedding" in df.columns else F.array().cast("array<float>")
    rows = df.select(
        "row_id", "group", "terms", vector.alias("emb"), F.array(*index).alias("y"),
        (F.col("fold") if "fold" in df.columns else fold_of(F.col("group"), first.folds)).alias("fold"),
        (F.col("held_out") if "held_out" in df.columns else held_out(F.col("group"))).alias("held_out"),
    ).filter(F.array_max("y") >= 0)
    rows = materialise(rows, "joint-rows")
    rows = _dealt_groups(rows, fixed.CALIBRATION_FOLDS)
    each = F.posexplode(F.arrays_zip("y", "split")).alias("head", "_v")
    labelled = rows.select("fold", "held_out", each).select("fold", "held_out", "head", F.col("_v.y").alias("c"), F.col("_v.split").alias("split"))
    cells = labelled.filter("c >= 0").groupBy("head", "fold", "held_out", "c", "split").agg(F.count("*").alias("n")).collect()
    fits: list[svm.Fit] = []
    for h in keep:
        mine = [r for r in cells if r["head"] == h]
        k = len(classes[h])
        if not only_final:
            for f in sorted({r["fold"] for r in mine}):
                fits.append(svm.Fit(len(fits), h, "fold", f, k))
            held = sum(r["n"] for r in mine if r["held_out"])
            left = {r["c"] for r in mine if not r["held_out"]}
            if specs[h].separate_gate and held >= fixed.MIN_CALIBRATION_ROWS and len(left) == k:
                fits.append(svm.Fit(len(fits), h, "gate", -1, k))
        if final:
            fits.append(svm.Fit(len(fits), h, "final", -1, k))
    counts = {f.number: _training_cells(cells, f) for f in fits}
    sizes = [int(counts[f.number].sum()) for f in fits]
    if vocab is None:
        terms, idf = vocabularies(rows, fits, sizes, first.min_df, first.max_features)
    else:
        terms = [r["term"] for r in vocab]
        idf = np.tile(np.array([r["idf"] for r in vocab], dtype=np.float64)[:, None], (1, len(fits))) if terms else np.zeros((0, len(fits)))
    ready = materialise(counted(rows.drop("group"), terms), "joint-counts")
    dimensions = ready.agg(F.max(F.size("emb"))).first()[0]
    if not terms and not dimensions:
        raise ValueError("no features: no term reaches the minimum and there is no embedding")
    costs = {f.number: _costs(counts[f.number], first.svm_c) for f in fits}
    fitted = svm.fit_all(ready, fits, idf, costs, dimensions)
    sigmoids = _sigmoids(fitted.margins, fits, counts)
    predictions = _predictions(fitted.margins, fits, classes, sigmoids)
    return JointFit(fits, fitted, classes, terms, idf, dimensions, sigmoids, predictions, {(f.head, f.kind): n for f, n in zip(fits, sizes)})

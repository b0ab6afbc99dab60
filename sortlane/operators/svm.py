"""Squared-hinge linear SVMs, many fits at once, by dual coordinate ascent in blocks of rows.

A *fit* is one training part of one head (a fold's rest, the gate's rest, all rows), with a
column for each calibration split and class. Fits are dealt into *parties* and rows into blocks; a
task takes one block for one party and ascends the columns of all its fits together, since a step of
many columns costs little more than a step of few. It makes several passes over its own rows before
anything is exchanged. What is exchanged are changes of the coefficients, cut by ranges of
terms and added up by range. With k blocks of a fit at the same time a block answers for k times
its own change, which makes adding up all changes safe but slow to converge. So a fit's blocks
take turns, and a turn starts from what the turn before left. Rounds of turns go on until the duality gap of every column is small. A block holds a fixed
number of bytes, so a small table is one block and one round.

Rows travel as pieces, a few bytes a term; fits differ by their weights of terms only, so the pieces
hold counts and a block multiplies. Coefficients are moved as products with those weights.

Coefficients, dual variables and margins are tables; nothing here passes through the driver but
one number for each column, and a lost executor repeats its own blocks only.

The objective of a column is 1/2 |w|^2 + sum over rows of C_i max(0, 1 - y_i w.x_i)^2, the
constant being a feature like the others. Its dual is sum(a) - 1/2 |w|^2 - sum(a^2 / (4 C_i))
with w = sum(a_i y_i x_i) and a >= 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sortlane.plans.workspace import materialise

# Bytes of terms and vectors in a block of rows, eight a term; as pieces they are three to eight.
BLOCK_BYTES = 512 << 20
# Passes over a block before it is compared with the others, and between two looks at the gap.
LOCAL_PASSES = 10
CHECK_PASSES = 3
# Passes without a look at all margins at most, unless the gap seems to be within so many times what is allowed.
MOST_UNSEEN = 12
WORTH = 3
MOST_PASSES = 400
MOST_ROUNDS = 60
TOLERANCE = 1e-3
MOST_TASKS = 20_000
# A fit's blocks take so many turns or more, one block a turn where it has fewer; and about so many blocks
# are solved at the same time where all fits together have more.
LEAST_TURNS = 8
AT_ONCE = 96
# Features whose coefficients travel together.
CHUNK = 4096
# Rows whose costs are worked out, or whose margins are stored, at once.
STRIP = 512
SLICE = 8192
# Entries of rows that are numbered anew at once.
STRETCH = 1 << 20
# Parties at least, where there are as many fits, and most for which tasks are placed one by one.
PARTIES = 8
MOST_PLACED = 1024

STATE = "fit int, block int, kind string, chunk int, ids binary, payload binary"
PIECE = "block int, rows binary, idx binary, tf binary"


@dataclass(frozen=True)
class Fit:
    """One training part of one head. ``kind`` is "fold", "gate" or "final"."""

    number: int
    head: int
    kind: str
    fold: int
    classes: int


@dataclass
class Fitted:
    """``margins``: (fit, row_id, fold, y, train, split, m); ``state``: coefficients by range."""

    margins: DataFrame
    state: DataFrame
    rounds: int
    passes: int
    gap: dict[int, np.ndarray] = field(default_factory=dict)
    objective: dict[int, np.ndarray] = field(default_factory=dict)


def trained_on(fit: Fit, fold, held):
    """Whether rows belong to the training part; works on columns and on arrays."""
    if fit.kind == "fold":
        return fold != fit.fold
    if fit.kind == "gate":
        return ~held
    return fold == fold


class Block:
    """Rows of one or several fits over the features that occur: unit TF-IDF, vector, constant.

    Terms and damped counts are held once for all fits; a fit has its ``idf`` and, for each row, the
    inverse length of its weighted terms. ``owner`` says which fit a column of coefficients belongs to.
    """

    def __init__(self, table: pa.Table, idf: np.ndarray, dimensions: int, owner: np.ndarray | None = None):
        lists, counts = table.column("idx").combine_chunks(), table.column("tf").combine_chunks()
        sizes = np.asarray(lists.value_lengths(), dtype=np.int64)
        vectors = np.asarray(table.column("emb").combine_chunks().flatten()) if dimensions else None
        levels, code = np.unique(np.asarray(counts.flatten()), return_inverse=True)
        self._set(sizes, np.asarray(lists.flatten()), levels, code, vectors, idf, dimensions, owner, np.arange(len(sizes)))

    @classmethod
    def of(cls, sizes, terms, levels, code, vectors, idf, dimensions, owner, order) -> Block:
        """A block from arrays: sizes of rows, their terms, and their counts as ``levels[code]``."""
        block = cls.__new__(cls)
        block._set(sizes, terms, levels, code, vectors, idf, dimensions, owner, order)
        return block

    def _set(self, sizes, terms, levels, code, vectors, idf, dimensions, owner, order) -> None:
        idf = idf.reshape(len(idf), -1)
        n, self.owner, self.order = len(sizes), owner, order
        self.start = np.concatenate([[0], np.cumsum(sizes)])
        # A stretch of entries at a time, since numbers that index take eight bytes each.
        count, stretches = np.zeros(len(idf), dtype=np.int64), [slice(i, i + STRETCH) for i in range(0, len(terms), STRETCH)]
        for at in stretches:
            count += np.bincount(terms[at], minlength=len(idf))
        seen = (count > 0) & (idf > 0).any(axis=1)
        # Frequent terms lie together, since their coefficients are met most.
        met = np.flatnonzero(seen)
        met = met[np.argsort(-count[met], kind="stable")]
        places = np.zeros(len(idf), dtype=np.uint16 if len(idf) <= 1 << 16 else np.int32)
        places[met] = np.arange(len(met))
        known, self.term = np.empty(len(terms), dtype=bool), np.empty(len(terms), dtype=places.dtype)
        for at in stretches:
            known[at], self.term[at] = seen[terms[at]], places[terms[at]]
        if not known.all():
            lost = np.add.reduceat(np.append(~known, False), self.start[:-1], dtype=np.int64) if len(sizes) else sizes
            self.start = np.concatenate([[0], np.cumsum(sizes - np.where(sizes > 0, lost, 0))])
            self.term, code = self.term[known], code[known]
        self.levels, self.code = levels.astype(np.float64), code.astype(np.uint8 if len(levels) <= 256 else np.int32)
        self.single = self.levels.astype(np.float32)
        self.terms, self.dimensions = len(met), dimensions
        self.features = np.concatenate([met, len(idf) + np.arange(dimensions + 1)])
        self.idf = np.ascontiguousarray(idf[met])
        self.vectors = np.asarray(vectors, dtype=np.float32).reshape(n, dimensions) if dimensions else None
        squares, length = self.idf**2, np.zeros((n, idf.shape[1]))
        for i, (a, b) in enumerate(self._ends()):
            length[i] = self.levels[self.code[a:b]] ** 2 @ squares.take(self.term[a:b], axis=0)
        some = length > 0
        self.scale = np.where(some, 1 / np.sqrt(np.where(some, length, 1)), 0)
        self.square = some + 1.0
        if dimensions:
            self.square += (self.vectors.astype(np.float64) ** 2).sum(axis=1, keepdims=True)

    def __len__(self) -> int:
        return len(self.start) - 1

    def _ends(self):
        ends = self.start.tolist()
        return zip(ends, ends[1:])

    def owners(self, columns: int) -> np.ndarray:
        return np.zeros(columns, dtype=np.int64) if self.owner is None else self.owner

    def weighted(self, w: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The terms' coefficients times their weights."""
        return np.ascontiguousarray(w[: self.terms] * self.idf.take(owner, axis=1))

    def margins(self, u: np.ndarray, dense: np.ndarray, owner: np.ndarray, first: int, last: int) -> np.ndarray:
        """Margins of a slice of rows from ``weighted`` coefficients and those of vector and constant."""
        out = np.zeros((last - first, u.shape[1]), dtype=u.dtype)
        levels = self.levels.astype(u.dtype)
        ends = self.start[first : last + 1].tolist()
        for i, (a, b) in enumerate(zip(ends, ends[1:])):
            if b > a:
                np.dot(levels[self.code[a:b]], u.take(self.term[a:b], axis=0), out=out[i])
        out *= self.scale[first:last].take(owner, axis=1).astype(u.dtype)
        if self.dimensions:
            out += self.vectors[first:last].astype(u.dtype) @ dense[:-1]
        return out + dense[-1]

    def slices(self) -> Iterator[tuple[int, int]]:
        for first in range(0, len(self), SLICE):
            yield first, min(first + SLICE, len(self))

    def forward(self, w: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """Margins of all rows by slices: first, last, (rows, columns)."""
        owner = self.owners(w.shape[1])
        u, dense = self.weighted(w, owner), w[self.terms :]
        for first, last in self.slices():
            yield first, last, self.margins(u, dense, owner, first, last)

    def backward(self, columns: int, factors) -> np.ndarray:
        """Sum over the rows of each row times its factors, (features, columns); ``factors`` of (first, last)."""
        out, owner = np.zeros((len(self.features), columns)), self.owners(columns)
        sums, dense = out[: self.terms], out[self.terms :]
        for first, last in self.slices():
            part = factors(first, last)
            scaled = part * self.scale[first:last].take(owner, axis=1)
            ends = self.start[first : last + 1].tolist()
            for i in np.flatnonzero(part.any(axis=1)).tolist():
                at = slice(ends[i], ends[i + 1])
                term = self.term[at]
                own = sums.take(term, axis=0)
                own += np.multiply.outer(self.levels[self.code[at]], scaled[i])
                sums[term] = own
            dense[-1] += part.sum(axis=0)
            if self.dimensions:
                dense[:-1] += self.vectors[first:last].astype(np.float64).T @ part
        sums *= self.idf.take(owner, axis=1)
        return out


def problem(y: np.ndarray, train: np.ndarray, split: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signs and costs of every row and column; a cost of 0 keeps a row out of a column.

    ``positive`` and ``negative`` are (splits, classes) costs. Columns are split by split. With
    one split no row is held out for calibration.
    """
    splits, classes = positive.shape
    own = y[:, None] == np.arange(classes)
    signs, costs = np.where(own, 1.0, -1.0), []
    for s in range(splits):
        used = train & ((split != s) | (splits == 1))
        costs.append(np.where(own, positive[s], negative[s]) * used[:, None])
    return np.tile(signs, splits), np.concatenate(costs, axis=1)


def objectives(w: np.ndarray, margins: np.ndarray, signs: np.ndarray, costs: np.ndarray) -> np.ndarray:
    return 0.5 * (w * w).sum(axis=0, dtype=np.float64) + (costs * np.maximum(0, 1 - signs * margins) ** 2).sum(axis=0)


def _mirrored(signs: np.ndarray, costs: np.ndarray, w: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Whether a column is the one before it with all signs turned, as the second of two classes is."""
    found = np.zeros(signs.shape[1], dtype=bool)
    for c in range(1, len(found)):
        if not found[c - 1] and np.array_equal(costs[:, c], costs[:, c - 1]):
            on = costs[:, c] > 0
            found[c] = on.any() and np.array_equal(signs[on, c], -signs[on, c - 1]) and np.array_equal(w[:, c], -w[:, c - 1]) and np.array_equal(a[:, c], a[:, c - 1])
    return found


def ascend(
    block: Block, signs: np.ndarray, costs: np.ndarray, w: np.ndarray, a: np.ndarray, blocks: int, tolerance: float, alone: bool | None = None
) -> tuple[np.ndarray, np.ndarray, int]:
    """Coefficients and dual variables after passes over the block; ``w`` answers ``blocks`` times.

    A block that is ``alone`` ends when every column's gap is small, one of several after a few passes. The
    passes move coefficients of single precision; the result is summed up again from the duals.
    """
    alone = blocks == 1 if alone is None else alone
    start = a.astype(np.float32)
    a, owners, terms = start.copy(), block.owners(w.shape[1]), block.terms
    mirrored = _mirrored(signs, costs, w, start)
    live = np.flatnonzero((costs > 0).any(axis=0) & ~mirrored)
    # Rows must lie together: from any other layout, ``take`` copies all coefficients for each row.
    u = np.ascontiguousarray(block.weighted(w, owners)[:, live], dtype=np.float32)
    dense, weight = np.ascontiguousarray(w[terms:][:, live], dtype=np.float32), block.idf.astype(np.float32)
    starts, single, term, code, vectors = block.start.tolist(), block.single, block.term, block.code, block.vectors
    order, passes = np.random.default_rng(7), 0
    owner, used = owners[live], (costs[:, live] > 0).any(axis=1)
    # By fit; ``spread`` takes a change of all columns to those of each fit.
    squared = weight * weight
    spread = (owner == np.arange(block.idf.shape[1])[:, None]).astype(np.float32)
    whole = _whole_rows(u)
    while len(live) and passes < (MOST_PASSES if alone else LOCAL_PASSES):
        # Of all rows, so that a column goes the same way whatever the others are.
        rows = block.order[order.permutation(len(block))]
        rows = rows[used[rows]]
        late = np.zeros(len(live))
        for first in range(0, len(rows), STRIP):
            strip = rows[first : first + STRIP]
            cost, sign, old = (x[strip].take(live, axis=1) for x in (costs, signs, a))
            on = cost > 0
            soft = np.where(on, 0.5 / np.where(on, cost, 1), 0)
            # What a slope moves a dual variable by; 0 keeps it where a row isn't the column's.
            pace = np.where(on, 1 / (blocks * block.square[strip].take(owner, axis=1) + soft), 0)
            scale = block.scale[strip].take(owner, axis=1).astype(np.float32)
            kept, slope, push = (x.astype(np.float32) for x in (old * (1 - soft * pace) + pace, sign * pace, sign * np.float32(blocks)))
            new, seen = old.copy(), np.empty_like(old)
            for k, i in enumerate(strip.tolist()):
                at = slice(starts[i], starts[i + 1])
                columns, value = term[at].astype(np.intp), single[code[at]]
                own = u.take(columns, axis=0)
                z = value @ own
                z *= scale[k]
                z += dense[-1]
                if vectors is not None:
                    z += vectors[i] @ dense[:-1]
                seen[k] = z
                z *= slope[k]
                moved = np.maximum(kept[k] - z, 0)
                change = moved - old[k]
                if change.any():
                    new[k] = moved
                    change *= push[k]
                    dense[-1] += change
                    if vectors is not None:
                        dense[:-1] += np.multiply.outer(vectors[i], change)
                    change *= scale[k]
                    step = squared.take(columns, axis=0)
                    step *= value[:, None]
                    own += step @ (spread * change)
                    whole[columns] = _whole_rows(own)
            a[np.ix_(strip, live)] = new
            late += (cost * np.maximum(0, 1 - sign * seen) ** 2).sum(axis=0)
        passes += 1
        if alone and passes % CHECK_PASSES == 0:
            norm = _squares(block, u, dense, owner)
            dual = _dual(a, costs, live) - 0.5 * norm
            # Losses as the rows were met say whether it is worth to look at all margins.
            if passes % MOST_UNSEEN and not (0.5 * norm + late - dual <= WORTH * tolerance * np.maximum(dual, 1e-12)).any():
                continue
            loss = np.zeros(len(live))
            for first, last in block.slices():
                margins = block.margins(u, dense, owner, first, last)
                loss += (costs[first:last][:, live] * np.maximum(0, 1 - signs[first:last][:, live] * margins) ** 2).sum(axis=0)
            primal = 0.5 * norm + loss
            open_ = primal - dual > 0.9 * tolerance * np.maximum(primal, 1e-12)
            if not open_.all():
                live = live[open_]
                u, dense, spread = (np.ascontiguousarray(x[:, open_]) for x in (u, dense, spread))
                whole = _whole_rows(u)
                owner, used = owners[live], (costs[:, live] > 0).any(axis=1)
    a[:, mirrored] = a[:, np.flatnonzero(mirrored) - 1]
    return w + blocks * block.backward(w.shape[1], lambda i, j: (a[i:j].astype(np.float64) - start[i:j]) * signs[i:j]), a, passes


def _whole_rows(x: np.ndarray) -> np.ndarray:
    """A view with an entry for each row, which is assigned faster than the row's numbers are."""
    return x.view(np.dtype((np.void, x.shape[1] * x.itemsize))).ravel()


def _squares(block: Block, u: np.ndarray, dense: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Squared lengths of the columns' coefficients."""
    idf = block.idf.astype(np.float32)
    inverse = np.where(idf > 0, 1 / np.where(idf > 0, idf, 1), 0).take(owner, axis=1)
    inverse *= u
    inverse *= inverse
    return inverse.sum(axis=0, dtype=np.float64) + (dense * dense).sum(axis=0, dtype=np.float64)


def _dual(a: np.ndarray, costs: np.ndarray, live: np.ndarray) -> np.ndarray:
    """What the dual variables say but for the length of the coefficients."""
    total = np.zeros(len(live))
    for first in range(0, len(a), SLICE):
        own, cost = a[first : first + SLICE][:, live].astype(np.float64), costs[first : first + SLICE][:, live]
        total += (own - np.where(own > 0, own * own / (4 * np.where(cost > 0, cost, 1)), 0)).sum(axis=0)
    return total


def _state_rows(rows: list[tuple]) -> pa.Table:
    """Rows of ``STATE``."""
    fits, blocks, kinds, chunks, ids, payloads = zip(*rows) if rows else ((),) * 6
    return pa.table(
        {
            "fit": pa.array(fits, pa.int32()),
            "block": pa.array(blocks, pa.int32()),
            "kind": pa.array(kinds, pa.string()),
            "chunk": pa.array(chunks, pa.int32()),
            "ids": pa.array(ids, pa.binary()),
            "payload": pa.array(payloads, pa.binary()),
        }
    )


def _ranges(features: np.ndarray, w: np.ndarray, kind: str) -> list[tuple]:
    out = []
    chunks = features // CHUNK
    for chunk in np.unique(chunks).tolist():
        at = chunks == chunk
        out.append((kind, chunk, features[at].astype("<i8").tobytes(), w[at].astype("<f8").tobytes()))
    return out


def _local(state: pa.Table, features: np.ndarray, columns: int) -> np.ndarray:
    """The coefficients of ``features`` from rows of ``STATE``; missing ones are 0."""
    w = np.zeros((len(features), columns))
    order = np.argsort(features)
    for kind, ids, payload in zip(*(state.column(c).to_pylist() for c in ("kind", "ids", "payload"))):
        if kind == "w":
            ids = np.frombuffer(ids, "<i8")
            at = np.searchsorted(features, ids, sorter=order)
            at = order[np.where(at == len(features), 0, at)]
            met = features[at] == ids
            w[at[met]] = np.frombuffer(payload, "<f8").reshape(-1, columns)[met]
    return w


def _bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _levels(tf: np.ndarray) -> bytes:
    """Counts as a byte each and the few values they take, or as they are."""
    levels, code = np.unique(tf, return_inverse=True)
    if len(levels) > 255:
        return b"\0" + tf.astype("<f4").tobytes()
    return bytes([len(levels)]) + levels.astype("<f4").tobytes() + code.astype(np.uint8).tobytes()


def _read_levels(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = data[0]
    if not n:
        return np.unique(np.frombuffer(data, "<f4", offset=1), return_inverse=True)
    return np.frombuffer(data, "<f4", n, 1), np.frombuffer(data, np.uint8, offset=1 + 4 * n)


def pieces(rows: DataFrame, blocks: int, terms: int) -> DataFrame:
    """Rows of a block packed together, a few thousand at a time, as ``PIECE``."""
    block = F.pmod(F.xxhash64("row_id"), F.lit(blocks)).cast("int").alias("block")
    names = ["row_id", "fold", "held_out", "y", "split", "emb"]
    width = "<u2" if terms <= 1 << 16 else "<i4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = np.asarray(batch.column("block"))
            for number in np.unique(of).tolist():
                own = batch if blocks == 1 else batch.take(pa.array(np.flatnonzero(of == number)))
                sizes = pa.array(own.column("idx").value_lengths(), pa.int32())
                facts = pa.RecordBatch.from_arrays([*(own.column(c) for c in names), sizes], names=[*names, "size"])
                idx, tf = (np.asarray(own.column(c).flatten()) for c in ("idx", "tf"))
                values = [[number], [_bytes(facts)], [idx.astype(width).tobytes()], [_levels(tf)]]
                kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=["block", "rows", "idx", "tf"])

    return rows.select(block, *names, "idx", "tf").mapInArrow(run, PIECE)


def parties(fits: list[Fit], splits: int, most: int) -> list[int]:
    """The party of every fit: neighbours together, with about as many columns each."""
    columns = np.array([splits * (f.classes if f.classes > 2 else 1) for f in fits], dtype=float)
    middle = np.cumsum(columns) - columns / 2
    found = np.minimum((middle * min(most, len(fits)) / columns.sum()).astype(int), most - 1)
    return np.unique(found, return_inverse=True)[1].tolist()


class Problem:
    """What a task needs to know of all fits: few numbers for each column."""

    def __init__(self, fits: list[Fit], party: list[int], costs: dict[int, tuple[np.ndarray, np.ndarray]], dimensions: int, terms: int, alone: bool, together: int, tolerance: float):
        self.fits, self.party, self.costs, self.dimensions, self.terms = fits, party, costs, dimensions, terms
        self.alone, self.together, self.tolerance = alone, together, tolerance

    def opened(self, packed: pa.Table, state: pa.Table) -> None:
        """Read a block of a party: its rows, fits and what the rows say."""
        self.number = packed.column("block")[0].as_py()
        party = packed.column("party")[0].as_py()
        self.own = [f for f, p in zip(self.fits, self.party) if p == party]
        self.widths = [self.costs[f.number][0].size for f in self.own]
        self.at = [slice(b - w, b) for w, b in zip(self.widths, np.cumsum(self.widths).tolist())]
        rows = pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all() for x in packed.column("rows").combine_chunks()])
        n = rows.num_rows
        y, split = (np.asarray(rows.column(c).combine_chunks().flatten()).reshape(n, -1) for c in ("y", "split"))
        sizes = np.asarray(rows.column("size"), dtype=np.int64)
        width = "<u2" if self.terms <= 1 << 16 else "<i4"
        terms = np.concatenate([np.frombuffer(x.as_buffer(), width) for x in packed.column("idx").combine_chunks()])
        listed = [_read_levels(x.as_buffer().to_pybytes()) for x in packed.column("tf").combine_chunks()]
        levels = np.unique(np.concatenate([v for v, _ in listed]))
        narrow = np.uint8 if len(levels) <= 256 else np.int32
        code = np.concatenate([np.searchsorted(levels, v).astype(narrow)[c] for v, c in listed])
        del listed
        wanted = (y[:, sorted({f.head for f in self.own})] >= 0).any(axis=1)
        if not wanted.all():
            entry = np.repeat(wanted, sizes)
            rows, y, split, sizes = rows.filter(pa.array(wanted)), y[wanted], split[wanted], sizes[wanted]
            terms, code = terms[entry], code[entry]
        self.rows, self.y, self.split = rows, y, split
        self.fold, self.held = np.asarray(rows.column("fold")), np.asarray(rows.column("held_out").to_numpy(), dtype=bool)
        vectors = np.asarray(rows.column("emb").combine_chunks().flatten()) if self.dimensions else None
        weights = {f: p for f, k, p in zip(*(state.column(c).to_pylist() for c in ("fit", "kind", "payload"))) if k == "idf"}
        idf = np.stack([np.frombuffer(weights[f.number], "<f8") for f in self.own], axis=1)
        order = np.asarray(pc.sort_indices(rows.column("row_id")), dtype=np.int64)
        self.block = Block.of(sizes, terms, levels, code, vectors, idf, self.dimensions, np.repeat(np.arange(len(self.own)), self.widths), order)

    def _train(self, fit: Fit, first: int, last: int) -> np.ndarray:
        return trained_on(fit, self.fold[first:last], self.held[first:last])

    def sides(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Signs and costs of a slice of rows, the columns of all fits side by side."""
        parts = []
        for f in self.own:
            y = self.y[first:last, f.head]
            parts.append(problem(y, self._train(f, first, last) & (y >= 0), self.split[first:last, f.head], *self.costs[f.number]))
        return tuple(np.concatenate(x, axis=1) for x in zip(*parts))

    def _local(self, state: pa.Table) -> np.ndarray:
        return np.concatenate([_local(state.filter(pc.equal(state.column("fit"), f.number)), self.block.features, w) for f, w in zip(self.own, self.widths)], axis=1)

    def solve(self, packed: pa.Table, state: pa.Table) -> pa.Table:
        if not packed.num_rows:
            return _state_rows([])
        self.opened(packed, state)
        n, columns = len(self.block), sum(self.widths)
        signs, costs = np.empty((n, columns), dtype=np.int8), np.empty((n, columns), dtype=np.float32)
        for first, last in self.block.slices():
            signs[first:last], costs[first:last] = self.sides(first, last)
        w, a = self._local(state), np.zeros((n, columns), dtype=np.float32)
        for fit, kind, payload in zip(*(state.column(c).to_pylist() for c in ("fit", "kind", "payload"))):
            if kind == "dual":
                # Kept in the order of the ids, in which the rows may come differently.
                k = [f.number for f in self.own].index(fit)
                a[self.block.order, self.at[k]] = np.frombuffer(payload, "<f4").reshape(n, -1)
        after, a, passes = ascend(self.block, signs, costs, w, a, self.together, self.tolerance, self.alone)
        dual = np.zeros(columns)
        for first, last in self.block.slices():
            own, (_, cost) = a[first:last].astype(np.float64), self.sides(first, last)
            dual += (own - np.where(own > 0, own * own / (4 * np.where(cost > 0, cost, 1)), 0)).sum(axis=0)
        out = []
        for f, at in zip(self.own, self.at):
            key = (f.number, self.number)
            out.append((*key, "dual", 0, None, a[self.block.order, at].astype("<f4").tobytes()))
            out.append((*key, "sum", passes, None, dual[at].astype("<f8").tobytes()))
            out += [(*key, *r) for r in _ranges(self.block.features, (after[:, at] - w[:, at]) / self.together, "w" if self.alone else "change")]
        if self.alone:
            out += self._evaluated(after, {f.number: (after[:, at] ** 2).sum(axis=0) for f, at in zip(self.own, self.at)})
        return _state_rows(out)

    def evaluate(self, packed: pa.Table, state: pa.Table) -> pa.Table:
        if not packed.num_rows:
            return _state_rows([])
        self.opened(packed, state)
        norms = {f.number: np.zeros(w) for f, w in zip(self.own, self.widths)}
        for fit, kind, payload in zip(*(state.column(c).to_pylist() for c in ("fit", "kind", "payload"))):
            if kind == "w":
                norms[fit] += (np.frombuffer(payload, "<f8").reshape(-1, len(norms[fit])) ** 2).sum(axis=0)
        return _state_rows(self._evaluated(self._local(state), norms))

    def _evaluated(self, w: np.ndarray, norms: dict[int, np.ndarray]) -> list[tuple]:
        """Margins of all rows, packed, the losses and the squared norms."""
        out, loss = [], np.zeros(w.shape[1])
        for first, last, margins in self.block.forward(w):
            signs, costs = self.sides(first, last)
            loss += (costs * np.maximum(0, 1 - signs * margins) ** 2).sum(axis=0)
            facts = self.rows.slice(first, last - first)
            for f, at, width in zip(self.own, self.at, self.widths):
                mine = np.flatnonzero(self.y[first:last, f.head] >= 0)
                m = pa.array(margins[mine, at].ravel(), pa.float32())
                data = {
                    "fit": pa.array(np.full(len(mine), f.number), pa.int32()),
                    "row_id": facts.column("row_id").combine_chunks().take(pa.array(mine)),
                    "fold": pa.array(self.fold[first:last][mine], pa.int32()),
                    "y": pa.array(self.y[first:last, f.head][mine], pa.int32()),
                    "split": pa.array(self.split[first:last, f.head][mine], pa.int32()),
                    "train": pa.array(self._train(f, first, last)[mine], pa.bool_()),
                    "m": pa.ListArray.from_arrays(pa.array(np.arange(len(mine) + 1) * width, pa.int32()), m),
                }
                out.append((f.number, self.number, "margins", first, None, _bytes(pa.record_batch(data))))
        for f, at in zip(self.own, self.at):
            for kind, values in (("loss", loss[at]), ("norm", norms[f.number])):
                out.append((f.number, self.number, kind, 0, None, values.astype("<f8").tobytes()))
        return out


def _unpacked(packed: DataFrame, row_id: str) -> DataFrame:
    """Rows of margins from those that ``evaluate`` packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column("payload"):
                yield from pa.ipc.open_stream(payload.as_buffer())

    kind = f"fit int, row_id {row_id}, fold int, y int, split int, train boolean, m array<float>"
    return packed.filter("kind = 'margins'").select("payload").mapInArrow(run, kind)


def _added(key, changes: pa.Table) -> pa.Table:
    """The sum of all changes in one range of features."""
    fit, chunk = (k.as_py() for k in key)
    parts = [(np.frombuffer(i, "<i8"), np.frombuffer(p, "<f8")) for i, p in zip(changes.column("ids").to_pylist(), changes.column("payload").to_pylist())]
    features, at = np.unique(np.concatenate([i for i, _ in parts]), return_inverse=True)
    columns = len(parts[0][1]) // len(parts[0][0])
    total = np.zeros((len(features), columns))
    np.add.at(total, at, np.concatenate([p.reshape(-1, columns) for _, p in parts]))
    return _state_rows([(fit, 0, "w", chunk, features.astype("<i8").tobytes(), total.tobytes())])


def _places(spark: SparkSession, n: int) -> list[int]:
    """A key for each of ``n`` partitions, so that long tasks don't meet in one of them."""
    keys = spark.range(64 * n).select("id", F.pmod(F.hash(F.col("id").cast("int")), F.lit(n)).alias("at")).groupBy("at").agg(F.min("id").alias("id")).collect()
    found = {r["at"]: r["id"] for r in keys}
    return [found.get(i, i) for i in range(n)]


def fit_all(
    rows: DataFrame, fits: list[Fit], idf: np.ndarray, costs: dict[int, tuple[np.ndarray, np.ndarray]],
    dimensions: int, tolerance: float = TOLERANCE,
) -> Fitted:
    """All fits side by side, over rows (row_id, idx, tf, emb, fold, held_out, y, split).

    ``y`` and ``split`` are arrays with an entry for each head; rows with a negative ``y`` are
    not the head's. ``idf`` is (terms, fits), 0 where a fit doesn't know the term.
    """
    spark = rows.sparkSession
    entries = rows.agg(F.sum(F.size("idx") * F.lit(8) + F.size("emb") * F.lit(4))).first()[0] or 0
    blocks = max(1, -(-entries // BLOCK_BYTES))
    splits = len(costs[fits[0].number][0])
    party = parties(fits, splits, max(PARTIES, spark.sparkContext.defaultParallelism))
    count = max(party) + 1
    turns = min(blocks, max(LEAST_TURNS, -(-blocks // max(1, AT_ONCE // count))))
    task = Problem(fits, party, costs, dimensions, len(idf), blocks == 1, -(-blocks // turns), tolerance)
    packed = materialise(pieces(rows, blocks, len(idf)), "svm-pieces")
    dealt = packed.withColumn("party", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))

    def in_blocks(df: DataFrame) -> DataFrame:
        return df.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    known = [(f.number, 0, "idf", 0, None, idf[:, f.number].astype("<f8").tobytes()) for f in fits]
    weights = materialise(in_blocks(spark.createDataFrame(known, STATE)), "svm-idf")
    row_id = rows.schema["row_id"].dataType.simpleString()

    # A block of a party is a long task of its own, so they aren't merged by their bytes.
    tasks = min(blocks * count, MOST_TASKS)
    key = F.col("party") * blocks + F.col("block")
    if blocks * count <= MOST_PLACED:
        key = F.get(F.array(*[F.lit(k) for k in _places(spark, tasks)]), key)

    def met(state: DataFrame, action, purpose: str, turn: int | None = None) -> DataFrame:
        sides = [dealt, state.withColumn("party", F.get(F.array(*[F.lit(p) for p in party]), F.col("fit")))]
        if turn is not None:
            sides = [df.filter(F.pmod(F.col("block") + F.col("party"), F.lit(turns)) == turn) for df in sides]
        spread = [df.withColumn("place", key.cast("int")).repartition(tasks, "place") for df in sides]
        pairs = spread[0].groupBy("place").cogroup(spread[1].groupBy("place"))
        return materialise(pairs.applyInArrow(action, STATE), purpose)

    w, passes, result, solved = None, 0, None, [None] * turns
    for number in range(1, MOST_ROUNDS + 1):
        sums = []
        # Each block of each party has one turn in a round, with the coefficients that the turn before left.
        for turn in range(turns):
            state = weights if w is None else weights.unionByName(in_blocks(w))
            if solved[turn] is not None:
                state = state.unionByName(solved[turn].filter("kind = 'dual'"))
            solved[turn] = met(state, lambda a, b: task.solve(a, b), "svm-solved", turn)
            sums += solved[turn].filter("kind = 'sum'").select("fit", "chunk", "payload").collect()
            if blocks > 1:
                changes = solved[turn].filter("kind = 'change'").drop("block")
                if w is not None:
                    changes = changes.unionByName(w.drop("block"))
                w = materialise(changes.groupBy("fit", "chunk").applyInArrow(lambda key, rows: _added(key, rows), STATE), "svm-coefficients")
        if blocks == 1:
            # A task that has all rows of its fits says everything at once.
            w, evaluated = solved[0].filter("kind = 'w'"), solved[0]
        else:
            evaluated = met(weights.unionByName(in_blocks(w)), lambda a, b: task.evaluate(a, b), "svm-margins")
        passes = max([passes, *(r["chunk"] for r in sums)])
        dual, loss, norm = {}, {}, {}
        for r in sums:
            dual[r["fit"]] = dual.get(r["fit"], 0) + np.frombuffer(r["payload"], "<f8")
        for r in evaluated.filter("kind in ('loss', 'norm')").select("fit", "kind", "payload").collect():
            values = np.frombuffer(r["payload"], "<f8")
            if r["kind"] == "loss":
                loss[r["fit"]] = loss.get(r["fit"], 0) + values
            else:
                norm[r["fit"]] = values
        primal = {f: 0.5 * norm[f] + loss[f] for f in loss}
        gap = {f: (primal[f] - dual[f] + 0.5 * norm[f]) / np.maximum(primal[f], 1e-12) for f in primal}
        result = Fitted(_unpacked(evaluated, row_id), w, number, passes, gap, primal)
        if max((g.max() for g in gap.values()), default=0) <= tolerance:
            break
    return result


def coefficients(state: DataFrame, fit: Fit, columns: int, features: int) -> np.ndarray:
    """(features, columns) of one fit; at most the capped vocabulary, the vector and the constant."""
    w = np.zeros((features, columns))
    for r in state.filter(F.col("fit") == fit.number).select("ids", "payload").collect():
        w[np.frombuffer(r["ids"], "<i8")] = np.frombuffer(r["payload"], "<f8").reshape(-1, columns)
    return w

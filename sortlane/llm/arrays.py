"""Words, rolling hashes and sliding minima of whole texts, as numpy arrays over Arrow batches.

Words are runs of bytes other than 0x20 and 0x09-0x0D; the pattern ``[^\\x20\\x09-\\x0D]+`` on
code points gives the same words, since those bytes never occur inside a UTF-8 sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
# The pattern of a word for Spark and for DuckDB.
WORD = r"[^\x20\x09-\x0D]+"

SLICE_BYTES = 500_000

_random = np.random.default_rng(20240229)
_BYTE_VALUES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_random.integers(1 << 40, 1 << 62)) * 2 + 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n - 1) modulo 2**64; kept, and grown when a longer one is asked for."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        values = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        values[0] = 1
        have = _powers[base] = np.cumprod(values, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if column.null_count:
        column = pc.fill_null(column, b"" if "binary" in str(column.type) else "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind, column.offset + n + 1)[column.offset :].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece holds about ``limit`` bytes of text, or one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(np.asarray(lengths, dtype=np.int64)) if batch.num_rows else np.zeros(0, np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the number of its first word (n + 1 values)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    blank = SEPARATOR[data]
    edge = np.empty(n + 1, dtype=bool)  # a word can't go on from i - 1 to i
    edge[0] = edge[n] = True
    edge[1:n] = blank[:-1]
    edge[offsets] = True
    starts = np.flatnonzero(~blank & edge[:-1])
    edge[:n] = blank
    edge[offsets] = True
    ends = np.flatnonzero(~blank & edge[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def rolling(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` takes the hash of any span of bytes."""
    n = len(data)
    out = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * powers(_BASE, n), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans' bytes, independent of where a span stands."""
    value = (prefix[ends] - prefix[starts]) * powers(_INVERSE, len(prefix))[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def gram_hash(prefix: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all spans of ``width`` units; fewer units give none."""
    n = len(prefix) - width
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    return mix((prefix[width:] - prefix[:n]) * powers(_INVERSE, n))


def token_prefix(tokens: np.ndarray, salt: int = 0) -> np.ndarray:
    """Prefix sums like ``rolling``, over 64-bit tokens instead of bytes."""
    out = np.zeros(len(tokens) + 1, dtype=np.uint64)
    values = mix(tokens + np.uint64(salt)) if salt else tokens
    np.cumsum(values * powers(_BASE, len(tokens)), out=out[1:])
    return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(rolling(data), starts, ends)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    low, reach = values, 1
    while reach * 2 <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    return np.minimum(low[:n], low[width - reach : width - reach + n])


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of the spans, one after the other."""
    total = int(lengths.sum())
    if total == 0:
        return data[:0]
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return data[shift + np.arange(total)]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)

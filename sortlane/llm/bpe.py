"""BPE encoding and decoding that reuses content-defined chunks.

A text is cut into chunks where a rolling hash of the bytes before a blank has ``CUT_BITS`` zero
bits, so equal passages give equal chunks in whatever text they stand. Each distinct chunk is
encoded once per Python worker; inside a new chunk, each distinct word is. At every join of two
chunks the words on both sides are encoded again as one piece: if that differs from the two
chunks' own ids, the chunks are encoded together, and the join after them is looked at next.

Words may be encoded alone because the tokenizer's own splitting drops blanks; a tokenizer whose
split pattern isn't known to do so is refused. What workers keep is bounded (``MOST_KEPT``), so equal chunks in different
tasks are encoded once in each: dealing all chunks of the corpus out to share them would move
the texts and the ids through two shuffles.
"""

from __future__ import annotations

import gc
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortlane.llm import arrays as A
from sortlane.llm.tables import map_arrow

CUT_BITS = 6
HASH_BYTES = 8
MOST_KEPT = 150_000
# So many times fewer chunks than words are kept: each is as long as some 60 of them.
WORDS_A_CHUNK = 4
# Pieces that go through the library in one call.
PIECES = 1000


class ChunkEncoder:
    """One tokenizer and what this worker has encoded with it."""

    def __init__(self, path: str, most_kept: int = MOST_KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        _drops_blanks(settings)
        self.tokenizer = Tokenizer.from_str(json.dumps(settings))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # A word comes here once: what the library would keep of it is never asked for.
        self.tokenizer.model._resize_cache(0)
        marks = [t for t in settings.get("added_tokens", []) if not t.get("normalized") and not t.get("single_word")]
        self.mark = marks[-1]["content"].encode() if marks else b""
        self.mark_id = marks[-1]["id"] if marks else -1
        self.names: dict[int, str] = {}
        self.most_kept = most_kept
        # Two generations: what the younger one asks for again is taken from the older.
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.chunks: dict[bytes, tuple[bytes, str | None, bytes, bytes]] = {}
        self.joins: set[tuple[bytes, bytes]] = set()

    def _ids(self, texts: list[bytes]) -> list[tuple[bytes, str | None]]:
        """Ids of each piece, and its decoded text if that is not the tokens' strings joined.

        Many pieces go through the library at once, with a special token between them: such a
        token ends what stands before it. Pieces that hold one themselves go alone.
        """
        out: list[tuple[bytes, str | None]] = []
        for start in range(0, len(texts), PIECES):
            some = texts[start : start + PIECES]
            together = self._encoded(self.mark.join(some)) if self.mark else np.zeros(0, np.int32)
            ends = np.flatnonzero(together == self.mark_id)
            if self.mark and len(ends) == len(some) - 1:
                raw, bounds = together.tobytes(), [0, *(4 * (ends + 1)).tolist(), 4 * (len(together) + 1)]
                each = [raw[i : j - 4] for i, j in zip(bounds, bounds[1:])]
            else:
                each = [self._encoded(t).tobytes() for t in some]
            out += [(ids, None) for ids in each]
        return out

    def _encoded(self, text: bytes) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast([text.decode("utf-8")], add_special_tokens=False)
        return np.array(found[0].ids, dtype=np.int32)

    def _decoded(self, raw: bytes) -> str:
        """The tokens' strings, each with a blank after it: what decoding joins."""
        names, ids = self.names, np.frombuffer(raw, np.int32).tolist()
        try:
            return "".join([names[i] for i in ids])
        except KeyError:
            names.update({i: self.tokenizer.id_to_token(i) + " " for i in ids})
            return "".join([names[i] for i in ids])

    def _know(self, words: set[bytes]) -> None:
        """Have the words in ``words``; those of neither generation are encoded."""
        fresh, older = words.difference(self.words), self.older
        self.words.update({w: older[w] for w in fresh if w in older})
        new = [w for w in fresh if w not in older]
        self.words.update(zip(new, [ids for ids, _ in self._ids(new)]))

    def learn(self, chunks: set[bytes]) -> None:
        """Encode the chunks that this worker has not met."""
        new = [c for c in chunks if c not in self.chunks]
        if len(self.chunks) + len(new) > self.most_kept // WORDS_A_CHUNK:
            self.chunks = {c: self.chunks[c] for c in chunks if c in self.chunks}
        split = [c.split() for c in new]
        needed = set().union(*split)
        if len(self.words) + len(needed.difference(self.words)) > 2 * self.most_kept:
            self.words, self.older = {}, self.words
        self._know(needed)
        for chunk, words in zip(new, split):
            ids = b"".join([self.words[w] for w in words])
            self.chunks[chunk] = (ids, None, words[0] if words else b"", words[-1] if words else b"")

    def check(self, pairs: set[tuple[bytes, bytes]]) -> set[tuple[bytes, bytes]]:
        """The joins at which encoding both sides as one gives other ids."""
        new = list(pairs - self.joins)
        self._know({w for pair in new for w in pair})
        together, apart = self._ids([a + b" " + b for a, b in new]), self.words
        bad = {(a, b) for (a, b), ids in zip(new, together) if ids[0] != apart[a] + apart[b]}
        if len(self.joins) > 2 * self.most_kept:
            self.joins = set()
        self.joins.update(p for p in new if p not in bad)
        return bad

    def encode(self, texts: list[list[bytes]]) -> list[tuple[bytes, str]]:
        """Ids (as int32 bytes) and decoded text of each text, given as its chunks."""
        self.learn({c for chunks in texts for c in chunks})
        known = self.chunks
        joins = {(known[a][3], known[b][2]) for chunks in texts for a, b in zip(chunks, chunks[1:])}
        bad = self.check({j for j in joins if j[0] and j[1]})
        out = []
        for chunks in texts:
            if bad:
                chunks = self._repaired(chunks, bad)
            parts = [self.chunks.get(c) or self._whole(c) for c in chunks]
            decoded = [self._decoded(p[0]) if p[1] is None else p[1] for p in parts]
            out.append((b"".join([p[0] for p in parts]), "".join(decoded)[:-1]))
        return out

    def _whole(self, chunk: bytes) -> tuple[bytes, str | None, bytes, bytes]:
        words = chunk.split()
        return (*self._ids([chunk])[0], words[0] if words else b"", words[-1] if words else b"")

    def _repaired(self, chunks: list[bytes], bad: set[tuple[bytes, bytes]]) -> list[bytes]:
        """Chunks merged over the joins that differ."""
        out: list[bytes] = []
        for c in chunks:
            last = out[-1].split()[-1:] if out else []
            first = c.split()[:1]
            if last and first and (last[0], first[0]) in bad:
                out[-1] += c
            else:
                out.append(c)
        return out


# Alternatives of plain characters, letters and numbers, and of classes without blanks: such a
# pattern matches no blank. Others may match none either, but that isn't known.
_KIND = r"\\p\{[LN][a-z]?\}"
_PLAIN = r"[^\s\\\[\](){}.*+?^$|]"
_STEP = rf"(?:{_PLAIN}|{_KIND}|\[(?:{_KIND})+\]|\[\^(?:{_KIND})*\\s(?:{_KIND})*\])[+*?]?"
BLANKLESS = re.compile(rf"(?:{_STEP})+(?:\|(?:{_STEP})+)*")


def _drops_blanks(settings: dict) -> None:
    """Refuse a tokenizer whose pre-tokens could reach over a blank."""
    pre = settings.get("pre_tokenizer") or {}
    steps = pre.get("pretokenizers", [pre])
    split = steps[0] if steps else {}
    drops = split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert")
    drops = drops and BLANKLESS.fullmatch((split.get("pattern") or {}).get("Regex") or "")
    if not drops or any(t.get("lstrip") or t.get("rstrip") for t in settings.get("added_tokens", [])):
        raise ValueError("this tokenizer keeps blanks in its tokens")
    if settings.get("decoder") or settings.get("post_processor"):
        raise ValueError("this tokenizer's decoder or template is not supported")


def cut(data: np.ndarray, offsets: np.ndarray) -> list[list[bytes]]:
    """The chunks of each row; joined they are the row. A chunk begins with a blank, but for a row's first."""
    n = len(data)
    blank = A.SEPARATOR[data]
    raw = data.tobytes()
    at = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1 if n > 1 else np.zeros(0, np.int64)
    at = at[at >= HASH_BYTES]
    if len(at):
        near = A.span_hash(A.rolling(data), at - HASH_BYTES, at)
        at = at[near >> np.uint64(64 - CUT_BITS) == 0]
    ends = np.union1d(at, offsets)
    first = np.searchsorted(ends, offsets)
    ends = ends.tolist()
    return [
        [raw[a:b] for a, b in zip(ends[i:j], ends[i + 1 : j + 1])]
        for i, j in zip(first[:-1].tolist(), first[1:].tolist())
    ]


_kept: dict[tuple[str, int], ChunkEncoder] = {}


def encode(documents: DataFrame, path: str, most_kept: int = MOST_KEPT) -> DataFrame:
    """(doc_id, ids, decoded) of every row, as the library encodes and decodes the whole text.

    A null text is empty and has no ids; an empty or blank text neither. Rows with equal ids stay
    apart. No shuffle; ``path`` must be readable on the executors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path, most_kept) not in _kept:
            _kept[path, most_kept] = ChunkEncoder(path, most_kept)
        encoder = _kept[path, most_kept]
        for piece in A.slices(batches, "text"):
            # What is kept holds no cycles; looking for some takes longer the more there is.
            gc.disable()
            try:
                found = encoder.encode(cut(*A.flat(piece.column("text"))))
            finally:
                gc.enable()
            counts = np.array([len(ids) // 4 for ids, _ in found])
            bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            values = np.frombuffer(b"".join([ids for ids, _ in found]), np.int32)
            ids = pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), ids, pa.array([text for _, text in found], pa.string())],
                names=["doc_id", "ids", "decoded"],
            )

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(texts, run, "doc_id long, ids array<int>, decoded string")

"""Intermediate tables in the shared folder, and Arrow helpers for the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sortlane.llm import arrays as A
from sortlane.plans.workspace import new_folder

# Stands for a null doc_id where ids are ordered or joined: smaller than any other.
NULL_ID = -(1 << 63)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Compute ``df`` once, as a table below ``spark.checkpoint.dir``, and read it back.

    Nothing is recomputed when an executor is lost, and plans above it start from a scan.
    """
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _return_memory() -> None:
    """Give what the allocators of this worker hold unused back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` whose tasks leave no unused memory with their workers, which later steps use again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            _return_memory()

    return df.mapInArrow(run, schema)


def doc_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def part_key(texts: DataFrame) -> Column:
    """The column ``part`` of ``texts`` (from ``keyed``), over the documents themselves."""
    return _text_hash() if texts.several else F.lit(0).cast("long")


def keyed(documents: DataFrame) -> tuple[DataFrame, int]:
    """(doc, part, doc_id, text) of all rows, and the bytes of all texts.

    ``doc`` is the doc_id, with ``NULL_ID`` for null. Rows that share a doc_id but not the text
    are different documents: then ``part`` is a hash of the text, otherwise it is 0. Rows equal
    in both are one document that stands more than once.
    """
    rows = documents.select(
        doc_key().alias("doc"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    per_id = rows.select("doc", F.octet_length("text").cast("long").alias("size")).groupBy("doc")
    per_id = per_id.agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    most, size = per_id.agg(F.max("n"), F.sum("size")).first()
    several = (most or 0) > 1
    part = _text_hash() if several else F.lit(0).cast("long")
    texts = rows.select("doc", part.alias("part"), "doc_id", "text")
    texts.several = several
    return texts, size or 0


# Words of 64 bits in the bitmap of ``likely_among``, at most.
BITMAP_WORDS = 1 << 18


def likely_among(rows: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` without most of those whose ``columns`` are not among ``keys``; those that are all stay.

    For wide rows before a shuffled join that decides. The keys are hashed into a bitmap, whose
    bounded size alone is broadcast: more keys let more rows pass that the join then drops.
    """
    code = F.xxhash64(*columns)
    word = F.pmod(code, F.lit(BITMAP_WORDS)).alias("_word")
    bits = keys.select(word, F.pmod(F.shiftrightunsigned(code, 40), F.lit(64)).cast("int").alias("_bit"))
    bitmap = bits.groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    placed = rows.withColumns({"_word": word, "_bit": F.pmod(F.shiftrightunsigned(code, 40), F.lit(64)).cast("int")})
    found = placed.join(F.broadcast(bitmap), "_word").filter("shiftrightunsigned(_bits, _bit) & 1 = 1")
    return found.select(*rows.columns)


# Compressed bytes of texts that are unpacked together.
PACKED_SLICE = 400_000


def pack_texts(rows: DataFrame) -> DataFrame:
    """``rows`` with the column ``text`` compressed, for a shuffle; a null stays null."""
    names = rows.columns
    fields = [T.StructField(f.name, T.BinaryType() if f.name == "text" else f.dataType) for f in rows.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=6)
        for piece in A.slices(batches, "text"):
            packed = [compressor.compress(x.as_buffer()) if x.is_valid else None for x in piece.column("text")]
            columns = [pa.array(packed, pa.binary()) if c == "text" else piece.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, T.StructType(fields))


def unpack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices, with the texts as they were before ``pack_texts``."""
    decompressor = zstandard.ZstdDecompressor()
    for piece in A.slices(batches, "text", PACKED_SLICE):
        raw = [decompressor.decompress(x.as_buffer()) if x.is_valid else None for x in piece.column("text")]
        names = piece.schema.names
        columns = [pa.array(raw, pa.binary()).cast(pa.string()) if c == "text" else piece.column(c) for c in names]
        yield pa.RecordBatch.from_arrays(columns, names=names)

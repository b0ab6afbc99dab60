"""Dense features: embeddings by key, alignment checks, label numbering, an encoder hook."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortlane.functions.text import encoder_text, let
from sortlane.plans.bounded import lookup_join
from sortlane.plans.ordinals import with_ordinals


def l2_normalise(vector: Column) -> Column:
    """An array of numbers scaled to unit length; a zero vector stays as it is."""
    wide = vector.cast("array<double>")
    norm = F.sqrt(F.aggregate(wide, F.lit(0.0), lambda a, x: a + x * x))
    return let(norm, lambda n: F.transform(wide, lambda x: F.when(n > 0, x / n).otherwise(x)))


def rounded(x: Column, places: int) -> Column:
    """``x`` to some decimal places; what rounds to zero keeps its sign, as IEEE rounding has it."""
    return let(F.round(x, places), lambda r: F.when(r == 0, x * 0.0).otherwise(r))


def embedding_join(df: DataFrame, embeddings: DataFrame, on: str = "row_id") -> DataFrame:
    """Rows with their vector, matched by key."""
    return df.join(embeddings, on, "inner")


def alignment_report(df: DataFrame, embeddings: DataFrame, on: str = "row_id") -> DataFrame:
    """Rows without a vector, vectors without a row, and the range of vector sizes.

    One outer join of keys and sizes; neither texts nor vectors are shuffled.
    """
    left = df.select(on, F.lit(1).alias("_row"))
    right = embeddings.select(on, F.size("embedding").alias("_size"))
    return left.join(right, on, "full_outer").agg(
        F.count("_row").alias("rows"),
        F.count("_size").alias("vectors"),
        F.count_if(F.col("_size").isNull()).alias("rows_without_vector"),
        F.count_if(F.col("_row").isNull()).alias("vectors_without_row"),
        F.min("_size").alias("min_size"),
        F.max("_size").alias("max_size"),
    )


def check_alignment(df: DataFrame, embeddings: DataFrame, on: str = "row_id") -> None:
    """Raise unless rows and vectors match one to one and all vectors have one size."""
    r = alignment_report(df, embeddings, on).first()
    if r["rows_without_vector"] or r["vectors_without_row"] or r["min_size"] != r["max_size"]:
        raise ValueError(f"rows and vectors do not match: {r.asDict()}")


def label_encode(
    df: DataFrame, label: str, out: str = "label_index", row_id: str = "row_id"
) -> DataFrame:
    """Classes in order -> 0..k-1, numbered over the distinct classes only, in ranges of them."""
    classes = df.select(label).filter(F.col(label).isNotNull()).distinct()
    numbered = with_ordinals(classes, [F.asc(label)], out).withColumn(out, F.col(out).cast("int"))
    return lookup_join(df, numbered, label, row_id)


def assemble(vector_columns: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=vector_columns, outputCol=out)


def encode(
    df: DataFrame,
    make_encoder: Callable[[], Callable[[list[str]], np.ndarray]],
    batch_size: int = 256,
    out: str = "embedding",
) -> DataFrame:
    """Add unit vectors for the encoder text of every row.

    ``make_encoder`` is called once per Python worker task and returns a function from a list
    of texts to a matrix; texts are handed over in batches. Vectors are scaled and kept in double
    precision. The column is non-deterministic to the optimiser, so one encode is shared by
    everything that reads it downstream.
    """

    @F.pandas_udf("array<double>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = make_encoder()
        for texts in batches:
            values = texts.tolist()
            rows = []
            for start in range(0, len(values), batch_size):
                matrix = np.asarray(encoder(values[start : start + batch_size]), dtype=np.float64)
                norms = np.linalg.norm(matrix, axis=1, keepdims=True)
                rows.extend((matrix / np.where(norms > 0, norms, 1)).tolist())
            yield pd.Series(rows, index=texts.index)

    once = encoded.asNondeterministic()
    return df.withColumn(out, once(encoder_text(F.col("title"), F.col("description"))))

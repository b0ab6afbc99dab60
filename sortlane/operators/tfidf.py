"""TF-IDF over one- and two-grams: vocabulary, long-form weights and an ML stage."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.feature import CountVectorizer, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sortlane.plans.workspace import materialise
from sortlane.rules import labels as fixed

SALTS = 64


def _exploded(df: DataFrame, terms: str, by: list[str]) -> DataFrame:
    """A row for each term of a row, twice: with repeats (``_distinct`` 0) and without (1)."""
    twice = F.posexplode(F.array(F.col(terms), F.array_distinct(terms))).alias("_distinct", "_terms")
    return df.select(*by, twice).select(*by, "_distinct", F.explode("_terms").alias("term"))


def term_statistics(df: DataFrame, terms: str = "terms", by: list[str] | None = None) -> DataFrame:
    """Corpus count and document count of every term (per group).

    A row yields its terms twice, once with and once without repeats. One partial aggregate
    and one shuffle by term give both counts, and a stop word is one row per task.
    """
    by = by or []
    return _exploded(df, terms, by).groupBy(*by, "term").agg(
        F.count_if(F.col("_distinct") == 0).alias("cf"), F.count_if(F.col("_distinct") == 1).alias("df")
    )


def most_frequent(statistics: DataFrame, size: int, by: list[str]) -> DataFrame:
    """The ``size`` terms with the highest corpus count per group, ties in term order.

    A histogram of counts gives the count at which the quota is reached. Rarer terms are
    dropped in place, so only about ``size`` terms and the ties at the edge are ranked, the
    ties in salted parts first.
    """
    per_count = statistics.groupBy(*by, "cf").agg(F.count("*").alias("n"))
    down = Window.partitionBy(*by).orderBy(F.desc("cf")).rowsBetween(Window.unboundedPreceding, -1)
    more_frequent = F.coalesce(F.sum("n").over(down), F.lit(0))
    edge = (
        per_count.withColumn("above", more_frequent)
        .filter(F.col("above") < size)
        .groupBy(*by)
        .agg(F.min("cf").alias("edge"))
    )
    if by:
        with_edge = statistics.join(F.broadcast(edge), by)
        candidates = with_edge.filter(F.col("cf") >= F.col("edge")).drop("edge")
    else:
        candidates = statistics.filter(F.col("cf") >= edge.scalar())
    order = [F.desc("cf"), F.asc("term")]
    salted = candidates.withColumn("_salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)))
    part = Window.partitionBy(*by, "_salt").orderBy(*order)
    survivors = salted.withColumn("_rank", F.row_number().over(part)).filter(F.col("_rank") <= size)
    whole = Window.partitionBy(*by).orderBy(*order)
    return (
        survivors.withColumn("_rank", F.row_number().over(whole))
        .filter(F.col("_rank") <= size)
        .drop("_rank", "_salt")
    )


def _with_idf(statistics: DataFrame, documents) -> DataFrame:
    smooth = F.log((1 + documents) / (1 + F.col("df"))) + 1
    return statistics.withColumn("idf", smooth)


def vocabulary(
    df: DataFrame,
    terms: str = "terms",
    min_df: int = fixed.NGRAM_MIN_DF,
    max_features: int = fixed.NGRAM_MAX_FEATURES,
) -> DataFrame:
    """(term, cf, df, idf) of the kept terms: at most ``max_features`` rows."""
    documents = df.agg(F.count("*").alias("documents"))
    statistics = term_statistics(df, terms).filter(F.col("df") >= min_df)
    kept = most_frequent(materialise(statistics, "terms"), max_features, [])
    return _with_idf(kept, documents.scalar())


def vocabularies_by_fold(
    df: DataFrame,
    terms: str = "terms",
    fold: str = "fold",
    folds: int = fixed.FOLDS,
    min_df: int = fixed.NGRAM_MIN_DF,
    max_features: int = fixed.NGRAM_MAX_FEATURES,
) -> DataFrame:
    """One vocabulary per fold, each fitted without the rows of that fold.

    The corpus is counted once, by term, with counts of their own for the folds: what a fold may
    not see is subtracted from the total, instead of counting the other folds again for every fold.
    """
    def counts(rows=True) -> list:
        return [F.count_if((F.col("_distinct") == i) & rows).alias(c) for i, c in enumerate(("cf", "df"))]

    all_cf, all_df = counts()
    inside = F.array(*[F.struct(*counts(F.col(fold) == i)) for i in range(folds)])
    wide = _exploded(df, terms, [fold]).groupBy("term").agg(
        all_cf.alias("all_cf"), all_df.alias("all_df"), inside.alias("inside")
    )
    sizes = df.groupBy(fold).agg(F.count("*").alias("inside_n"))
    total = sizes.agg(F.sum("inside_n").alias("total_n"))
    numbers = df.sparkSession.range(folds).select(F.col("id").cast("int").alias(fold))
    documents = (
        numbers.join(F.broadcast(sizes), fold, "left")
        .select(fold, (total.scalar() - F.coalesce("inside_n", F.lit(0))).alias("documents"))
    )
    # Without a fold no term is in more rows than with it, so rare terms go at once.
    statistics = (
        wide.filter(F.col("all_df") >= min_df)
        .select("term", "all_cf", "all_df", F.posexplode("inside").alias(fold, "_own"))
        .select(
            fold,
            "term",
            (F.col("all_cf") - F.col("_own.cf")).alias("cf"),
            (F.col("all_df") - F.col("_own.df")).alias("df"),
        )
        .filter(F.col("df") >= min_df)
    )
    kept = most_frequent(materialise(statistics, "fold-terms"), max_features, [fold])
    return _with_idf(kept.join(F.broadcast(documents), fold), F.col("documents")).drop("documents")


def tfidf_long(df: DataFrame, vocab: DataFrame, key: str = "row_id", terms: str = "terms") -> DataFrame:
    """(key, term, tf, weight): sublinear counts times idf, each row scaled to unit length.

    Rows are spread by key once, while their terms are still one array: counting and scaling
    then both stay within a task. The vocabulary is capped by its construction, which bounds
    what is broadcast.
    """
    spread = df.select(key, terms).repartition(key)
    # Outer: Spark would filter empty arrays before the shuffle, and make the terms twice for that.
    # The join drops the null of an empty array.
    counted = (
        spread.select(key, F.explode_outer(terms).alias("term"))
        .join(F.broadcast(vocab.select("term", "idf")), "term")
        .groupBy(key, "term")
        .agg(F.count("*").alias("tf"), F.first("idf").alias("idf"))
    )
    raw = (1 + F.log(F.col("tf").cast("double"))) * F.col("idf")
    weighted = counted.withColumn("_raw", raw)
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(key)))
    return weighted.select(key, "term", "tf", (F.col("_raw") / norm).alias("weight"))


def _damper():
    """1 + ln c over the stored entries of count vectors, a whole Arrow batch at a time.

    The function is local, so that it travels with the task.
    """

    def dampen(vectors):
        import pyarrow as pa
        import pyarrow.compute as pc

        counts = vectors.field("values")
        damped = pa.ListArray.from_arrays(
            counts.offsets, pc.add(pc.ln(counts.values), 1.0), type=counts.type
        )
        parts = [vectors.field(name) for name in ("type", "size", "indices")]
        return pa.StructArray.from_arrays([*parts, damped], fields=list(vectors.type))

    return F.arrow_udf(dampen, VectorUDT())


class SublinearCounts(
    Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Replaces every term count c of a sparse vector by 1 + ln c."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), _damper()(dataset[self.getInputCol()]))


def tfidf_stages(
    spark: SparkSession, vocab_rows: list, prefix: str = "", terms: str = "terms"
) -> list:
    """ML stages that turn an array of terms into unit TF-IDF vectors, without a shuffle.

    ``vocab_rows`` are (term, idf) rows of a capped vocabulary. The result is the column
    <prefix>tfidf.
    """
    idf = {r["term"]: r["idf"] for r in vocab_rows}
    # Fitted on one row that holds the vocabulary: much faster than handing the terms to the
    # JVM one by one.
    listed = spark.createDataFrame([(list(idf),)], f"{terms} array<string>")
    counts = CountVectorizer(
        inputCol=terms, outputCol=prefix + "counts", vocabSize=max(len(idf), 1), minDF=1.0
    ).fit(listed)
    weights = Vectors.dense([idf[t] for t in counts.vocabulary])
    return [
        counts,
        SublinearCounts(inputCol=prefix + "counts", outputCol=prefix + "damped"),
        ElementwiseProduct(
            scalingVec=weights, inputCol=prefix + "damped", outputCol=prefix + "weighted"
        ),
        Normalizer(p=2.0, inputCol=prefix + "weighted", outputCol=prefix + "tfidf"),
    ]


def scratch_columns(prefix: str = "") -> list[str]:
    """What the stages leave behind besides their result."""
    return [prefix + c for c in ("counts", "damped", "weighted")]

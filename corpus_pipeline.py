"""From raw documents to token ids: rules, near copies, repeated passages, mixture, BPE.

Each stage is (name, function); a function takes (spark, docs, sf_dir), works on all rows that
the stage before it kept and returns a DataFrame. All but the last return the columns of
``documents``. Every stage's rows are written below ``spark.checkpoint.dir`` and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sortlane.llm import bpe, minhash, mixing, quality, substring
from sortlane.llm.queries import table, tokenizer_path
from sortlane.llm.tables import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the fixed rules or the classifier go."""
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels)
    return quality.keep_good(docs.select(*COLUMNS), model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id.

    Shingles of five words, linked at a similarity of 0.8 or more.
    """
    return minhash.keep_one(docs.select(*COLUMNS), shingle=5, per_cent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 or more words that stand earlier go from the texts."""
    kept = substring.deduplicated(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of the sources takes them."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the text decoded from them, one row for each row of the mixture."""
    return bpe.encode(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources", mix_sources),
    ("BPE encoding", encode),
]

# The classifier and the tokenizer can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

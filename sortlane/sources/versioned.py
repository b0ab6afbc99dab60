"""A table by id whose updates rewrite only the files that hold an updated id.

Rows are dealt into ranges of ids once, a file each; a file's place in the order is its slot.
Updates neither add nor remove rows, so the id range of a slot and the filter over its ids hold
for good, and a new version is only another file for some slots. A version is a small Parquet
table (slot, min_id, max_id, rows, batch) and a pointer to it, which is renamed into place when
all its files are there: readers see the old version or the new one, and of two writers one fails.

The filter has, for each id, four bits in one 64-bit word of its slot. It is stored one row a
word, so asking it is a join on (slot, word).

Layout: ``data/_batch=<batch>/_slot=<slot>``, ``filter``, ``manifests/<batch>``, ``versions/<number>``.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_left
from dataclasses import asdict, dataclass, field
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sortlane.operators.merge import UPDATE_COLUMNS, fill_blanks
from sortlane.plans.workspace import materialise

ROWS_PER_FILE = 250_000
IDS_PER_WORD = 4
PROBES = 4
# The driver holds a short row for each file, as it does for any table's listing.
MAX_FILES = 1_000_000
INTERNAL = ("_batch", "_slot", "_new", "_row")


class VersionConflict(RuntimeError):
    """Another writer has published the version that this one was about to publish."""


@dataclass
class Version:
    """One published state of the table."""

    number: int
    batch: str
    transaction: int | None
    rewritten: list[int]
    # What runs over the table have done, by name; carried from version to version.
    progress: dict[str, dict] = field(default_factory=dict)


# --- files and pointers ---------------------------------------------------------------


def _hadoop(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _versions(spark: SparkSession, root: str) -> list[int]:
    folder = _hadoop(spark, f"{root}/versions")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(name) for name in names if name.isdigit())


def _publish(spark: SparkSession, root: str, version: Version) -> Version:
    """Write the pointer under another name and rename it; an existing version is never replaced."""
    jvm = spark._jvm
    draft = _hadoop(spark, f"{root}/versions/.draft-{version.batch}")
    final = _hadoop(spark, f"{root}/versions/{version.number:012d}")
    fs = draft.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(asdict(version)).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(final).toUri(), spark._jsc.hadoopConfiguration()
    )
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    no_overwrite = spark.sparkContext._gateway.new_array(rename, 1)
    no_overwrite[0] = rename.NONE
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(final), no_overwrite)
    except Exception as error:
        if fs.exists(final):
            raise VersionConflict(f"version {version.number} of {root} exists") from error
        raise
    return version


def latest(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The last version, or the one of a number."""
    known = _versions(spark, root)
    if not known or (number is not None and number not in known):
        raise ValueError(f"no version {'' if number is None else number} of {root}")
    chosen = known[-1] if number is None else number
    text = spark.read.text(f"{root}/versions/{chosen:012d}", wholetext=True).first()[0]
    return Version(**json.loads(text))


def manifest(spark: SparkSession, root: str, version: Version | None = None) -> DataFrame:
    """(slot, min_id, max_id, rows, batch) of every file of a version."""
    version = version or latest(spark, root)
    return spark.read.parquet(f"{root}/manifests/{version.batch}")


def files_of(spark: SparkSession, root: str, version: Version) -> list:
    """The manifest's rows in the order of ids."""
    rows = manifest(spark, root, version).limit(MAX_FILES + 1).collect()
    if len(rows) > MAX_FILES:
        raise ValueError(f"{root} has more than {MAX_FILES} files: use more rows a file")
    return sorted(rows, key=lambda r: r["slot"])


def scan(spark: SparkSession, root: str, files: list) -> DataFrame:
    """The rows of some files of ``files_of``, with ``_batch`` and ``_slot``."""
    paths = [f"{root}/data/_batch={r['batch']}/_slot={r['slot']}" for r in files]
    return spark.read.option("basePath", f"{root}/data").parquet(*paths)


def _write_files(placed: DataFrame, root: str, batch: str) -> None:
    """One file for each ``_slot``, sorted by id; the rows of a slot are in one partition."""
    ordered = placed.sortWithinPartitions("_slot", "id")
    writer = ordered.write.mode("error").option("compression", "zstd").partitionBy("_slot")
    writer.parquet(f"{root}/data/_batch={batch}")


# --- the filter -----------------------------------------------------------------------


def _word(rows: str) -> Column:
    """The word of an id in the filter of a slot with so many rows."""
    words = F.greatest(F.ceil(F.col(rows) / IDS_PER_WORD), F.lit(1))
    return F.pmod(F.xxhash64("id"), words).alias("word")


def _mask() -> Column:
    """The bits of an id in its word, from a second hash."""
    second = F.xxhash64("id", F.lit("bits"))
    mask = F.lit(0).cast("long")
    for probe in range(PROBES):
        bit = F.shiftrightunsigned(second, 6 * probe).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return mask.alias("mask")


def _write_filter(ids: DataFrame, files: DataFrame, root: str) -> None:
    """``ids`` is (_slot, id), ``files`` the manifest."""
    sizes = files.select(F.col("slot").alias("_slot"), "rows")
    words = (
        ids.filter(F.col("id").isNotNull())
        .join(sizes, "_slot")
        .select("_slot", _word("rows"), _mask())
        .groupBy("_slot", "word")
        .agg(F.bit_or("mask").alias("bits"))
    )
    words.repartitionByRange("_slot", "word").sortWithinPartitions("_slot", "word").write.mode(
        "error"
    ).parquet(f"{root}/filter")


# --- create, read, update -------------------------------------------------------------


def create(jobs: DataFrame, root: str, rows_per_file: int = ROWS_PER_FILE) -> Version:
    """Write ``jobs`` as version 0 of a new table. The rows of one id share a file.

    A row without an id is kept and no update reaches it. An empty table has one empty version.
    """
    clash = [c for c in jobs.columns if c in INTERNAL]
    if clash:
        raise ValueError(f"columns {clash} are the table's own")
    spark = jobs.sparkSession
    if _versions(spark, root):
        raise ValueError(f"{root} exists")
    batch = f"b{uuid.uuid4().hex}"
    files = max(1, -(-jobs.count() // rows_per_file))
    # One job samples, deals and writes, so the ranges are the same for a task that is repeated.
    ranged = jobs.repartitionByRange(files, "id").withColumn("_slot", F.spark_partition_id())
    _write_files(ranged, root, batch)
    written = spark.read.schema("id string, _slot int").parquet(f"{root}/data/_batch={batch}")
    index = written.groupBy(F.col("_slot").alias("slot")).agg(
        F.min("id").alias("min_id"), F.max("id").alias("max_id"), F.count("*").alias("rows")
    )
    index.withColumn("batch", F.lit(batch)).coalesce(1).write.mode("error").parquet(f"{root}/manifests/{batch}")
    version = Version(0, batch, None, [])
    _write_filter(written.select("_slot", "id"), manifest(spark, root, version), root)
    jobs.limit(0).write.mode("error").parquet(f"{root}/schema")
    return _publish(spark, root, version)


def read(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """All rows of the last version, or of the one of a number."""
    files = files_of(spark, root, latest(spark, root, number))
    if not files:
        return spark.read.parquet(f"{root}/schema")
    return scan(spark, root, files).drop(*INTERNAL)


def _located(spark: SparkSession, files: list, rows: DataFrame) -> DataFrame:
    """``rows`` whose id lies in the range of a file, with ``_slot`` and ``_rows`` of that file.

    Ranges don't overlap, so the first file that ends at the id or after it is the only one.
    """
    ends = spark.sparkContext.broadcast([r["max_id"] for r in files])
    facts = [(i, r["slot"], r["min_id"], r["rows"]) for i, r in enumerate(files)]

    @F.pandas_udf("long")
    def place(values: pd.Series) -> pd.Series:
        return values.map(lambda value: bisect_left(ends.value, value)).astype("int64")

    table = spark.createDataFrame(facts, "_place long, _slot int, _min string, _rows long")
    placed = rows.filter(F.col("id").isNotNull()).withColumn("_place", place("id"))
    return placed.join(table, "_place").filter(F.col("id") >= F.col("_min")).drop("_place", "_min")


def _with_range(files: list) -> list:
    return [r for r in files if r["min_id"] is not None]


def touched_slots(spark: SparkSession, root: str, ids: DataFrame, version: Version | None = None) -> list[int]:
    """Slots that may hold one of ``ids``: its range covers the id and the filter knows it.

    A slot that holds one is never left out; for a small share of foreign ids the filter names
    a slot without need.
    """
    files = _with_range(files_of(spark, root, version or latest(spark, root)))
    if not files:
        return []
    wanted = _located(spark, files, ids.select("id").distinct()).select("_slot", _word("_rows"), _mask())
    words = spark.read.parquet(f"{root}/filter")
    found = (
        wanted.join(words, ["_slot", "word"])
        .filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
        .select("_slot")
        .distinct()
    )
    return sorted(r["_slot"] for r in found.collect())


def _merged(
    spark: SparkSession, root: str, files: list, updates: DataFrame, stamped_at: datetime | Column
) -> DataFrame:
    """The rows of some files after the updates, as ``apply_updates`` gives them, by slot.

    Rows and updates go to the task of their slot together and meet there by id, so the wide
    rows are shuffled once, for the merge and for the files alike.
    """
    stamp = stamped_at if isinstance(stamped_at, Column) else F.lit(stamped_at).cast("timestamp")
    payload = F.struct(*UPDATE_COLUMNS).alias("_new")
    placed = _located(spark, _with_range(files), updates)
    batch = placed.select("_slot", "id", payload).groupBy("_slot", "id").agg(F.max("_new").alias("_new"))
    old = scan(spark, root, files).withColumn("_row", F.lit(True))
    both = old.unionByName(batch, allowMissingColumns=True).repartition("_slot")
    same_id = Window.partitionBy("_slot", "id")
    joined = both.withColumn("_new", F.max("_new").over(same_id)).filter("_row")
    new = {c: F.col("_new")[c] for c in UPDATE_COLUMNS}
    return fill_blanks(joined, new, F.col("_new").isNotNull(), stamp)


def update(
    spark: SparkSession,
    root: str,
    updates: DataFrame,
    stamped_at: datetime | Column,
    transaction: int | None = None,
    base: Version | None = None,
    progress: dict[str, dict] | None = None,
) -> Version:
    """Publish a version with a batch of updates merged in as ``apply_updates`` does.

    Only files of touched slots are read and written again. ``transaction`` numbers the batches
    of one writer in rising order: one that was published before is not applied again. A batch
    that reaches no row publishes no version, unless it has a number or progress to remember.
    Progress is published together with the rows it speaks of. With ``base``, the version that
    the updates were read from, any version published since is a conflict.
    """
    base = base or latest(spark, root)
    if transaction is not None and base.transaction is not None and transaction <= base.transaction:
        return base
    stored = materialise(updates, "updates")
    slots = set(touched_slots(spark, root, stored, base))
    if not slots and transaction is None and progress is None:
        return base
    batch = f"b{uuid.uuid4().hex}"
    if slots:
        files = [r for r in files_of(spark, root, base) if r["slot"] in slots]
        columns = read(spark, root, base.number).columns
        merged = _merged(spark, root, files, stored, stamped_at)
        _write_files(merged.select(*columns, "_slot"), root, batch)
    renewed = spark.createDataFrame([(s, batch) for s in sorted(slots)], "slot int, _new string")
    moved = manifest(spark, root, base).join(renewed, "slot", "left")
    moved.withColumn("batch", F.coalesce("_new", "batch")).drop("_new").coalesce(1).write.mode(
        "error"
    ).parquet(f"{root}/manifests/{batch}")
    number = base.transaction if transaction is None else transaction
    known = {**base.progress, **(progress or {})}
    return _publish(spark, root, Version(base.number + 1, batch, number, sorted(slots), known))

"""Updates by file: which files change, what readers see, replays and conflicts."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sortlane.catalog.fixtures import view
from sortlane.operators import merge
from sortlane.plans.workspace import new_folder
from sortlane.sources import versioned
from sortlane.sources.tables import conform_jobs

STAMP = datetime(2024, 6, 1)


@pytest.fixture(scope="module")
def jobs(spark, folder):
    return conform_jobs(view(spark, folder, "jobs"))


@pytest.fixture
def root(spark):
    return new_folder(spark, "versioned-test")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def updates_of(spark, ids):
    rows = [(i, "Industry", "Role", "Blue", "Mid", "Contract") for i in ids]
    return spark.createDataFrame(rows, merge.UPDATE_SCHEMA)


def file_names(spark, root, number=None):
    df = versioned.read(spark, root, number).select(F.col("_metadata.file_path").alias("f")).distinct()
    return {r.f for r in df.collect()}


def test_only_files_of_updated_ids_change(spark, jobs, root):
    versioned.create(jobs, root, rows_per_file=10)
    before = file_names(spark, root)
    files = versioned.manifest(spark, root).orderBy("slot").collect()
    assert len(files) > 10 and sum(f.rows for f in files) == jobs.count()
    assert all(a.max_id < b.min_id for a, b in zip(files, files[1:]))
    wanted = [files[3].min_id, files[3].max_id, files[7].max_id]
    batch = updates_of(spark, wanted)
    version = versioned.update(spark, root, batch, STAMP)
    assert version.rewritten == [files[3].slot, files[7].slot]
    after = file_names(spark, root)
    assert len(before - after) == len(after - before) == 2
    assert rows_of(versioned.read(spark, root)) == rows_of(merge.apply_updates(jobs, batch, STAMP))
    assert file_names(spark, root, 0) == before
    assert rows_of(versioned.read(spark, root, 0)) == rows_of(jobs)


def test_random_batches_equal_a_full_merge(spark, jobs, root):
    versioned.create(jobs, root, rows_per_file=16)
    expected = jobs
    for salt in range(3):
        ids = jobs.select("id").filter(F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(20)) == 0)
        batch = updates_of(spark, [r.id for r in ids.collect()] + ["none", "zzz", ""])
        versioned.update(spark, root, batch, STAMP)
        expected = merge.apply_updates(expected, batch, STAMP)
    assert rows_of(versioned.read(spark, root)) == rows_of(expected)


def test_filter_spares_files_of_foreign_ids(spark, jobs, root):
    """Ids that lie inside the ranges and belong to no row: few slots are named."""
    versioned.create(jobs, root, rows_per_file=10)
    foreign = [f"{r.id}-x{k}" for r in jobs.select("id").collect() for k in range(5)]
    version = versioned.update(spark, root, updates_of(spark, foreign), STAMP)
    ids = spark.createDataFrame([(i,) for i in foreign], "id string")
    named = sum(len(versioned.touched_slots(spark, root, ids.filter(F.col("id").endswith(f"x{k}")))) for k in range(5))
    assert named <= 0.3 * 5 * versioned.manifest(spark, root).count()
    assert rows_of(versioned.read(spark, root)) == rows_of(jobs)
    assert version.number in (0, 1)


def test_replay_changes_nothing(spark, jobs, root):
    versioned.create(jobs, root, rows_per_file=25)
    batch = updates_of(spark, [r.id for r in jobs.select("id").limit(7).collect()])
    first = versioned.update(spark, root, batch, STAMP, transaction=4)
    names = file_names(spark, root)
    again = versioned.update(spark, root, batch, datetime(2030, 1, 1), transaction=4)
    assert (again.number, again.batch) == (first.number, first.batch)
    assert file_names(spark, root) == names
    content = rows_of(versioned.read(spark, root))
    versioned.update(spark, root, batch, STAMP)
    assert rows_of(versioned.read(spark, root)) == content
    assert versioned.latest(spark, root).transaction == 4


def test_second_writer_of_a_version_fails(spark, jobs, root):
    created = versioned.create(jobs, root, rows_per_file=100)
    rival = versioned.Version(0, "b-rival", None, [])
    with pytest.raises(versioned.VersionConflict):
        versioned._publish(spark, root, rival)
    assert versioned.latest(spark, root).batch == created.batch
    with pytest.raises(ValueError):
        versioned.create(jobs, root)


def test_empty_table_and_rows_without_id(spark, jobs, root):
    versioned.create(jobs.limit(0), f"{root}/none")
    batch = updates_of(spark, ["1"])
    assert versioned.update(spark, f"{root}/none", batch, STAMP).number == 0
    assert versioned.read(spark, f"{root}/none").count() == 0
    some = jobs.limit(3).select(*jobs.columns, F.lit("x").alias("extra"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in some.schema)
    loose = spark.createDataFrame([(None, *tuple(r)[1:]) for r in some.collect()] + some.collect() * 2, schema)
    versioned.create(loose, f"{root}/loose", rows_per_file=2)
    ids = updates_of(spark, [r.id for r in some.collect()])
    versioned.update(spark, f"{root}/loose", ids, STAMP)
    got = versioned.read(spark, f"{root}/loose")
    assert rows_of(got) == rows_of(merge.apply_updates(loose, ids, STAMP).select(*loose.columns))
    with pytest.raises(ValueError):
        versioned.create(some.withColumn("_slot", F.lit(1)), f"{root}/clash")

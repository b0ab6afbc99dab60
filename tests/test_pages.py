"""Ordered pages: quotas, a total over several runs, stop and resume, conflicts."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sortlane.catalog.fixtures import view
from sortlane.operators import merge
from sortlane.plans.daily import rules_only
from sortlane.plans.workspace import new_folder
from sortlane.sources import versioned
from sortlane.sources.tables import conform_jobs
from sortlane.streaming import pages

STAMP = datetime(2024, 6, 1)


@pytest.fixture(scope="module")
def jobs(spark, folder):
    return conform_jobs(view(spark, folder, "jobs"))


@pytest.fixture
def root(spark, jobs):
    path = new_folder(spark, "pages-test")
    versioned.create(jobs, path, rows_per_file=20)
    return path


def stamped(spark, root):
    rows = versioned.read(spark, root).filter(F.col("classified_at") == F.lit(STAMP)).select("id")
    return sorted(r.id for r in rows.collect())


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_total_holds_over_runs_and_resumes(spark, jobs, root):
    queue = sorted(r.id for r in merge.unclassified(jobs).select("id").collect())
    first = pages.run_pages(spark, root, rules_only, STAMP, 30, total=100, max_pages=2)
    assert (first.rows, first.batches) == (60, 2)
    assert stamped(spark, root) == queue[:60]
    second = pages.run_pages(spark, root, rules_only, STAMP, 30, total=100)
    assert (second.rows, second.batches) == (40, 2)
    assert stamped(spark, root) == queue[:100]
    assert pages.run_pages(spark, root, rules_only, STAMP, 30, total=100).rows == 0
    rest = pages.run_pages(spark, root, rules_only, STAMP, 1000)
    assert rest.rows == len(queue) - 100
    assert pages.run_pages(spark, root, rules_only, STAMP, 1000).batches == 0
    whole = merge.apply_updates(jobs, merge.update_frame(rules_only(merge.unclassified(jobs))), STAMP)
    assert rows_of(versioned.read(spark, root)) == rows_of(whole)


def test_page_reads_and_rewrites_few_files(spark, jobs, root):
    base = versioned.latest(spark, root)
    files = versioned.files_of(spark, root, base)
    after = files[4]["max_id"]
    page = pages.next_page(spark, root, base, after, 10)
    assert len(page.inputFiles()) <= 2
    expected = merge.scan_unclassified(jobs, after, 10).select("id")
    assert rows_of(page.select("id")) == rows_of(expected)
    pages.run_pages(spark, root, rules_only, STAMP, 10, max_pages=1)
    assert len(versioned.latest(spark, root).rewritten) == 1


def test_change_between_reading_and_publishing_is_a_conflict(spark, jobs, root):
    some = [r.id for r in jobs.select("id").limit(1).collect()]
    updates = spark.createDataFrame([(some[0], "A", "B", None, None, None)], merge.UPDATE_SCHEMA)

    def disturbed(rows):
        versioned.update(spark, root, updates, STAMP)
        return rules_only(rows)

    with pytest.raises(versioned.VersionConflict):
        pages.run_pages(spark, root, disturbed, STAMP, 10, max_pages=1)
    assert stamped(spark, root) == some
    assert versioned.latest(spark, root).progress == {}

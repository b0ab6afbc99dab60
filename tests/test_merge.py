"""Merges: which value wins, what stays, and that replays change nothing."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sortlane.catalog.fixtures import view
from sortlane.operators import keyword, merge
from sortlane.operators.remote import fill_remote_mode
from sortlane.plans.daily import daily_run, dry_run, rules_only
from sortlane.sources.tables import conform_jobs

STAMP = datetime(2024, 6, 1)


@pytest.fixture(scope="module")
def jobs(spark, folder):
    return conform_jobs(view(spark, folder, "jobs"))


def rows_of(df):
    return {r.id: r for r in df.collect()}


def test_trim_differs_by_column(spark):
    job = {
        "id": "1", "industry": " Kept ", "role": "  ", "job_type_feed": "  ", "experience_level": "",
        "collar": "", "remote_mode": None, "classified_at": None,
    }
    df = conform_jobs(spark.createDataFrame([tuple(job.values())], "id string, industry string, role string, job_type_feed string, experience_level string, collar string, remote_mode string, classified_at timestamp"))
    updates = spark.createDataFrame([("1", "New", "New", "New", "New", "New")], merge.UPDATE_SCHEMA)
    got = merge.apply_updates(df, updates, STAMP).first()
    assert (got.industry, got.role, got.job_type_feed, got.experience_level, got.collar) == ("Kept", "New", "  ", "New", "")
    assert got.remote_mode is None and got.classified_at == STAMP


def test_updates_never_add_or_remove_rows(spark, jobs):
    ids = [r.id for r in jobs.select("id").limit(5).collect()]
    updates = spark.createDataFrame([(i, "A", "B", None, None, None) for i in [*ids, *ids, "unknown"]], merge.UPDATE_SCHEMA)
    merged = merge.apply_updates(jobs, updates, STAMP)
    assert merged.count() == jobs.count()
    assert merge.count_updated(jobs, updates).first().n_updated == 5
    stamped = {r.id for r in merged.filter(F.col("classified_at") == F.lit(STAMP)).collect()}
    assert stamped == set(ids)


def test_empty_batch_changes_nothing(spark, jobs):
    updates = merge.read_update_json(spark, "[]")
    assert merge.count_updated(jobs, updates).first().n_updated == 0
    assert rows_of(merge.apply_updates(jobs, updates, STAMP)) == rows_of(jobs)


def test_merges_are_idempotent(jobs):
    once = fill_remote_mode(keyword.keyword_merge(jobs, STAMP))
    twice = fill_remote_mode(keyword.keyword_merge(once, STAMP))
    assert rows_of(once) == rows_of(twice)
    day = daily_run(jobs, rules_only, STAMP)
    assert rows_of(day) == rows_of(daily_run(day, rules_only, STAMP))


def test_filling_keeps_what_is_there(jobs):
    before, after = rows_of(jobs), rows_of(daily_run(jobs, rules_only, STAMP))
    assert before.keys() == after.keys()
    for i, old in before.items():
        new = after[i]
        for c in ("collar", "remote_mode"):
            assert getattr(old, c) in (None, getattr(new, c))
        if old.job_type_feed:
            assert new.job_type_feed == old.job_type_feed
        assert new.remote_mode is not None
        if old.classified_at is not None:
            assert new.classified_at == old.classified_at


def test_model_tier_does_not_write_the_remote_mode(jobs):
    def eager(rows):
        return rules_only(rows).withColumn("remote_mode", F.lit("Hybrid"))

    assert "remote_mode" not in merge.UPDATE_COLUMNS
    with_rules = rows_of(daily_run(jobs, rules_only, STAMP))
    assert {i: r.remote_mode for i, r in rows_of(daily_run(jobs, eager, STAMP)).items()} == {i: r.remote_mode for i, r in with_rules.items()}


def test_dry_run_writes_nothing_and_shows_the_queue(jobs):
    shown = dry_run(jobs, rules_only, limit=7)
    queue = sorted(r.id for r in merge.unclassified(jobs).select("id").collect())
    assert sorted(r.id for r in shown.collect()) == queue[:7]


def test_pages_cover_the_table(jobs):
    after, seen = "", []
    while True:
        page, cursor = keyword.keyword_chunk(jobs, after, STAMP, 64)
        last = cursor.first().after_id
        if last is None:
            break
        ids = [r.id for r in page.select("id").collect()]
        assert max(ids) == last
        seen += ids
        after = last
    assert sorted(seen) == sorted(r.id for r in jobs.select("id").collect())
    assert len(seen) == len(set(seen))

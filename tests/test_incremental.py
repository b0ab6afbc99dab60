"""Incremental runs: every file once, resumable, replays replace their own output."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sortlane.catalog.fixtures import view
from sortlane.operators.keyword import keyword_merge
from sortlane.plans.daily import model_merge, rules_only
from sortlane.sources import tables
from sortlane.streaming import drain

STAMP = datetime(2024, 6, 1)


@pytest.fixture(scope="module")
def jobs(spark, folder):
    return tables.conform_jobs(view(spark, folder, "jobs")).cache()


def arrive(jobs, source, part):
    jobs.filter(F.crc32("id") % 3 == part).coalesce(1).write.mode("append").parquet(source)


def test_new_files_only_and_same_rows_as_one_batch(spark, jobs, tmp_path):
    source, sink, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    arrive(jobs, source, 0)
    arrive(jobs, source, 1)
    first = drain.keyword_run(spark, source, sink, progress, STAMP, files_per_batch=1)
    assert first.batches == 2
    again = drain.keyword_run(spark, source, sink, progress, STAMP, files_per_batch=1)
    assert (again.rows, again.batches) == (0, 0)
    arrive(jobs, source, 2)
    last = drain.keyword_run(spark, source, sink, progress, STAMP)
    assert first.rows + last.rows == jobs.count()
    got = sorted(drain.read_results(spark, sink).select(*jobs.columns).collect(), key=lambda r: r.id)
    want = sorted(keyword_merge(jobs, STAMP).select(*jobs.columns).collect(), key=lambda r: r.id)
    assert got == want


def test_replay_changes_nothing(spark, jobs, tmp_path):
    """Losing the progress of the last batch replays it into the same partition."""
    source, sink, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    arrive(jobs, source, 0)
    arrive(jobs, source, 1)
    drain.drain(spark, source, rules_only, sink, progress, STAMP, files_per_batch=1)
    before = sorted(drain.read_results(spark, sink).collect(), key=lambda r: r.id)
    for name in ("1", ".1.crc"):
        (tmp_path / "progress" / "commits" / name).rename(tmp_path / f"lost{name}")
    report = drain.drain(spark, source, rules_only, sink, progress, STAMP, files_per_batch=1)
    assert report.batches == 1
    after = sorted(drain.read_results(spark, sink).collect(), key=lambda r: r.id)
    assert before == after
    queue = jobs.filter("classified_at is null and pmod(crc32(id), 3) < 2")
    assert len(after) == queue.count() == len({r.id for r in after})


def test_drain_equals_batch_merge(spark, jobs, tmp_path):
    source, sink, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for part in range(3):
        arrive(jobs, source, part)
    drain.drain(spark, source, rules_only, sink, progress, STAMP)
    queue = jobs.filter("classified_at is null")
    want = model_merge(queue, rules_only, STAMP).select(*jobs.columns)
    got = drain.read_results(spark, sink).select(*jobs.columns)
    assert sorted(got.collect(), key=lambda r: r.id) == sorted(want.collect(), key=lambda r: r.id)
    assert got.filter("classified_at is null").count() == 0


def test_run_without_sink_shows_and_advances(spark, jobs, tmp_path):
    source, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    arrive(jobs, source, 0)
    report = drain.drain(spark, source, rules_only, None, progress, STAMP)
    assert report.rows > 0 and len(report.preview) == 10 and report.rows_per_second > 0
    assert drain.drain(spark, source, rules_only, None, progress, STAMP).rows == 0


def test_throughput_of_resumed_and_replayed_runs_adds_up(spark, jobs, tmp_path):
    source, sink, progress, log = (str(tmp_path / n) for n in ("in", "out", "progress", "log"))
    options = {"files_per_batch": 1, "log": log}
    for part in (0, 1):
        arrive(jobs, source, part)
    first = drain.drain(spark, source, rules_only, sink, progress, STAMP, **options)
    arrive(jobs, source, 2)
    second = drain.drain(spark, source, rules_only, sink, progress, STAMP, **options)
    for name in ("2", ".2.crc"):
        (tmp_path / "progress" / "commits" / name).rename(tmp_path / f"lost{name}")
    assert drain.drain(spark, source, rules_only, sink, progress, STAMP, **options).rows == second.rows
    logged = sorted(drain.read_throughput(spark, log).collect())
    written = spark.read.parquet(sink).groupBy("batch_id").count()
    assert {r.batch_id: r.rows for r in logged} == {r["batch_id"]: r["count"] for r in written.collect()}
    assert [r.batch_id for r in logged] == [0, 1, 2]
    assert sum(r.rows for r in logged) == first.rows + second.rows
    assert all(r.seconds > 0 and r.rows_per_second > 0 for r in logged)


def test_snapshots_are_never_overwritten(spark, jobs, tmp_path):
    path = str(tmp_path / "snapshot")
    tables.write_snapshot(jobs, path)
    with pytest.raises(Exception, match="(?i)already exists"):
        tables.write_snapshot(jobs, path)
    queue = tables.read_snapshot(spark, path, only_queue=True)
    assert queue.count() == jobs.filter("classified_at is null").count()
    assert "is_classified" in queue._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    renamed = tables.physical_jobs(jobs)
    assert {"category_name", "standard_role", "jobType", "classified_6col_at"} <= set(renamed.columns)
    stored = str(tmp_path / "physical")
    renamed.write.parquet(stored)
    assert tables.read_jobs(spark, stored).count() == jobs.count()


def test_csv_round_trip_of_awkward_texts(spark, tmp_path):
    rows = [("a, \"quoted\"", "line one\nline two", "I", "R"), ("", " padded ", "", "x\\y")]
    df = spark.createDataFrame(rows, "title string, description string, industry string, role string")
    path = str(tmp_path / "csv")
    df.coalesce(1).write.csv(path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    numbered = tables.ingest(tables.read_training(spark, path), str(tmp_path / "numbered"))
    got = [tuple(r)[:4] for r in numbered.orderBy("row_id").collect()]
    assert got == rows
    out = str(tmp_path / "flat")
    tables.write_predictions(df.select("title", "role"), out, "csv")
    assert spark.read.csv(out, header=True, multiLine=True, escape='"').count() == 2

"""A drain in ordered pages over a versioned table, with a quota a page and a total limit.

Each page is the next rows of the queue by id. Its labels, the last id and the number of rows
done are published as one version, so a stopped run goes on where it was and neither repeats nor
skips a row, and the total holds over all runs of one name.
"""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sortlane.operators.merge import unclassified, update_frame
from sortlane.plans.daily import Classifier
from sortlane.plans.workspace import materialise
from sortlane.sources import versioned
from sortlane.streaming.drain import RunReport


def next_page(
    spark: SparkSession, root: str, version: versioned.Version, after: str | None, limit: int
) -> DataFrame | None:
    """The first ``limit`` queued rows with an id above ``after``, or None if there are none.

    Files are taken in the order of ids until they hold enough queued rows, twice as many each
    time, so a page reads few files however large the table is. Only ids are sorted, to find
    the last one of the page; the rows are then filtered where they lie. Rows that share the
    last id all belong to the page. Rows without an id are never paged.
    """
    files = [
        f
        for f in versioned.files_of(spark, root, version)
        if f["max_id"] is not None and (after is None or f["max_id"] > after)
    ]
    taken, rows, wanted = 0, 0, limit
    while files:
        while taken < len(files) and rows < wanted:
            rows += files[taken]["rows"]
            taken += 1
        queue = unclassified(versioned.scan(spark, root, files[:taken])).filter(F.col("id").isNotNull())
        if after is not None:
            queue = queue.filter(F.col("id") > after)
        first = queue.select("id").orderBy("id").limit(limit)
        end = first.agg(F.count("*").alias("n"), F.max("id").alias("last")).first()
        if end["n"] < limit and taken < len(files):
            wanted = 2 * rows
            continue
        if end["n"] == 0:
            return None
        return queue.filter(F.col("id") <= end["last"]).drop(*versioned.INTERNAL)
    return None


def run_pages(
    spark: SparkSession,
    root: str,
    classify: Classifier,
    stamped_at: datetime | Column,
    rows_per_page: int,
    total: int | None = None,
    max_pages: int | None = None,
    name: str = "drain",
) -> RunReport:
    """Classify the queue page by page until it is empty, ``total`` rows are done by all runs of
    this name, or this run has done ``max_pages``. What it reports is this run's part.
    """
    if rows_per_page < 1:
        raise ValueError("a page holds one row or more")
    started = time.monotonic()
    done, pages = 0, 0
    while max_pages is None or pages < max_pages:
        base = versioned.latest(spark, root)
        state = base.progress.get(name, {"after": None, "rows": 0})
        left = rows_per_page if total is None else min(rows_per_page, total - state["rows"])
        page = next_page(spark, root, base, state["after"], left) if left > 0 else None
        if page is None:
            break
        stored = materialise(page, "page")
        facts = stored.agg(F.count("*").alias("n"), F.max("id").alias("last")).first()
        updates = update_frame(classify(stored.select("id", "title", "description")))
        reached = {"after": facts["last"], "rows": state["rows"] + facts["n"]}
        versioned.update(spark, root, updates, stamped_at, base=base, progress={name: reached})
        done += facts["n"]
        pages += 1
    return RunReport(done, pages, time.monotonic() - started, [])

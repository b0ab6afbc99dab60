"""Label recovery, joins on hot keys, curation and value reports against brute force."""

from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sortlane.operators import curation, labels
from sortlane.operators.remote import with_training_label
from sortlane.plans import bounded, skew

POSTINGS = [
    ("Nurse", "text one", "Full-time", "", "1.0"),
    ("Nurse - 12345", "<b>text</b> one", "", "Entry level", ""),
    ("Cook", "text two", "Full-time", "", ""),
    ("COOK", "text  two", "Contract", " Associate ", "1"),
    ("Cook (1,2)", "text two", "Full-time", "Associate", "1"),
    ("Clerk", "", " ", "", ""),
]


@pytest.fixture(scope="module")
def postings(spark):
    names = "title string, description string, formatted_work_type string, formatted_experience_level string, remote_allowed string, row_id long"
    return spark.createDataFrame([(*p, i) for i, p in enumerate(POSTINGS)], names)


@pytest.fixture(scope="module")
def training(spark):
    rows = [(10, "nurse", "text one"), (11, "cook", "text two"), (12, "Clerk", ""), (13, "Pilot", "x")]
    return spark.createDataFrame(
        [(*r, "I", "Driver & Logistics") for r in rows],
        "row_id long, title string, description string, industry string, role string",
    )


def test_unanimous_or_nothing(postings, training):
    got = {r.row_id: r for r in labels.recover_labels(training, postings).collect()}
    assert (got[10].job_type, got[10].experience_band, got[10].remote_type) == ("Full-time", "Entry level", "Remote")
    assert (got[11].job_type, got[11].experience_band, got[11].remote_type) == (None, "Associate", "Remote")
    assert (got[12].job_type, got[13].job_type) == (None, None)
    assert {r.collar for r in got.values()} == {"Blue"}


def test_last_row_wins(postings, training):
    got = {r.row_id: r for r in labels.last_wins_join(training, postings).collect()}
    assert (got[10].work_type, got[10].experience, got[10].joined) == (None, "Entry level", True)
    assert (got[11].work_type, got[11].joined) == ("Full-time", True)
    assert (got[12].joined, got[13].joined) == (True, False)


def test_only_rows_of_hot_keys_are_copied(spark, postings):
    """Two thirds of the rows share one key: its lookup row is copied, the others are not."""
    title = F.when(F.col("id") % 3 < 2, "cook").otherwise(F.concat(F.lit("other "), F.col("id")))
    rows = spark.range(30_000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") == 6, "nurse").otherwise(title).alias("title"),
        F.when(F.col("id") == 6, "text one").otherwise("text two").alias("description"),
        F.lit("Others").alias("role"),
    )
    recovered = labels.recover_labels(rows, postings)
    plan = recovered._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence" in plan.lower() or "_salt" in plan
    got = recovered.groupBy("experience_band", "remote_type").count().collect()
    assert {(r[0], r[1]): r[2] for r in got} == {
        ("Associate", "Remote"): 20_000 - 1, ("Entry level", "Remote"): 1, (None, None): 10_000,
    }


def test_join_rate(postings, training):
    assert labels.join_rate(training, postings).first().joined_pct == 75.0


def test_role_outside_the_table_has_no_collar(spark):
    df = spark.createDataFrame([("Others",), (None,), ("Designer",)], "r string")
    assert [r[0] for r in df.select(labels.collar_from_role(F.col("r"))).collect()] == [None, None, "White"]


def test_hot_key_join_keeps_every_row(spark):
    """One key holds a third of the rows; it is spread and nothing is lost or doubled."""
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}") for i in range(3000)]
    left = spark.createDataFrame(rows, "row_id long, key string")
    lookup = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(0, 50, 2)]], "key string, v int")
    hot = skew.hot_keys(left, F.col("key"), share=0.2, sample=1.0, min_sampled=10)
    assert hot == ["hot"]
    salted = skew.left_join_unique(left, lookup, "key", "row_id", hot=hot, salts=16)
    plain = left.join(lookup, "key", "left").select("row_id", "key", "v")
    assert sorted(salted.select("row_id", "key", "v").collect(), key=lambda r: r.row_id) == sorted(plain.collect(), key=lambda r: r.row_id)


def test_hot_keys_are_few(spark):
    left = spark.range(5000).select(F.col("id").alias("row_id"), (F.col("id") % 7).alias("key"))
    assert len(skew.hot_keys(left, F.col("key"), share=0.1, sample=1.0)) == 7
    assert skew.hot_keys(left, F.col("key"), share=0.2, sample=1.0) == []


def test_lookup_too_large_to_collect_is_joined(spark, monkeypatch):
    monkeypatch.setattr(bounded, "small_rows", lambda df, limit=0: None)
    df = spark.range(100).select(F.col("id").alias("row_id"), (F.col("id") % 5).cast("string").alias("c"))
    sizes = curation.class_sizes(df, "c", 5)
    assert bounded.lookup_join(df, sizes.select("c", "n"), "c", "row_id").filter("n = 20").count() == 100
    assert bounded.keep_members(df, "c", sizes.filter("c < '2'").select("c"), "row_id").count() == 40


@pytest.mark.parametrize("k", [1, 2, 5])
def test_cap_per_group_against_brute_force(spark, k):
    rows = [(i * 7919 % 10007, "big" if i % 3 == 0 else f"g{i % 40}") for i in range(2000)]
    df = spark.createDataFrame(rows, "row_id long, g string")
    seen, want = defaultdict(int), set()
    for row_id, g in sorted(rows):
        if seen[g] < k:
            seen[g] += 1
            want.add(row_id)
    for salts in (1, 8, 256):
        got = curation.cap_per_group(df, "g", "row_id", k, salts).collect()
        assert {r.row_id for r in got} == want and len(got) == len(want)


def test_language_filter_comes_before_the_cap(spark):
    body = "the same long body " * 30
    rows = [(1, "mit", body), (2, "a", body), (3, "b", body), (4, "c", body)]
    df = spark.createDataFrame(rows, "row_id long, title string, description string")
    assert sorted(r.row_id for r in curation.curate(df).collect()) == [2, 3]


def test_class_floor(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 4 + [(None,)] * 9, "y string").withColumn("row_id", F.monotonically_increasing_id())
    assert {r.y for r in curation.class_floor(df, "y", 5).collect()} == {"a"}
    assert {(r.y, r.n, r.dropped) for r in curation.class_sizes(df, "y", 5).collect()} == {("a", 5, False), ("b", 4, True)}


def test_text_label_is_never_a_guess(spark):
    rows = [
        ("hybrid schedule, some on-site days", "", None),
        ("hybrid schedule", "Remote", "Hybrid"),
        ("nothing said", "Remote", "Remote"),
        ("nothing said", "", None),
        ("fully remote, no remote interviews", "", None),
        ("3 days in the office", "", "Hybrid"),
    ]
    df = spark.createDataFrame([("", d, f) for d, f, _ in rows], "title string, description string, remote_type string")
    assert [r.remote_label for r in with_training_label(df).collect()] == [want for *_, want in rows]


def test_fill_rates_report_empty(spark):
    df = spark.createDataFrame([("x",), (" ",), (None,), ("x",), ("y",)], "c string")
    got = {r.value: (r.n, r.filled, r.rows, r["rank"]) for r in labels.fill_rates(df, ["c"]).collect()}
    assert got == {"(empty)": (2, 3, 5, 1), "x": (2, 3, 5, 2), "y": (1, 3, 5, 3)}

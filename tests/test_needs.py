"""The plain strings looked for first never hide a match of the pattern behind them."""

from __future__ import annotations

import pytest

from sortlane.functions.regex import matches, with_long_text
from sortlane.rules import audit, columns, remote
from pyspark.sql import functions as F

PHRASES = """per diem|perdiem|per  diem|prn|travel nurse|travel  therapist|13-week travel contract|2 week assignment
8  week position|locum tenens|locumtenen|cdd|contrat a duree determin|contrat  durxe detxrmin|no experience|no prior experience needed
entry-level|entry level|entrylevel|will train|no degree required|beginner welcome|beginners welcome|fully remote|fully-remote
100% remote|100%  remote|work from home|work  from  home|wfh|remote position|remote role|work remotely|remote-first|telecommuting
telecommute|from the comfort of your home|distributed team|distributed  team|hybrid|hybrid schedule|3 days in the office|2 day at office
partially remote|split between home and office|on-site|onsite|on site|in-office|in office|office-based|office based|in person
must be located in|must be based at|no remote|not a remote|full-time|full time|part-time|part time|contract|contractor|intern|internship
temporary|temp role|we are|you will|apply|benefits|401k|salary|equal opportunity|join our|temp|remote|home|week|travel|prnx|uhybrid""".replace("\n", "|").split("|")

RULES = (
    [
        (columns.PER_DIEM, columns.PER_DIEM_NEEDS),
        (columns.TRAVEL_CONTRACT, columns.TRAVEL_CONTRACT_NEEDS),
        (columns.NO_EXPERIENCE, columns.NO_EXPERIENCE_NEEDS),
        (columns.REMOTE_TEXT, columns.REMOTE_TEXT_NEEDS),
        (columns.HYBRID_TEXT, columns.HYBRID_TEXT_NEEDS),
        (audit.AD_WORDS, audit.AD_WORDS_NEEDS),
        (remote.FILL_REMOTE, remote.FILL_REMOTE_NEEDS),
    ]
    + [(p, n) for (_, p), n in zip(audit.REMOTE, audit.REMOTE_NEEDS, strict=True)]
    + [(p, n) for (_, p), n in zip(audit.JOB_TYPE, audit.JOB_TYPE_NEEDS, strict=True)]
    + [(p, n) for (_, p), n in zip(remote.LABEL_SIGNALS, remote.LABEL_NEEDS, strict=True)]
)


@pytest.fixture(scope="module")
def texts(spark):
    variants = []
    for p in PHRASES:
        odd = p.replace("i", "ı").replace("s", "ſ").replace("k", "K")
        variants += [p, p.upper(), p.title(), odd, p.replace("i", "İ"), f"x, {p}. y", f"é{p}é"]
    return spark.createDataFrame([(v,) for v in variants], "t string").cache()


def test_first_look_never_hides_a_match(texts):
    scoped, full, _ = with_long_text(texts, "x", F.col("t"))
    checks = scoped.select(
        "t",
        *[matches(F.col("x"), p).alias(f"plain{i}") for i, (p, _) in enumerate(RULES)],
        *[full.matches(p, n).alias(f"gated{i}") for i, (p, n) in enumerate(RULES)],
    ).collect()
    found = 0
    for row in checks:
        for i, (pattern, _) in enumerate(RULES):
            assert row[f"plain{i}"] == row[f"gated{i}"], (row.t, pattern)
            found += row[f"plain{i}"]
    assert found > 300

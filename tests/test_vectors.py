"""Vectors as SQL has them, to the last bit."""

from __future__ import annotations

import math

import numpy as np

from sortlane.catalog import QUERIES
from sortlane.catalog.model_queries import letter_encoder
from sortlane.operators import features


def test_a_unit_vector_is_not_cut_to_single_precision(spark):
    """41 of a, 5 of b, ...: 0.25625 is half way between two steps, which single precision misses."""
    texts = ["a" * 3 + "bcd", "a" * 41 + "b" * 5 + "c" * 17 + "zzz", "q"]
    rows = spark.createDataFrame([(str(i), "", t) for i, t in enumerate(texts)], "id string, title string, description string")
    found = {r["id"]: r["embedding"] for r in features.encode(rows, letter_encoder).select("id", "embedding").collect()}
    for i, text in enumerate(texts):
        counts = letter_encoder()(["query: " + " . " + text])[0]
        assert found[str(i)] == (counts / np.sqrt((counts * counts).sum())).tolist()


def test_a_negative_component_that_rounds_to_zero_keeps_its_sign(spark, duck, tmp_path):
    rows = spark.createDataFrame([(1, [1.0, -1e-9, 0.0, 1e-9], 0), (2, [-3.0, 4.0, -1e-5, 0.0], 0)], "vec_id long, embedding array<float>, label int")
    rows.write.parquet(f"{tmp_path}/embeddings.parquet")
    run = QUERIES["f6_l2_normalise"]
    sign = lambda unit: [(x, math.copysign(1, x)) for x in unit]
    found = {r["vec_id"]: sign(r["unit"]) for r in run.run(spark, str(tmp_path)).collect()}
    sql = run.sql.replace("FROM embeddings", f"FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert found == {k: sign(unit) for k, unit in duck.execute(sql).fetchall()}
    assert found[1][1] == (0.0, -1.0) and found[1][3] == (0.0, 1.0)

"""Time the headline queries: one JSON line on standard output.

Every query runs over the whole tables of $BENCH_SF_DIR and is read to its end by a no-op
sink. The first run warms the JVM up; the better of two further runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "t3_join_key",
    "t5_model_text",
    "t8_non_english",
    "k7_keyword_merge",
    "k_role_by_industry",
    "g4_title_rules",
    "g13_column_rules",
    "a7_coverage_report",
    "l1_unanimous_labels",
    "l2_join_conflicts",
    "j1_recover_labels",
    "j4_apply_updates",
    "l11_cap_per_group",
    "l12_column_coverage",
    "u2_fill_remote_mode",
    "u5_daily_run",
    "u4_drain",
    "f1_vocabulary",
    "f2_tfidf_long",
    "e7_gate_curve",
    "e10_summary_table",
    "p1_predict_batch",
]
# Fitting the heads once is timed on its own; prediction then reads them back.
FIT = "fit_heads"


def main() -> None:
    from sortlane.catalog import QUERIES, model_queries
    from sortlane.session import build_session

    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    times: dict[str, float] = {}

    def timed(action) -> float:
        start = time.perf_counter()
        action()
        return time.perf_counter() - start

    for name in chosen:
        run = QUERIES[name].run
        if name.startswith("p1"):
            times[FIT] = round(timed(lambda: model_queries.stored_heads(spark, FOLDER)), 3)
            print(FIT, times[FIT], file=sys.stderr, flush=True)

        def once(run=run):
            run(spark, FOLDER).write.format("noop").mode("overwrite").save()

        once()
        times[name] = round(min(timed(once) for _ in range(2)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    rates = {
        name: round(documents / times[name], 1)
        for name in ("k7_keyword_merge", "g13_column_rules", "u5_daily_run", "p1_predict_batch")
        if name in times
    }
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows_per_second": rates,
                "rows": documents,
                "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

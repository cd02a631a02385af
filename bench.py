"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from corpusloom.catalogue import QUERIES
from corpusloom.workspace import build_session

# One or more queries per part of the library; each is written out in full.
HEADLINES = (
    "x13_feature_frame",
    "r1_redact",
    "l6_top_errors",
    "l5_level_counts",
    "a8_cohens_d",
    "a9_class_separation",
    "a4_describe_line_items",
    "a11_marker_audit",
    "a15_corpus_verdict",
    "a6_duplicate_summary",
    "w1_drop_duplicates_keep_first",
    "t1_dedupe_then_split",
    "p11_clean_listings",
    "t11_transform_test_half",
    "a25_regression_scores",
    "j6_nearest_neighbours",
    "m14_classifier_comparison",
    "m15_regression_comparison",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-", dir="/tmp"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(2):  # the first run also compiles; the second is reported
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(round(time.perf_counter() - start, 3))
        seconds[name] = runs[-1]
        print(name, runs, file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

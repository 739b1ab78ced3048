"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Every query is run to the end on whole
tables, into a sink that discards rows; the better of two runs counts.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from samekin.catalog import queries

HEADLINE = [
    "canonical_transactions",
    "top_blocks_amount",
    "cap_blocks",
    "pairs_deduped",
    "similarity_scores",
    "decisions_behavioral",
    "decision_summary",
    "matched_edges_fast",
    "match_count",
    "components_converged",
    "components_prefix",
    "components_propagated",
    "top_entities",
    "top_entities_propagated",
    "stage_funnel",
]
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("samekin-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    available = queries()
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            started = time.perf_counter()
            available[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()

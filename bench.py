"""Time the queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (threads), BENCH_QUERIES (names, comma
separated; default: the headline queries).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stellwerk.plans.queries import QUERIES
from stellwerk.session import local_session

HEADLINE = (
    "trend_gaps", "trend_monthly", "trend_summary", "unknown_terms", "corpus_profile",
    "match_score", "score_backtest", "content_fingerprint", "cross_source_dups",
    "claim_outcomes", "two_key_dedup", "archive_first_seen", "nearest_day_join", "html_text",
    "work_models", "benefit_tags", "contact_extract", "pay_extract", "feed_normalize",
    "idle_batches", "stream_outcomes", "stream_digests", "tracker_rows", "tracker_merge",
    "tracker_rank", "decision_trace", "salary_lookup",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    # Start the JVM's machinery before the clock runs.
    spark.read.parquet(f"{sf_dir}/documents.parquet").groupBy("lang").count().collect()
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        # Every column of every row is computed; nothing is sent to the driver.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

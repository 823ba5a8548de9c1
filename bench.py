"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the local cores (default 8).
Every query runs BENCH_RUNS times (default 2) and its best time counts. With --duckdb the same
"""

import json
import os
import sys
import time

from forumlake_checks.compare import database
from forumlake_checks.oracle import ORACLE
from forumlake_checks.queries import QUERIES
from forumlake.session import local_session

HEADLINE = [
    "staged_items", "latest_event_per_user", "dim_items", "dim_users", "fct_stories", "fct_stories_joined",
    "daily_story_metrics", "daily_active_authors", "daily_median_score", "story_analytics", "kpi_tiles",
    "activity_trend", "top_domains", "top_stories", "top_authors", "author_scores", "engagement_7d",
    "comment_rate_per_day", "first_comment_distribution", "peak_hours", "comment_velocity", "lifetime_curve",
    "author_cohorts", "author_features", "item_history", "dq_report", "parse_lines", "landing_roundtrip",
    "changed_days", "conversation_threads", "event_threads",
]


def best(run, runs: int) -> float:
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [a for a in sys.argv[1:] if not a.startswith("-")] or HEADLINE
    spark = local_session(cores, shuffle_partitions=cores)
    spark.sparkContext.setLogLevel("OFF")

    def in_spark(name: str):
        return lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {name: best(in_spark(name), runs) for name in names}
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }
    if "--duckdb" in sys.argv:
        con = database(sf_dir)
        con.sql(f"SET threads = {cores}")
        result["duckdb"] = {name: best(lambda: con.sql(ORACLE[name]).arrow().read_all(), runs) for name in names}
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()

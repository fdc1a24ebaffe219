"""Time the queries and print one JSON line.

The headline queries, whose sum is the value, run twice and count the second time.  All others run once, in
order, while BENCH_SECONDS (300) last; those left over are named under "not_run".

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (threads), BENCH_QUERIES (names, comma-separated, instead of the
headline queries and without the others), BENCH_SECONDS.
"""

import json
import os
import time

from lanternstats.queries import QUERIES
from lanternstats.session import build_session

HEADLINE = [
    "tutorial_running_exit", "tutorial_versions", "network_size", "relay_platforms", "total_bandwidth",
    "total_bwhist", "user_stats", "bridge_users", "timing_quartiles", "upsert_actions", "denormalised_mirror",
    "split_documents", "parse_status_entries", "history_pivot", "flag_overlap", "ip_country",
    "archive_completeness", "relink_statuses",
]


def run(spark, name, folder):
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    given = os.environ.get("BENCH_QUERIES")
    names = given.split(",") if given else HEADLINE
    others = [] if given else [q for q in QUERIES if q not in HEADLINE]
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, folder)
        seconds[name] = round(run(spark, name, folder), 3)
    total = round(sum(seconds.values()), 3)
    stop = time.perf_counter() + float(os.environ.get("BENCH_SECONDS", "300"))
    left = []
    for name in others:
        if time.perf_counter() > stop:
            left.append(name)
        else:
            seconds[name] = round(run(spark, name, folder), 3)
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "not_run": left,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

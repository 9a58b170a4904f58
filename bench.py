"""Time the headline queries. Prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from tallyboard.plans import catalog
from tallyboard.session import build_session

HEADLINE = (
    "normalize_messages",
    "classify_usage",
    "classify_url",
    "classify_url_sites",
    "classify_url_sites_join",
    "leaderboard",
    "leaderboard_rank",
    "leaderboard_topk",
    "usage_log_set_category",
    "categorized_find_many",
    "unresolved_keys",
    "stream_end_to_end",
)
RUNS = 3


def timed(query, spark, sf_dir) -> float:
    """Seconds to produce every row, plan building and any inner jobs included."""
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.all_queries()
    # The best run is the one without JIT and worker start-up.
    seconds = {
        name: round(min(timed(queries[name], spark, sf_dir) for _ in range(RUNS)), 3) for name in HEADLINE
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": RUNS,
            }
        )
    )


if __name__ == "__main__":
    main()

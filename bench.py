"""Headline queries on one machine; prints one JSON line.

BENCH_SF_DIR: data folder, BENCH_CPUS: cores. Every query is planned, run and fully
consumed, twice: `queries` and `value` are the second round, `first_round` the first
one, which also pays for compiling the JVM code. Nothing is cached between the rounds.
"""

from __future__ import annotations

import json
import os
import time

from placaflow.session import local_session
from placaflow.standin.catalog import QUERIES

HEADLINE = (
    "active_plates",
    "full_cancellations",
    "partial_cancellations",
    "consolidated_cancellations",
    "delinquent_sets",
    "report_summary",
    "daily_history",
    "units_ranking",
    "top_units_by_client",
    "master_listing",
    "cancelled_plates_by_unit",
    "unit_search",
    "benefit_catalogue",
    "backfill_active",
    "backfill_activated",
    "backfill_cancelled",
    "backfill_cancellations",
    "export_active_day",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cpus, partitions=int(cpus))
    rounds: list[dict[str, float]] = []
    for _ in range(2):
        seconds: dict[str, float] = {}
        for name in HEADLINE:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        rounds.append(seconds)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(rounds[1].values()), 3),
                "unit": "sec",
                "queries": rounds[1],
                "first_round": round(sum(rounds[0].values()), 3),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row computed,
nothing collected), ``$BENCH_RUNS`` times; the median per query is reported.
Prints ONE JSON line. With ``$BENCH_EVENT_LOG`` set to a scratch folder,
Spark's event log is written there, jobs tagged per query;
``scripts/stage_times.py`` summarises it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "zero_date_repair",
    "zero_datetime_repair",
    "typed_projection",
    "cdc_apply",
    "cdc_apply_latest",
    "cdc_apply_latest_hot_key",
    "dedup_by_key",
    "dedup_hot_copies",
    "union_all_chunks",
    "manifest_export",
    "migrate_tables",
    "incremental_cdc_apply",
    "mart_user_information",
    "mart_domestic_settlement",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = max(1, int(os.environ.get("BENCH_RUNS", "3")))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from lakeshift.queries.registry import QUERIES
    from lakeshift.session import local_session

    event_log = os.environ.get("BENCH_EVENT_LOG")  # a scratch folder; see scripts/stage_times.py
    if event_log:
        os.makedirs(event_log, exist_ok=True)
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="lakeshift-bench", event_log_dir=event_log)
    names = only or HEADLINE
    # warm-up: JVM, codegen caches, file listing of every table used
    QUERIES["table_row_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    per_query: dict[str, float] = {}
    spread: dict[str, list[float]] = {}
    for name in names:
        times = []
        spark.sparkContext.setJobGroup(name, name)
        for _ in range(runs):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        per_query[name] = round(statistics.median(times), 3)
        spread[name] = [round(t, 3) for t in times]

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_total_median_sec",
                "value": round(sum(per_query.values()), 3),
                "unit": "sec",
                "queries": per_query,
                "runs": spread,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

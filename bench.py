"""Times the registered queries and prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the cores and BENCH_RUNS the timed
runs per query after one warm-up. A time is the median and covers the whole query, its
own table and file writes included; results go to a sink that discards them.
``rollups_of_stored_fact`` reads a fact stored beforehand, as the mart's users do.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerloom import (  # noqa: E402
    build_mart,
    build_session,
    profit_by_customer,
    profit_by_customer_and_year,
    profit_by_year,
    profit_by_year_and_category,
)
from ledgerloom.paths import clear_scratch, work_dir  # noqa: E402
from trial.suite import QUERIES, stored_order_fact, write_source_files  # noqa: E402


def discard(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_seconds(run, runs: int) -> float:
    run()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = sys.argv[1:]
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            # The order lines are one Parquet row group, so one task reads them. Shuffling
            # their join with the orders, as it would be at scale, puts all cores to work.
            "spark.sql.autoBroadcastJoinThreshold": "1MB",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    timed = {name: (lambda q=query: discard(q(spark, sf_dir))) for name, query in QUERIES.items()}

    if not only or "rollups_of_stored_fact" in only:
        fact = stored_order_fact(spark, sf_dir)

        def rollups() -> None:
            discard(profit_by_year(fact))
            discard(profit_by_year_and_category(fact))
            discard(profit_by_customer(fact))
            discard(profit_by_customer_and_year(fact))

        timed["rollups_of_stored_fact"] = rollups

    if not only or "build_mart" in only:
        data_dir = work_dir(spark, "bench")
        write_source_files(spark, sf_dir, data_dir)
        timed["build_mart"] = lambda: build_mart(spark, data_dir)

    seconds = {
        name: median_seconds(run, runs) for name, run in timed.items() if not only or name in only
    }
    print(
        json.dumps(
            {
                "metric": "total of query medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()

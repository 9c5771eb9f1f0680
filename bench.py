"""Times the headline queries and prints one JSON line.

Every query runs ``BENCH_PASSES`` times, plan building and staging included,
into a sink that takes all rows and keeps none. ``queries`` holds the best pass,
``first`` the first one, which also compiles the plan's code.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from daygrid.workload.adapter import close_calendars
from daygrid.workload.queries import REGISTRY

HEADLINE = [
    "items_officer_join",
    "items_rule_match",
    "items_rule_match_distinct",
    "item_labels",
    "special_days",
    "calendar_items",
    "calendar_items_one_year",
    "week_slots",
    "date_spine",
    "slot_aligned",
    "slotted_all",
    "week_of_year_orders",
    "abbreviate_text",
    "abbreviate_documents",
    "item_colors",
    "unknown_colors",
    "month_titles",
    "month_day_grid",
    "day_positions",
    "month_item_grid",
    "span_runs",
    "compacted_cells",
    "final_grid",
    "csv_sessions",
    "csv_rejects",
]


def session(cpus: int, scratch: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Partitions of a small local run are below the default minimum of 1 MB,
        # and merging them would leave cores idle.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        # The queries compile more than the default of 100 code stages; evicted ones
        # would be compiled and warmed up again in every pass.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        # Call sites in error messages cost several calls to the JVM per expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", scratch)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    passes = int(os.environ.get("BENCH_PASSES", "3"))
    with tempfile.TemporaryDirectory(prefix="bench-") as scratch:
        spark = session(cpus, scratch)
        times: dict[str, list[float]] = {name: [] for name in HEADLINE}
        for _ in range(passes):
            for name in HEADLINE:
                start = time.perf_counter()
                frame = REGISTRY[name](spark, sf_dir)
                frame.write.format("noop").mode("overwrite").save()
                times[name].append(time.perf_counter() - start)
                close_calendars(spark)
        spark.stop()
    best = {name: round(min(t), 3) for name, t in times.items()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "first": {name: round(t[0], 3) for name, t in times.items()},
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()

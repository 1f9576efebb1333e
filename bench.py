"""Headline timings on one machine: prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores. Every
timing is the median of three runs after one warm-up; data a query only reads is loaded
before its clock starts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import catalog  # noqa: E402
from catalog.registry import new_dataset, read  # noqa: E402
from lodeworks import LoadSpec, export_batches, load, number_batches, verified_read, with_layout  # noqa: E402
from lodeworks.plans import files as fs  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("lodeworks-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    return spark


def timed(action, prepare=None) -> float:
    """Median of the runs; each works on what ``prepare`` makes for it before its clock starts."""
    taken = []
    for _ in range(RUNS + 1):
        given = [prepare()] if prepare else []
        start = time.perf_counter()
        action(*given)
        taken.append(time.perf_counter() - start)
    return round(statistics.median(taken[1:]), 4)


def run(frame) -> None:
    """Compute every row and keep none."""
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    queries: dict[str, float] = {}
    throughput: dict[str, float] = {}

    lineitem = read(spark, FOLDER, "lineitem")
    events = read(spark, FOLDER, "events")
    total = lineitem.count()
    stored = new_dataset(spark)
    load(stored, LoadSpec("lineitem", lineitem, write_disposition="replace"))
    load(stored, LoadSpec("rows_50k", lineitem.limit(50_000), write_disposition="replace"))
    load(stored, LoadSpec("rows_10k", lineitem.limit(10_000), write_disposition="replace"))

    def keep(name: str, action, rows: int | None = None, prepare=None) -> None:
        queries[name] = timed(action, prepare)
        if rows:
            throughput[name] = round(rows / queries[name])

    def fresh(name: str) -> str:
        return f"{fs.shared_folder(spark)}/{name}"

    # the published figures of the baseline
    keep("verified_read_10k", lambda: verified_read(stored, "rows_10k", fresh("copy"), 50_000), 10_000)
    keep("verified_read_50k", lambda: verified_read(stored, "rows_50k", fresh("copy"), 50_000), 50_000)
    keep("verified_read_lineitem", lambda: verified_read(stored, "lineitem", fresh("copy"), 50_000), total)
    # reads
    keep("table_scan", lambda: run(stored.table("lineitem")), total)
    keep("export_batches", lambda: export_batches(stored.table("lineitem"), fresh("out"), 50_000).count(), total)
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    keep("number_batches", lambda: run(number_batches(stored.table("lineitem"), order, 25_000)), total)
    # loads
    keep("load_replace", lambda: load(new_dataset(spark), LoadSpec("l", lineitem, write_disposition="replace")), total)

    def seeded(**layout):
        dataset = new_dataset(spark)
        spec = LoadSpec("e", events, write_disposition="upsert", primary_key="event_id")
        load(dataset, with_layout(spec, **layout) if layout else spec)
        return dataset

    n_events = events.count()
    shifted = events.withColumns({"event_id": F.col("event_id") + n_events // 2, "value": F.col("value") + 1})
    flagged = shifted.withColumn("gone", F.col("event_type") == "error")
    upsert = LoadSpec("e", shifted, write_disposition="upsert", primary_key="event_id")
    delete = LoadSpec("e", flagged, write_disposition="merge", primary_key="event_id", columns={"gone": {"hard_delete": True}})
    insert = LoadSpec("e", shifted, write_disposition="insert-only", primary_key="event_id")
    late = shifted.where("ts >= timestamp_ntz'2024-01-29 00:00:00'").withColumn("event_id", F.col("event_id") - n_events // 2)
    recent = LoadSpec("e", late, write_disposition="upsert", primary_key="event_id")
    # a table of its own for every run: what an earlier run stored would change the work
    keep("load_upsert", lambda base: load(base, upsert), n_events, seeded)
    keep("load_hard_delete", lambda base: load(base, delete), n_events, seeded)
    keep("load_insert_only", lambda base: load(base, insert), n_events, seeded)
    keep("load_upsert_recent_days", lambda base: load(base, recent), None, lambda: seeded(partition_by=[("ts", "day")]))
    # plans without storage
    for name in (
        "upsert_single_key",
        "upsert_last_wins",
        "package_fold",
        "insert_only_package",
        "hard_delete_non_bool",
        "update_only",
        "latest_state",
        "prune_state",
        "monthly_wide",
        "unpivot_long",
        "timing_summary",
        "flatten_struct",
    ):
        keep(name, lambda name=name: run(catalog.QUERIES[name](spark, FOLDER)))

    line = {
        "metric": "total time of the headline queries",
        "value": round(sum(queries.values()), 4),
        "unit": "sec",
        "queries": queries,
        "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
        "rows_per_sec": throughput,
        "cpus": int(CPUS),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()

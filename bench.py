"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR picks the data, BENCH_CPUS the cores, BENCH_RUNS the timed runs per query (after one
untimed run; the long ones are timed once). Nested alert records and landing files are written before
the clock starts; what is timed reads stored tables, and its result is materialised in full.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from novalake.fixtures import alerts, listed_alerts
from novalake.operators.dedupe import latest_per_key
from novalake.plans import silver
from novalake.plans.refresh import backfill
from novalake.plans.silver import BATCH
from novalake.queries import all_queries
from novalake.session import build_session, new_stage_path
from novalake.sources.landing import read_landing, write_landing

REGISTERED = ["anti_join_history", "merge_upsert", "upsert_moves_rows", "split_payload", "checksum_verify",
              "landing_partition_scan", "landing_ingest", "bronze_append", "clustered_write"]

# Many jobs each: timed once, without a run before.
LONG = ("upsert_moves_rows", "landing_ingest", "lake_backfill")


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed_steps(spark: SparkSession, sf_dir: str, cpus: int) -> dict:
    """Name to a function without arguments; each run of it does the whole work."""
    nested, landed = new_stage_path(spark, "nested"), new_stage_path(spark, "landing")
    alerts(spark, sf_dir).repartition(cpus).write.partitionBy("observation_date").parquet(nested)
    bronze = spark.read.parquet(nested)
    listed = listed_alerts(spark, sf_dir)
    write_landing(listed, landed)
    landing = read_landing(spark, landed, "parquet", listed.schema)
    reference = new_stage_path(spark, "reference")
    silver.reference(bronze, BATCH).write.parquet(reference)
    references = spark.read.parquet(reference)

    plans = {
        "crossmatch_gaia": lambda: silver.crossmatch_gaia(bronze, BATCH),
        "crossmatch_ps1": lambda: silver.crossmatch_ps1(bronze, BATCH),
        "crossmatch_ss": lambda: silver.crossmatch_ss(bronze, BATCH),
        "non_detection": lambda: silver.non_detection(bronze, BATCH),
        "reference": lambda: silver.reference(bronze, BATCH),
        "detection": lambda: silver.detection(bronze, references, BATCH),
        "forced_photometry": lambda: silver.forced_photometry(bronze, BATCH),
        "batch_backfill": lambda: latest_per_key(silver.reference(bronze, BATCH), ["objectid", "fid", "rfid"]),
    }
    steps = {name: (lambda plan=plan: noop(plan())) for name, plan in plans.items()}
    queries = all_queries()
    steps |= {name: (lambda name=name: noop(queries[name](spark, sf_dir))) for name in REGISTERED}
    steps["lake_backfill"] = lambda: backfill(
        spark, landing, new_stage_path(spark, "lake"), "2024-01-01", "2024-01-30")
    return steps


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", str(min(8, os.cpu_count() or 1))))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", f"local[{cpus}]", cpus, {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.log.level": "ERROR",
    })
    medians, spread = {}, {}
    for name, step in timed_steps(spark, sf_dir, cpus).items():
        seconds = [0.0]
        if name not in LONG:
            step()
        for _ in range(1 if name in LONG else runs):
            started = time.perf_counter()
            step()
            seconds.append(time.perf_counter() - started)
        medians[name] = round(statistics.median(seconds[1:]), 3)
        spread[name] = round(max(seconds[1:]) - min(seconds[1:]), 3)
    print(json.dumps({
        "metric": "total_median_seconds",
        "value": round(sum(medians.values()), 3),
        "unit": "sec",
        "queries": medians,
        "spread": spread,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

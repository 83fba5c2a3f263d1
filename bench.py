"""Time the headline operators; prints one JSON line.

Results go to a sink that discards them, so every row and column is computed. Time to
build a plan, with the counting jobs that choose its joins, is included.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import Observation, functions as F

from veilspark.session import build_session
from workload import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "hash_persons",
    "match_requested",
    "attach_hash",
    "swap_key_left",
    "apply_rules_suppress",
    "deid_report_by_file",
    "frequency_by_page",
    "frequency_deidentified",
    "summary_eav_original",
    "ordinal_whole_table",
    "upsert",
    "merge_insert_only",
    "rollup_status",
    "pending_batches",
    "summary_variables",
    "check_file_names",
    "read_headered",
    "read_any_layout",
    "read_preamble",
    "read_mixed_encodings",
    "study_summary",
    "summary_job_eav",
)
RUNS = 3
#: A fixed amount of work, so that rounds on different machines can be compared.
CALIBRATION = "sum(hash(id, id % 1000))"


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.log.level": "ERROR",
        },
    )
    spark.read.parquet(f"{SF_DIR}/orders.parquet").groupBy("o_orderstatus").count().collect()
    calibration = float("inf")
    for _ in range(RUNS):
        started = time.perf_counter()
        spark.range(300_000_000, numPartitions=int(CPUS)).selectExpr(CALIBRATION).collect()
        calibration = min(calibration, time.perf_counter() - started)
    seconds: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(RUNS):
            started = time.perf_counter()
            counted = Observation()
            result = QUERIES[name](spark, SF_DIR).observe(counted, F.count(F.lit(1)).alias("rows"))
            result.write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - started)
            rows[name] = counted.get["rows"]
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows": rows,
                "calibration": round(calibration, 3),
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

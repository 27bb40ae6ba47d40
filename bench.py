"""Times the headline queries: prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from termfold.plans.queries import queries
from termfold.sources.sample import Sample

NAMES = ["all_classes", "report_output", "rule_table_apply", "class_micro", "class_chem", "class_drugtox", "class_sero", "class_ua",
         "class_micro_legacy", "class_counts", "report", "molecular_weights", "rule_table"]


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="termfold-bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    times = {}
    start = time.perf_counter()
    sample = Sample(spark, sf_dir)
    for name in ("terms", "detail", "part", "weights", "groupers"):
        getattr(sample, name)
    times["ingest"] = round(time.perf_counter() - start, 3)

    run = queries()
    for name in NAMES:
        seconds = []
        for _ in range(3):
            start = time.perf_counter()
            run[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        times[name] = round(sorted(seconds)[1], 3)
    total = round(sum(v for k, v in times.items() if k != "ingest"), 3)
    print(json.dumps({
        "metric": "headline queries, median of 3, total", "value": total, "unit": "sec", "queries": times,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
    }))


if __name__ == "__main__":
    main()

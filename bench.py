"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of cores.
"""
import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from checks.queries import QUERIES

HEADLINE = ("hits_by_source", "mask_all_default", "mask_pages", "notes_all", "mode_hash", "listed_names",
            "leaf_mask_attributes", "redacted_spans", "redacted_logs", "redacted_view", "trace_unified",
            "trace_unified_tags", "raw_vs_redacted", "raw_vs_redacted_sample", "unredacted_rows",
            "coverage", "leak_scan", "recall_by_category", "retention_plan", "prompt_spans",
            "stream_incremental", "clustered_layout")
RUNS = 2


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "12g")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds = time.perf_counter() - start
            best = seconds if best is None else min(best, seconds)
        times[name] = round(best, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    megabytes = spark.read.parquet(f"{folder}/documents.parquet").agg(
        F.sum(F.octet_length("text"))).first()[0] / 1e6
    spans = spark.read.parquet(f"{folder}/events.parquet").count()
    spark.stop()
    rates = {"documents_mb_per_sec": round(megabytes / times["mask_all_default"], 1),
             "spans_per_sec": round(spans / times["redacted_spans"])}
    print(json.dumps({"metric": "headline queries, best of 2 runs each", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "rates": rates, "sf": os.path.basename(folder).removeprefix("sf"),
                      "cpus": int(cpus)}))


if __name__ == "__main__":
    main()

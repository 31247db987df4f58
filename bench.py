"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from loadlens.plans.queries import QUERIES

HEADLINE = (
    "extract_wide extract_utb_a extract_utb_b vendor_route stops_ranked stops_geo stops_time "
    "broker_contact carrier_email pay_extract dt_combine norm_text emails_joined page_assemble "
    "source_audit missing_loads validate_fields accuracy_rollup error_ledger ruleset_compare"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # start the JVM's query path once, outside the timings
    QUERIES["source_audit"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    found = re.search(r"sf([\d.]+)", sf_dir)
    result = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(found.group(1)) if found else None,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: folder of tables (default /root/testdata/sf0.1); BENCH_CPUS: cores.
One query is run first, untimed, to start the code generator; then each is run
to its last row and timed once.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

HEADLINE = (
    "trades_edges",
    "latest_invoice_dedup",
    "company_merge",
    "hidden_pairs_address",
    "cycles3",
    "cycles5",
    "cycles_scored",
    "invoice_flags",
    "degree_centrality",
    "new_partner_rate",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shared = tempfile.TemporaryDirectory(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", shared.name)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from loopwise.plans.queries import queries

    all_queries = queries()
    all_queries["trades_edges"](spark, sf).write.format("noop").mode("overwrite").save()  # starts the code generator
    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        all_queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
        print(name, seconds[name], file=sys.stderr)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf.rstrip("/").rsplit("/", 1)[-1]}))
    spark.stop()
    shared.cleanup()


if __name__ == "__main__":
    main()

"""Times the headline queries; prints one JSON line.

The logs are written first, outside the timing: BENCH_SF_DIR names the tables (default sf0.1),
BENCH_CPUS the cores (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession, functions as F  # noqa: E402

import logquarry as lq  # noqa: E402
from logquarry.testing.checks import stored, scratch  # noqa: E402
from logquarry.testing.logs import events, evt_logs, evtx_logs  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    table = events(spark, sf_dir)
    evtx_dir = stored(spark, evtx_logs(table, "templated"))
    evt_dir = stored(spark, evt_logs(table))
    record_count = table.count()
    log_bytes = lq.list_logs(spark, evtx_dir).agg(F.sum("length")).first()[0]
    tables = scratch(spark)

    def consume(frame):
        frame.write.format("noop").mode("overwrite").save()

    def scan(folder, **wanted):
        return lq.scan_logs(spark, folder, **wanted)[0]

    def ingest():
        scan(evtx_dir).write.mode("overwrite").parquet(f"{tables}/records")

    def audit():
        consume(lq.audit_stored(lq.read_heads(lq.list_logs(spark, evtx_dir))))

    def collect():
        consume(lq.collect_logs(spark, [evtx_dir], lq.default_catalog(spark), "BENCH-HOST", r"C:\Windows")[0])

    runs = {
        "evtx_decode_ranges": lambda: consume(scan(evtx_dir)),
        "evtx_decode_whole_files": lambda: consume(lq.read_evtx(lq.read_logs(spark, evtx_dir))),
        "evt_decode": lambda: consume(scan(evt_dir)),
        "ingest_to_parquet": ingest,
        "failed_logons_from_logs": lambda: lq.failed_logons_of(spark, evtx_dir).collect(),
        "failed_logons_ingested": lambda: lq.failed_logons(spark.read.parquet(f"{tables}/records")).collect(),
        "channels_from_logs": lambda: lq.channels(scan(evtx_dir, columns=["channel"])).collect(),
        "log_audit": audit,
        "collect_and_enrich": collect,
    }
    first, seconds = {}, {}
    for times in (first, seconds):  # the first round compiles the plans and starts the workers
        for name, run in runs.items():
            started = time.perf_counter()
            run()
            times[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, second run",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_run": first,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
                "records": record_count,
                "evtx_bytes": log_bytes,
                "evtx_records_per_sec": round(record_count / seconds["evtx_decode_ranges"]),
                "evtx_mb_per_sec": round(log_bytes / 1e6 / seconds["evtx_decode_ranges"], 1),
                "evt_records_per_sec": round(record_count / seconds["evt_decode"]),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

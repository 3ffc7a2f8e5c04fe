"""Times the headline queries on one data folder and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_REPEATS
(default 3). A query name given as argument limits the run. Each query runs once
to warm up, then the median of the repeats counts; a query that takes ``LONG`` seconds is
not repeated. Results go to the noop sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kerbside.plans.queries import QUERIES  # noqa: E402
from kerbside.session import build_session  # noqa: E402


LONG = 5.0


def run_once(spark, query, sf_dir: str) -> float:
    begin = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(
        "bench", master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(QUERIES)
    seconds, failed = {}, {}
    for name in names:
        try:
            run_once(spark, QUERIES[name], sf_dir)
            taken = [run_once(spark, QUERIES[name], sf_dir)]
            while len(taken) < repeats and taken[0] < LONG:
                taken.append(run_once(spark, QUERIES[name], sf_dir))
            seconds[name] = round(statistics.median(taken), 3)
        except Exception as error:
            failed[name] = str(error)[:200]
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "rows": rows,
        "cpus": int(cpus),
        "spark": spark.version,
    }
    if "stream_flow_minute" in seconds:
        line["stream_rows_per_sec"] = round(rows / seconds["stream_flow_minute"])
    if failed:
        line["failed"] = failed
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()

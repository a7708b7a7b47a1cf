"""Time every registered question at one scale factor; print one JSON line.

    BENCH_SF_DIR   table folder (default /root/testdata/sf0.1)
    BENCH_CPUS     local worker threads (default 8)
    BENCH_NO_BROADCAST        optional, "1": Spark's static and adaptive broadcast thresholds off,
                   so every join is a sort-merge join, as when no table is small
    BENCH_REPEAT   timed runs per question, the fastest is reported (default 2: the host
                   shares its CPUs, so single runs vary by tens of percent)

Each question is planned and fully executed into Spark's no-op sink (no collect to the driver);
the time covers planning, any eager checkpoint inside the question, and execution.  Session
start-up is excluded.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillwise.catalog import QUERIES  # noqa: E402
from tillwise.session import build_session  # noqa: E402
from tillwise.sources.tables import load_tables  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    scratch = tempfile.mkdtemp(prefix="tillwise-bench-")
    spark = build_session(
        master=f"local[{cpus}]", shuffle_partitions=cpus,
        extra={"spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
               "spark.local.dir": os.path.join(scratch, "local"),
               "spark.driver.memory": "8g"})
    if os.environ.get("BENCH_NO_BROADCAST") == "1":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    tables = load_tables(spark, sf_dir)
    # Warm-up: JIT and Parquet footers, on the flagship question (not timed).
    QUERIES["revenue_by_period"](tables).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name, question in QUERIES.items():
        best = float("inf")
        for _ in range(repeat):
            start = time.perf_counter()
            question(tables).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        timings[name] = round(best, 3)
    spark.stop()
    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_question_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(match.group(1)) if match else sf_dir,
        "cpus": cpus,
        "n_queries": len(timings),
        "repeat": repeat,
        "stat": "min",
        **({"no_broadcast": True} if os.environ.get("BENCH_NO_BROADCAST") == "1" else {}),
    }))


if __name__ == "__main__":
    main()

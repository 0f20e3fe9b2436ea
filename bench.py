"""Time the headline queries; prints one JSON line.

Every query runs from the raw test tables to the last row (noop sink), so the
derivation of the bars is part of each time.  BENCH_SF_DIR and BENCH_CPUS
choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tickloom.session import build_session
from tickloom.workload.queries import QUERIES

HEADLINE = (
    "f1_stage_bars",
    "a1_split_adjust",
    "a2_cumulated_months",
    "a5_classifier",
    "a8_candles_weekly",
    "a12_sector_performance",
    "a19_sma_errors",
    "a21_surprise_return_correlation",
    "c1_grades_mart",
    "q5_outliers",
    "q7_load_gate",
    "q15_fill_calendar",
    "r7_message_rate",
    "r8_velocity",
    "r12_tick_candles",
    "w1_sma",
    "w2_wma",
    "w3_ema",
    "w4_macd",
    "w5_bollinger",
    "w7_ema_signals",
    "w8_ema_signals_weekly",
    "w12_macd_signals_daily",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark_ui_enabled="false",
        spark_sql_shuffle_partitions=cpus,
        spark_driver_memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's compilers and the file cache on something else.
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()

    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()

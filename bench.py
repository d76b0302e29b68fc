"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the folder of sample tables, BENCH_CPUS the local cores, BENCH_RUNS the runs per query (the median
counts). Every result is computed in full and written to the no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import catalog  # noqa: E402
from ripecast.session import build_session  # noqa: E402

HEADLINE = [
    "int_sales",
    "fct_sales_features",
    "features_enriched",
    "features_split",
    "policy_score",
    "policy_choice",
    "policy_eval",
    "kpi_overall",
    "kpi_by_date",
    "kpi_by_expiry",
    "eda_cardinality",
    "dq_report",
    "policy_sweep_model",
    "train_gbt",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "ripecast-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        if name == "train_gbt":
            catalog._MODELS.clear()  # time the fit, not what the session keeps of it
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    wanted = os.environ.get("BENCH_QUERIES")
    seconds = {}
    for name in wanted.split(",") if wanted else HEADLINE:
        run(name)  # warm up code generation
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

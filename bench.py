"""Times the queries and prints one JSON line; its value is the sum over the headline queries.

``BENCH_SF_DIR`` names the folder with the tables, ``BENCH_CPUS`` the number of cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from workload import QUERIES  # noqa: E402

HEADLINE = [
    "sensor_gate_by_field",
    "quarantine_split",
    "score_by_key",
    "tumbling_15min_mean",
    "pivot_field_date",
    "histogram_30",
    "annual_mean_dense",
    "monthly_mean_dense",
    "year_enrichment",
    "year_expansion",
    "soil_mapping",
    "integrate_full",
    "integrate_by_cells",
    "load_by_day",
    "generated_readings",
    "ablation_summary",
    "concepts_per_document",
    "text_scores",
    "application_match",
    "concept_rows",
    "vector_topk",
    "vector_topk_batch",
    "text_embedding_topk",
    "forecast_14d",
    "linear_fit_by_group",
    "leave_one_out_importance",
    "linear_attribution",
    "ks_two_sample",
    "stress_summary",
    "recommendation_rules",
    "stream_gate_15min",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM code paths and the Python workers before the clock runs.
    for name in ("sensor_gate_by_field", "leave_one_out_importance"):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in [*HEADLINE, *(name for name in QUERIES if name not in HEADLINE)]:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds[name] for name in HEADLINE), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()

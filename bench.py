"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from slowtide.catalog import QUERIES
from slowtide.session import build_session

HEADLINE = [
    "wn_full_feature_table",
    "wn_full_feature_table_by_site",
    "ag1_resample_5min",
    "ag1_resample_5min_by_site",
    "ag3_resample_10min_counts",
    "wn2_delay_count_features",
    "wn8_fill_then_median",
    "wn11_sequences",
    "jn1_asof_nearest_5s",
    "jn2_asof_nearest",
    "jn2_asof_nearest_by_site",
    "jn2_asof_many_equal_times",
    "set2_union_strict_schema",
    "set4_union_all_columns",
    "ud1_request_enrichment",
    "ag11_quantiles",
    "ag16_box_response_by_delay",
    "ag17_histogram_response_time",
    "ag18_density_two_sources",
    "ml1_window_scaler",
    "ev3_class_report",
    "ev4_precision_recall_curve",
    "ev5_best_f1_threshold",
    "ev7_calibration",
    "qc1_validate",
    "qc2_clean",
    "qc3_data_health",
    "qc4_prediction_activity",
    "qc9_health_report",
]


def run(spark, name: str, sf_dir: str) -> float:
    """Seconds to build the query and produce every row and column of it."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    for name in HEADLINE[:3]:
        run(spark, name, sf_dir)
    queries = {}
    for name in HEADLINE:
        queries[name] = round(sorted(run(spark, name, sf_dir) for _ in range(repeats))[repeats // 2], 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()

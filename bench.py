"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flowloom.catalog import QUERIES  # noqa: E402
from flowloom.session import build_session  # noqa: E402

HEADLINE = [
    "A1_read_flows", "A7_read_eve", "B2_normalize_label", "B3_canonical_attack", "B4_inf_to_null",
    "C5_new_only", "C6_with_weight", "D5_quality_table", "D6_duplicate_count", "D7_class_distribution",
    "D10_quality_report", "D13_variable_profile", "D14_describe", "D15_corr_with_target", "D16_corr_matrix",
    "D19_iqr_outliers", "D21_outliers_by_group", "D28_weighted_count", "D30_global_risk", "D32_threat_split",
    "D33_time_series", "D39_user_counters", "D41_failure_bursts", "E3_latest_n", "E4_with_position", "E5_sample_n",
    "E8_stratified_split", "E10_stratified_folds", "E12_priority_queue", "F2_dedup", "F4_dedup_batch",
    "H1_rule_class", "H5_normalize_alerts", "I3_median_imputer", "I10_minmax", "I11_decision_tree",
    "I15_gaussian_nb", "I17_class_report", "J4_exactly_once", "J7_burst_stream",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", "flowloom-bench", spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["D7_class_distribution"](spark, sf).collect()  # start the JVM and the file cache once
    timings = {}
    for name in HEADLINE:
        start = time.perf_counter()
        # the noop sink runs the whole plan without bringing rows to the driver
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": timings, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()

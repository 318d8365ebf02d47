"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names, or 'all' (default: the headline set)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.catalog import QUERIES  # noqa: E402
from millrace.session import local_session  # noqa: E402

# One or more per group of operators, on the larger tables.
HEADLINE = [
    "univariate", "quality_profile", "dedup_full", "dedup_keep_first", "numeric_summary", "top_categories",
    "outliers_iqr", "outliers_events", "column_roles_orders", "quality_delta", "problem_type", "detect_types",
    "correct_types", "exclude_columns", "encode_target", "one_hot", "scale_standard", "business_rules_flag",
    "impute_missing", "corr_pairs", "corr_matrix", "cat_num_stats", "crosstab", "contingency_cells",
    "cramers_v_lineitem", "mutual_info", "welch_ttest", "anova", "class_balance", "chi2_independence",
    "leakage_report", "pearson_pvalue", "quartile_means", "class_means", "category_rates", "evidence_table",
    "high_corr_drop", "feature_selection", "train_test_rows", "clf_metrics_multi", "reg_metrics",
    "linear_baseline", "perm_importance", "forest_classifier", "chart_histogram", "chart_scatter_grid",
    "chart_line_day", "chart_batch", "run_log_latest", "clean_readable", "clean_pipeline", "profile_pipeline",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else [n for n in asked.split(",") if n] or HEADLINE
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's compiler, the file readers and the Python workers on
    # small tables before the clock runs.
    for name in ("load_preview", "column_roles_labels", "chi2_labels"):
        QUERIES[name](spark, sf_dir).collect()
    seconds: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

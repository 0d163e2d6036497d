"""Seconds per headline query; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores (default 8).
"""

from __future__ import annotations

import json
import os
import time

from panelcast.plans import catalog
from panelcast.session import local_session

HEADLINE = [
    "a1_daily_rollup", "a8_oil_correlation", "a9_clip_outliers", "a18_median", "j8_assign_folds",
    "w2_rolling_mean", "w4_make_sequences", "w5_interpolate", "w7_validation_cut", "f1_fit_label_text",
    "f4_impute_median", "m1_linear_oof", "m2_grouped_ols_all_features", "m3_promo_what_if_all_features",
    "m5_grouped_lasso", "m10_boosted_oof", "m12_seasonal_arx", "m13_additive_forecast",
    "m15_quantile_forecast", "m17_contribution_summary", "r1_linear_family_report",
    "r4_boosted_fold_report", "r7_forest_complete_report", "r11_additive_report", "r15_model_comparison",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "panelcast-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up of the session and its Python workers is not part of any query.
    catalog.QUERIES["a18_fit_stats"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    catalog.QUERIES["m2_grouped_ols_one_feature"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) is the data folder, BENCH_CPUS (default 8) the local
cores, BENCH_RUNS (default 1) the timed runs per query, of which the median counts, and
BENCH_QUERIES a comma list of names, or "all".
"""

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brightledger.plans.catalog import all_queries  # noqa: E402
from brightledger.session import build_session  # noqa: E402

HEADLINE = [
    "a1_category_commission", "a4_customer_totals", "a17_describe", "a25_box_plot", "a37_dashboards",
    "p18_rule_codes", "p21_box_features", "j1_inner_join", "j1_row_level_join", "j5_interval_pairs", "j10_trailing_day_mean",
    "j11_dense_id_mapping", "j13_best_overlap", "j14_greedy_matching", "w1_rank_ties_kept", "w2_trailing_row_mean", "w4_lookback_windows",
    "w11_row_names", "st8_unified_alerts", "st8_stream_alerts", "st9_stream_commission", "q5_equal_variances", "q9_correlation_matrix",
    "e3_class_report", "e4_roc_area", "x3_clean", "x11_top_ngrams", "x14_vector_search", "x15_keyword_search",
    "g2_pagerank", "g5_bias_baseline", "k3_event_density_clusters", "l11_regressors", "l22_self_training",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-bench-", dir="/tmp")})
    spark.sparkContext.setLogLevel("OFF")
    every = all_queries()
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(every) if asked == "all" else asked.split(",") if asked else HEADLINE
    every["a10_frequency"](spark, folder).write.format("noop").mode("overwrite").save()  # start-up is not timed
    times = {}
    for name in names:
        seconds = []
        for _ in range(runs):
            start = time.perf_counter()
            every[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        times[name] = round(statistics.median(seconds), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(folder)}))


main()

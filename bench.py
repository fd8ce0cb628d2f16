"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local cores.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalogue import QUERIES
from parcelry.session import build_session

HEADLINE = [
    "a6_unit_price_by_nation", "a1_group_range", "a3_group_median", "a8_describe", "a14_correlations", "a16_box_stats", "a17_histogram", "a20_density",
    "j1_join_views", "j4_translate", "w1_top_k", "p9_quantile_caps", "x10_title_floors", "x13_price", "x6_age_hours", "f1_chained_steps", "f2_iqr_filter",
    "f4_label_codes", "f5_one_hot", "f6_target_codes", "f9_robust_scale", "f11_box_cox_fit", "f13_mice", "e1_collapse_rare", "e6_cyclic_dates",
    "t3_word_counts", "t4_bigrams", "m1_least_squares", "m4_elastic_net_search", "m12_residual_boxes", "m13_bootstrap_interval", "r2_window_counts",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", master=f"local[{cpus}]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g", "spark.sql.shuffle.partitions": cpus}
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start-up is not a query
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()

"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS], the median of RUNS runs each; prints one JSON line."""

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["star_join", "antagonist", "best_row_per_key", "category_counts", "complexity_index",
            "any_flag", "conditional_impute", "column_profile", "not_reported", "crosstab_norm", "chi2_cramers_v",
            "corr_matrix", "undersample", "stratified_folds", "class_report", "kappa", "pr_curve", "threshold_grid",
            "cluster_lift", "kproto_assign", "risk_label", "what_if", "accident_table"]

RUNS = 3


def main():
    from pyspark.sql import SparkSession

    from kerbside.catalogue import registry
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "16g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_returnflag").count().collect()   # warm up
    queries, times = registry.queries(), {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            queries[name](spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(median(runs), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()

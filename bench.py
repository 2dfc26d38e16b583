"""Time the headline queries; prints one JSON line.

Settings: BENCH_SF_DIR (tables, default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list).
Every query is run once in full and its rows are counted through a no-op write, after a warm-up of the session.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "daily_rollup", "station_ranking", "season_ratio", "exceed_share", "city_month_features", "landed_latest",
    "ztest_segments", "aa_replay", "mann_whitney_season", "wilcoxon_months", "heading_chunks", "term_stats",
    "bm25_topk", "tfidf_cosine_topk", "hybrid_topk", "stratified_folds", "knn_cv_accuracy", "significance_tests", "knn_learning_curve", "dq_report",
    "bm25_stored", "store_latest", "linear_scores", "bench_table"]


def main() -> None:
    from pyspark.sql import SparkSession

    from fathomline.plans import registry

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/nation.parquet").groupBy("n_regionkey").count().collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
        spark.catalog.clearCache()
    scale = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(scale.group(1)) if scale else None}))
    spark.stop()


if __name__ == "__main__":
    main()

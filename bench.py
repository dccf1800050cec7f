"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Each query is run once to warm up the JVM and once for the clock; its rows go to the no-op sink.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from shelfwise.plans.catalog import QUERIES
from shelfwise.session import local_session

HEADLINE = [
    "interactions", "copurchase_top10", "group_stats", "topk_per_group", "id_mapping", "user_item_sets", "user_item_pivot",
    "similar_users", "cross_target", "item_item_cosine", "rec_neighbourhood", "rec_content_top5", "product_features",
    "tokenize", "ngrams", "tfidf", "telemetry_parse", "pearson", "linreg", "naive_bayes", "rf_classify", "kmeans",
    "item_neighbours",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    shared = tempfile.mkdtemp(prefix="shelfwise-bench-")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "shelfwise-bench", spark__checkpoint__dir=shared)
    seconds = {}
    for name in HEADLINE:
        run(spark, name, folder)
        seconds[name] = round(run(spark, name, folder), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()

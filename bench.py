"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores.  Each query is fully computed
and its rows are thrown away.  ``python bench.py name ...`` times only those queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "top_items_per_customer", "star_enrich", "candidates_any_key", "popularity_fallback", "prefix_match", "missing_assets",
    "encode_vocab", "tag_summary", "user_skill", "standardize", "dedup_first", "cumulative_share", "roulette_sample",
    "top_n_per_user", "tour_length", "writer_counts", "tenure", "html_text", "exam_items", "sparse_features", "song_features",
    "content_match", "affinity_pairs", "blend_baseline", "factor_epoch", "adaline_epochs", "ranking_metrics",
    "item_similarity", "svd_recommend",
]


def main() -> None:
    from riffle.queries import QUERIES
    from riffle.session import local_session

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("riffle-bench", cores=cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        at = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - at, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times, "sf": sf.rstrip("/").split("sf")[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()

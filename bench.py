"""Headline queries, warm: prints one JSON line. BENCH_SF_DIR names the data, BENCH_CPUS the local cores."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from topicloom.checks.registry import QUERIES  # noqa: E402
from topicloom.session import build_session  # noqa: E402

HEADLINE = [
    "growth_ranking",
    "topic_growth",
    "monthly_series",
    "keyword_growth",
    "growth_review",
    "top_posts_by_score",
    "scan_parquet_pruned",
    "validation_metrics",
    "stringify_extras",
    "scored_examples",
    "excerpts",
    "reply_values",
    "parsed_keywords",
    "label_review",
    "topic_terms",
    "embed_with_user_model",
    "hashed_embeddings",
    "topic_centroids",
    "top_n_topics",
    "central_examples",
    "assigned_anchors",
    "compare_clusterings",
    "combined_runs",
    "nearest_neighbors",
    "density_labels",
]
# Iterative jobs, timed once each.
SLOW = ["two_stage_clusters", "tuning_grid", "refined_by_merges", "louvain_communities"]
WARM_RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def timed(spark, name: str, folder: str) -> float:
    start = time.monotonic()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.monotonic() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        timed(spark, name, folder)
        seconds[name] = round(statistics.median(timed(spark, name, folder) for _ in range(WARM_RUNS)), 3)
    for name in SLOW:
        seconds[name] = round(timed(spark, name, folder), 3)
    posts = spark.read.parquet(f"{folder}/documents.parquet").count()
    result = {
        "metric": "total_warm_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "hashed_posts_per_second": round(posts / seconds["hashed_embeddings"], 1),
        "cpus": cpus,
        "spark": spark.version,
        "runs": f"median of {WARM_RUNS} after one warm-up ({', '.join(SLOW)}: one run), nothing cached",
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()

"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS], as one JSON line.

Offline providers stand in for remote services, so the numbers hold no waiting
time of others. ``--all`` times every catalogued query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.queries import QUERIES
from shelfmark.session import local_session

HEADLINE = [
    "knn_batch", "knn_blocks", "knn_single", "candidate_letters", "candidate_lists", "tree_flatten",
    "lookup_build", "row_text", "row_embedding", "vector_parse", "prompt_batches", "prompt_text",
    "answers", "choice_join", "keyed_update", "category_counts", "job_build", "job_embed", "job_classify",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sorted(QUERIES) if "--all" in sys.argv else HEADLINE
    spark = local_session(cores, int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM code paths and the Python workers before the clock runs.
    spark.read.parquet(f"{folder}/part.parquet").selectExpr("count(*)").collect()
    QUERIES["knn_batch"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

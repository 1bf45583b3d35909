"""Headline queries, timed to the last row; prints one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from lectern.session import local_session  # noqa: E402

HEADLINES = [
    "normalize_text",
    "dedup_exact",
    "documents_to_chunks",
    "chunk_fixed",
    "chunk_sentence",
    "chunk_enrich",
    "term_frequency",
    "idf",
    "tfidf_vectors",
    "tfidf_topk",
    "tfidf_index_topk",
    "embed_hashed",
    "embedding_index",
    "knn_flat",
    "knn_prefilter",
    "knn_ivf",
    "knn_lsh",
    "batch_retrieve",
    "format_prompt",
    "metrics_row",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cpus, shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/documents.parquet").count()  # start-up is not what is measured
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

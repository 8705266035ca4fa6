"""Time the headline queries; prints one JSON line.

Each query runs in full into Spark's no-op sink, so every column of every row is
computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpusmill.plans.queries import QUERIES  # noqa: E402
from corpusmill.session import local_session  # noqa: E402

HEADLINE = (
    "dataset_text_scan",
    "quota_prefix",
    "shard_assign",
    "shard_stats",
    "shard_write",
    "assemble_documents",
    "text_file_documents",
    "normalize_text",
    "min_chars_filter",
    "pretoken_counts",
    "token_counts",
    "corpus_encode",
    "pack_blocks",
    "weighted_perplexity",
    "apply_status",
    "lifecycle_audit",
    "run_manifest",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, "corpusmill-bench")
    # Start the Python workers before the clock.
    spark.range(cores).mapInPandas(lambda parts: parts, "id long").count()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cores,
            }
        )
    )


if __name__ == "__main__":
    main()

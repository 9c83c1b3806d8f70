"""Time the headline queries; print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Every result is
computed in full into a no-op sink. Each query runs twice, the faster run
counts, so the figures leave out JVM warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pressmill.plans.catalog import QUERIES, document_vectors  # noqa: E402
from pressmill.session import build_session  # noqa: E402

HEADLINE = [
    "normalize_documents",
    "chunk_documents",
    "chunk_overlap",
    "clean_pages",
    "validate_accepted",
    "validate_rejects",
    "parse_rss",
    "dedup_url",
    "language_detected",
    "hash_embedding",
    "index_documents",
    "upsert_replace_url",
    "retrieve_benchmark",
    "retrieve_turns",
    "topk_cosine",
    "stub_answers",
    "stream_ingest",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        if name.startswith(("retrieve", "stub")):
            document_vectors(spark, folder)  # stored once; its cost is index_documents
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()

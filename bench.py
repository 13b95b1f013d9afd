"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the local cores. Every query
runs in full (all rows and columns, sink without output) and the best of three
runs counts. Rates are rows of the named unit per second.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from passagework.plans.inputs import Tables  # noqa: E402
from passagework.plans.queries import QUERIES  # noqa: E402
from passagework.session import build_session  # noqa: E402

HEADLINE = (
    "sections",
    "chunk_windows",
    "html_text",
    "message_validation",
    "latest_filing_rows",
    "hashed_embedding",
    "knn_topk",
    "knn_topk_blocks",
    "ann_ivf",
    "retrieve_text",
    "upsert_merge",
    "upsert_table",
    "stream_ingest",
)


def run(name: str, spark, folder: str, repeats: int) -> float:
    best = float("inf")
    for _ in range(repeats):
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return best


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cores}]", cores)
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, folder)
    seconds = {name: round(run(name, spark, folder, repeats), 3) for name in names}

    documents = tables.documents.count()
    units = {
        "sections": ("documents", documents),
        "chunk_windows": ("documents", documents),
        "html_text": ("pages", tables.pages.count()),
        "message_validation": ("messages", tables.events.count()),
        "hashed_embedding": ("documents", documents),
        "knn_topk": ("questions", tables.vector_questions().count()),
        "knn_topk_blocks": ("questions", tables.vector_questions().count()),
        "ann_ivf": ("questions", tables.vector_questions().count()),
        "upsert_table": ("records", documents + 2 * tables.labels.count()),
        "stream_ingest": ("messages", documents),
    }
    rates = {
        name: {"unit": f"{unit}/s", "value": round(count / seconds[name], 1)}
        for name, (unit, count) in units.items()
        if name in seconds
    }
    result = {
        "metric": "headline queries, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rates": rates,
        "sf": os.path.basename(os.path.normpath(folder)).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()

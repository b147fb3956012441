"""Time the headline queries and print one JSON line.

Every query runs in full and its rows go to a sink that drops them. The better of two runs counts, so that loading classes
and compiling code are not part of it.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
# Python workers find the package wherever the bench is started.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

from passtrail.plans.queries import QUERIES  # noqa: E402
from passtrail.session import build_session  # noqa: E402

HEADLINE = (
    "corpus_rows", "segment_rows", "segment_stream", "segment_provenance", "hash_chain", "dedup_latest", "size_report",
    "dialect_frequency", "manifest_roundtrip", "parent_links", "run_status", "failure_modes", "first_error",
    "failure_excerpt", "select_source_file", "functions", "pack_signal", "prompts",
)


def run(spark, base: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, base).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in HEADLINE:
        times[name] = round(min(run(spark, base, name) for _ in range(2)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(base.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

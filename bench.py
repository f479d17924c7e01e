"""Time the named queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (folder of the tables), ``BENCH_CPUS`` (threads),
``BENCH_QUERIES`` (comma-separated names; all when empty).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from review_engine.plans import registry  # noqa: E402
from review_engine.session import local_session  # noqa: E402


def run(frame) -> None:
    """Compute every row and column without keeping them."""
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    chosen = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]
    runs = registry.runs()
    spark.range(1000).selectExpr("sum(id)").collect()

    seconds, failed = {}, {}
    for name in chosen or runs:
        start = time.perf_counter()
        try:
            run(runs[name](spark, folder))
            seconds[name] = round(time.perf_counter() - start, 3)
        except Exception as error:
            failed[name] = str(error).splitlines()[0][:200]
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    if failed:
        result["failed"] = failed
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()

"""Time the headline queries.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints one JSON
line. Each query is planned and run in full; its rows go to Spark's no-op sink. A first pass that is
not timed lets the JVM compile; the second one counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyfolio.catalog.queries import all_queries  # noqa: E402
from tallyfolio.session import build_session  # noqa: E402

HEADLINE = [
    "fund_returns",
    "all_fund_returns",
    "fund_returns_incremental",
    "holding_returns",
    "holding_returns_range",
    "risk_free_return",
    "benchmark_return",
    "upsert_update",
    "upsert_trades",
    "upsert_ignore",
    "reload_union_distinct",
    "clean_trades",
    "key_violations",
    "holding_returns_wide",
    "fund_returns_wide",
    "upsert_wide",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    wanted = sys.argv[1:] or HEADLINE
    for name in wanted:
        run(queries[name](spark, folder))
    seconds = {}
    for name in wanted:
        started = time.perf_counter()
        run(queries[name](spark, folder))
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

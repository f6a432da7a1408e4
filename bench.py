"""Time the headline queries; prints one JSON line.

Every query is run twice over the whole tables, into a sink that drops the
rows, and the second run counts: the first one also loads and compiles code.
A time covers building, planning and running the query from the raw tables.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from seatledger.registry import queries  # noqa: E402
from seatledger.session import local_session  # noqa: E402

HEADLINE = [
    "booking_payment_join",
    "flattened_seats",
    "revenue_summary",
    "weekly_kpis",
    "sliding_revenue",
    "segment_city",
    "conversion_rate",
    "fee_audit",
    "booking_totals_audit",
    "events_click_purchase",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    known, times = queries(), {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()

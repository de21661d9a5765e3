"""Headline queries at one scale factor; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.compare import local_session  # noqa: E402
from checks.queries import queries  # noqa: E402

HEADLINE = [
    "customer_360",
    "orders_mart",
    "ticket_counts",
    "first_last_next",
    "recency_spend",
    "weekday_attendance_corrected",
    "total_spend",
    "changed_contacts",
    "group_order_lines",
    "order_payloads",
    "with_batch_id",
    "sms_subscribers",
    "daily_tags",
    "merge_order_sightings",
    "upsert_orders",
    "stream_sms_subscribers",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    known = queries()
    # One small run starts the executors and loads classes, so the first query is not charged for it.
    known["recency_spend"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Benchmark: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1) with
local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion with the ``noop`` sink (full execution, nothing
collected to the driver).  ``value`` is the sum of the per-query wall times.  The
registered queries derive the billing tables from the driver's tables on every run;
``transactions_landed`` (reported apart, not in ``value``) times the flagship over the
same tables landed once by month, as they would be in production.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aqualedger.operators.transactions import transactions  # noqa: E402
from aqualedger.plans import catalog  # noqa: E402
from aqualedger.session import ensure_checkpoint_dir, local_session  # noqa: E402
from aqualedger.sources.landing import read_tables  # noqa: E402
from aqualedger.sources.sinks import land_tables  # noqa: E402
from aqualedger.sources.standins import standin_tables  # noqa: E402

HEADLINE = [
    "transactions",
    "transactions_with_rate_class",
    "bill_lines_union",
    "billable_items",
    "total_usage",
    "block_use_by_premise",
    "rate_class",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    keys = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    qs = catalog.queries()

    # warm-up: JVM, codegen caches and file listing, on the smallest headline query
    qs["block_use_by_premise"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for key in keys:
        t0 = time.perf_counter()
        qs[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)

    extra: dict[str, float] = {}
    if not sys.argv[1:]:
        try:
            landed = f"{ensure_checkpoint_dir(spark).rstrip('/')}/landed-{uuid.uuid4().hex}"
            land_tables(standin_tables(spark, sf_dir), landed)
            t0 = time.perf_counter()
            month = transactions(read_tables(spark, landed, known_schema=True), *catalog.WINDOW)
            month.write.format("noop").mode("overwrite").save()
            extra["transactions_landed"] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # informative only; never lose the main result
            print(f"landed run skipped: {exc}", file=sys.stderr)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "billing_queries_total_sec",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "landed": extra,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

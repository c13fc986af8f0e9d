"""Run one billing window as a batch job.

    python -m aqualedger --tables s3://.../history --start 20210301 --end 20210331 \
        --out s3://.../transactions [--format parquet] [--with-rate-class]

The session comes from the environment (spark-defaults, PYSPARK_SUBMIT_ARGS), so the
same command runs on a cluster or locally.

Reads the fourteen landed tables under ``--tables`` (one folder per table, optionally
partitioned by ``bill_month``), builds the transaction table for the window and writes it
partitioned by bill month; the window has whole months, each of which is replaced.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from .operators.transactions import transactions
from .plans import checks
from .sources.landing import read_tables
from .sources.sinks import write_months


def main(argv: Sequence[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="aqualedger", description=__doc__.split("\n\n")[0])
    ap.add_argument("--tables", required=True, help="folder holding one sub-folder per source table")
    ap.add_argument("--start", type=int, required=True, help="first bill date, YYYYMMDD")
    ap.add_argument("--end", type=int, required=True, help="last bill date, YYYYMMDD")
    ap.add_argument("--out", required=True, help="output folder (partitioned by bill_month)")
    ap.add_argument("--format", default="parquet", help="format of the landed tables")
    ap.add_argument("--with-rate-class", action="store_true", help="add rate schedule and utility type")
    ap.add_argument("--lenient-dates", action="store_true", help="invalid MMDDYYYY dates give NULL instead of failing")
    ap.add_argument("--explain", action="store_true", help="print the plan checks instead of running the job")
    ap.add_argument("--known-schema", action="store_true", help="tables were written by sinks.land_tables: skip schema inference")
    ap.add_argument("--month-column", help="integer YYYYMM partition column of the history tables")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("aqualedger").getOrCreate()
    tables = read_tables(spark, args.tables, args.format, known_schema=args.known_schema, month_col=args.month_column)
    month = transactions(
        tables, args.start, args.end, strict=not args.lenient_dates, with_rate_class=args.with_rate_class
    )
    if args.explain:
        for scan in checks.scans(month):
            print(f"{scan['location']}\n  pushed: {scan['pushed_filters']}\n  partitions: {scan['partition_filters']}")
        print(f"exchanges: {checks.exchange_count(month)}; forbidden operators: {checks.violations(month) or 'none'}")
        return
    write_months(month, args.out, window=(args.start, args.end))


if __name__ == "__main__":
    main()

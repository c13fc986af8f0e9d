"""Physical-plan checks for a built DataFrame, read from ``explain("formatted")``.

Use them to confirm on production tables what the tests confirm on fixtures: the window
reaches every history scan (as a Parquet pushed filter or a partition filter), columns
are pruned, and nothing runs as a Python UDF, cartesian product or nested-loop join.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def formatted_plan(df: DataFrame) -> str:
    """The ``explain("formatted")`` text of ``df``'s physical plan."""
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def _field(section: str, name: str) -> str:
    m = re.search(rf"^{name}: (.*)$", section, re.MULTILINE)
    return m.group(1) if m else ""


def scans(df: DataFrame) -> list[dict[str, str]]:
    """One entry per file scan: its location, read schema, pushed and partition filters."""
    out = []
    for section in formatted_plan(df).split("\n\n"):
        section = section.strip("\n")
        first = section.split("\n", 1)[0]
        if "Scan " not in first:
            continue
        out.append(
            {
                "node": first.strip(),
                "location": _field(section, "Location"),
                "read_schema": _field(section, "ReadSchema"),
                "pushed_filters": _field(section, "PushedFilters"),
                "partition_filters": _field(section, "PartitionFilters"),
            }
        )
    return out


def exchange_count(df: DataFrame) -> int:
    """Number of shuffle exchanges in the (initial) physical plan."""
    return sum(1 for line in formatted_plan(df).splitlines() if re.match(r"^\(\d+\) Exchange\b", line))


def violations(df: DataFrame) -> list[str]:
    """Operators that should never appear in this library's plans."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [op for op in FORBIDDEN if op in text]

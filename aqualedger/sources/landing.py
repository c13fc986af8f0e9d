"""Landing: read a source table and conform it to its schema.

Conforming is one projection per table: keep only the used columns, cast each to its
schema type (so join keys never become decimals when landed from a database), turn
Oracle's empty string into NULL, and optionally right-trim CHAR columns so that
blank-padded comparisons behave like Oracle's CHAR semantics.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .schemas import SCHEMAS

# Partition column (YYYYMM of the bill date) of the history tables landed by this library.
MONTH_COL = "bill_month"
HISTORY = ("ciconsumptionhistblock", "ciconsumptionhist", "fcihistv", "fcihistf")


def conform(
    df: DataFrame,
    table: str,
    *,
    blank_to_null: bool = True,
    rtrim_char: Iterable[str] = (),
    month_col: str | None = None,
) -> DataFrame:
    """Select, cast and clean the columns ``table`` needs, in schema order.  ``month_col``
    names the integer YYYYMM partition column of a history table, if it has one; it is kept as
    ``bill_month``, so month filters can prune partitions.  A column that merely happens to be
    called so is dropped like any other unused column."""
    rtrim = {c.lower() for c in rtrim_char}
    exprs: list[str] = []
    for field in SCHEMAS[table].fields:
        c = f"CAST(`{field.name}` AS {field.dataType.simpleString()})"
        if isinstance(field.dataType, T.StringType):
            if field.name.lower() in rtrim:
                c = f"rtrim({c})"
            if blank_to_null:
                c = f"nullif({c}, '')"
        exprs.append(f"{c} AS `{field.name}`")
    if month_col is not None and table in HISTORY:
        kind = {f.name.lower(): f.dataType for f in df.schema.fields}.get(month_col.lower())
        if not isinstance(kind, T.IntegralType):
            raise ValueError(f"{table} has no integer month column {month_col}")
        exprs.append(f"`{month_col}` AS `{MONTH_COL}`")
    return df.selectExpr(*exprs)


@dataclass(frozen=True)
class BillingTables:
    """The fourteen source tables, as DataFrames conforming to ``SCHEMAS``."""

    ciconsumptionhistblock: DataFrame
    ciconsumptionhist: DataFrame
    fwacmas: DataFrame
    fcihistv: DataFrame
    fcihistf: DataFrame
    cibillableitem: DataFrame
    wawatercustomermaster: DataFrame
    fciregister: DataFrame
    ciratemaster: DataFrame
    ciratekind: DataFrame
    ciratedetail: DataFrame
    ciitemratedetail: DataFrame
    ciitemcode: DataFrame
    cisteprate: DataFrame

    @classmethod
    def from_mapping(cls, frames: Mapping[str, DataFrame], **conform_opts) -> BillingTables:
        return cls(**{f.name: conform(frames[f.name], f.name, **conform_opts) for f in fields(cls)})


def read_tables(
    spark: SparkSession,
    base_path: str,
    fmt: str = "parquet",
    known_schema: bool = False,
    month_col: str | None = None,
    **conform_opts,
) -> BillingTables:
    """Read ``<base_path>/<table>`` for every source table in ``fmt`` and conform it.

    History tables landed partitioned by bill month get partition pruning once the month
    filter reaches the scan.  ``known_schema=True`` reads with the conformed schemas
    instead of inferring them from file footers; use it for tables written by
    ``sinks.land_tables`` (other files may store other types, which ``conform`` casts), whose
    month column it also takes.  For other month-partitioned history name the ``month_col``.
    """
    month_col = MONTH_COL if known_schema and month_col is None else month_col
    frames = {}
    for name, schema in SCHEMAS.items():
        reader = spark.read.format(fmt)
        if known_schema:
            reader = reader.schema(schema)
        frames[name] = reader.load(f"{base_path.rstrip('/')}/{name}")
    return BillingTables.from_mapping(frames, month_col=month_col, **conform_opts)


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    **conform_opts,
) -> DataFrame:
    """Land one table over JDBC, split into parallel range reads when a numeric
    ``partition_column`` and its bounds are given, then conform it.

    ``table`` is the schema-qualified source name; the conformed schema is looked up by
    its unqualified, lower-cased name.
    """
    if partition_column is not None and None in (lower_bound, upper_bound, num_partitions):
        raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    return conform(reader.load(), table.split(".")[-1].lower(), **conform_opts)


def read_jdbc_tables(
    spark: SparkSession,
    url: str,
    names: Mapping[str, str],
    splits: Mapping[str, tuple[str, int, int, int]],
    *,
    properties: Mapping[str, str] | None = None,
    rtrim_char: Mapping[str, Iterable[str]] | None = None,
) -> BillingTables:
    """All fourteen tables over JDBC, ready for ``sinks.land_tables``.

    ``names`` maps each table to its qualified source name.  ``splits`` gives (numeric column,
    lower bound, upper bound, partitions) per table; the four history tables need one, as a
    whole history through one connection would be a single task.  ``rtrim_char`` lists the CHAR
    columns to right-trim, by table."""
    missing = [n for n in SCHEMAS if n not in names] + [n for n in HISTORY if n not in splits]
    if missing:
        raise ValueError(f"source name or split missing for {sorted(set(missing))}")
    frames = {}
    for table in SCHEMAS:
        column, low, high, parts = splits.get(table, (None, None, None, None))
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", names[table]).options(**(properties or {}))
        if column is not None:
            reader = reader.option("partitionColumn", column).option("lowerBound", low).option("upperBound", high).option("numPartitions", parts)
        frames[table] = conform(reader.load(), table, rtrim_char=(rtrim_char or {}).get(table, ()))
    return BillingTables(**frames)

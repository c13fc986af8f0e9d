"""Sinks: the transaction table as a month-partitioned Parquet dataset."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import fields

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.datekeys import DateKey, key_to_date
from .landing import BillingTables


NO_MONTH = 0  # partition of landed rows without a month: undated ones, and blocks that no dated header claims
INCREMENT_COL = "landed_by"  # the increment that brought a landed history row


def _write_partitioned(df: DataFrame, path: str, partition_col: str, months: Iterable[int] = ()) -> None:
    """Dynamic partition overwrite with rows gathered by month first: files per month follow
    the month's size, not the number of tasks; a large month still has several writers.

    ``df`` is evaluated once.  Of ``months`` those that it turns out to have no row of are
    emptied afterwards, so all of them are replaced."""
    seen = Observation()
    (
        df.observe(seen, F.collect_set(partition_col).alias("months"))  # at most one value a month
        .hint("rebalance", F.col(partition_col))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )
    missing = set(months) - set(seen.get["months"] or ()) if months else ()
    empty = df.sparkSession.createDataFrame([], df.drop(partition_col).schema)
    for m in sorted(missing):
        folder = f"{path.rstrip('/')}/{partition_col}={m}"
        if _exists(df.sparkSession, folder):
            empty.write.mode("overwrite").parquet(folder)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def months_of(start_key: int, end_key: int) -> list[int]:
    """The months (YYYYMM) of a window of whole months; a window that cuts a month is refused,
    since writing it would replace the month by a part of it."""
    first, last = key_to_date(start_key), key_to_date(end_key)
    if first > last:
        raise ValueError("the window ends before it starts")
    if first.day != 1 or (last + dt.timedelta(days=1)).day != 1:
        raise ValueError(f"{start_key} to {end_key} does not cover whole months")
    return [y * 100 + m for y in range(first.year, last.year + 1) for m in range(1, 13) if start_key // 100 <= y * 100 + m <= end_key // 100]


def write_months(
    df: DataFrame,
    path: str,
    date_key_col: str = "bld",
    partition_col: str = "bill_month",
    month: Column | None = None,
    window: tuple[int, int] | None = None,
) -> None:
    """Write ``df`` partitioned by bill month: YYYYMM from the YYYYMMDD key
    ``date_key_col``, or the given ``month`` expression.

    With a ``window`` (first and last bill date of whole months) every month of it is replaced,
    also a month that ``df`` has no row of, and rows outside it are refused by not being
    written.  Without one, the months present in ``df`` are replaced and others left alone.
    """
    month = month if month is not None else F.floor(F.col(date_key_col) / 100).cast("int")
    df = df.withColumn(partition_col, month)
    if window is None:
        _write_partitioned(df, path, partition_col)
        return
    months = months_of(*window)
    _write_partitioned(df.where(F.col(partition_col).between(months[0], months[-1])), path, partition_col, months)


def land_increment(
    rows: DataFrame, path: str, partition_col: str, increment: int, touched: Iterable[int], carried: DataFrame | None = None
) -> None:
    """Add the ``rows`` of an increment, which have their month in ``partition_col``, to the landed
    table at ``path``.

    The months ``touched`` (all that ``rows`` may have) are rewritten with the rows of all other
    increments kept, so increments may come in any order and share months, and a repeated
    increment replaces its own rows only.  One job reads what lies there and writes the new
    state, which takes its place when the job has succeeded.  ``carried`` gives rows of other
    increments that move (they are left out of what is kept of NO_MONTH)."""
    spark, months = rows.sparkSession, sorted(set(touched))
    state = rows.withColumn(INCREMENT_COL, F.lit(increment))
    if _exists(spark, path):
        lies = landed_rows(spark, path, rows.drop(partition_col), partition_col)
        kept = lies.where((F.col(INCREMENT_COL) != increment) & F.col(partition_col).isin(months))
        if carried is not None:
            kept = kept.where(F.col(partition_col) != NO_MONTH)
            state = state.unionByName(carried)
        state = state.unionByName(kept)
    _write_partitioned(state, path, partition_col, months)


def landed_rows(spark: SparkSession, path: str, like: DataFrame, partition_col: str) -> DataFrame:
    """The rows landed at ``path`` with the columns of ``like``, their increment (0 where none is
    noted) and their month."""
    fields_ = [*like.schema.fields, T.StructField(INCREMENT_COL, T.IntegerType()), T.StructField(partition_col, T.IntegerType())]
    lies = spark.read.schema(T.StructType(fields_)).parquet(path)
    return lies.withColumns({INCREMENT_COL: F.coalesce(INCREMENT_COL, F.lit(0)), partition_col: F.coalesce(partition_col, F.lit(NO_MONTH))})


def _months_in(df: DataFrame, month: str) -> list[int]:
    return [r[0] for r in df.select(month).distinct().collect()]  # one value a month


def create_view(t: BillingTables, name: str, start_key: DateKey, end_key: DateKey, **options) -> DataFrame:
    """The transaction table of a window as a temporary view ``name``."""
    from ..operators.transactions import transactions

    df = transactions(t, start_key, end_key, **options)
    df.createOrReplaceTempView(name)
    return df


def land_blocks_by_month(
    blocks: DataFrame, hist: DataFrame, path: str, partition_col: str = "bill_month", increment: int = 0
) -> None:
    """Land consumption blocks partitioned by the bill month of their block header; blocks
    that no dated header claims go to the partition NO_MONTH, which no window reads.

    Blocks carry no date of their own, so without this a month's run must look at the
    whole block history to find its blocks.  Run it per ``increment`` (a number of its own, such
    as the read month) with the increment's blocks and its headers: months are added to, not
    replaced, blocks of earlier increments that were unclaimed until now move to their month,
    and repeating an increment changes nothing.  A (consumptionhistid, readsequence)
    identifies one billed record, so it must map to one month; a key with headers in two
    months would be landed twice and double-counted by a window spanning both, so the
    job refuses such input instead.
    """
    from ..functions.codes import TXN_BLOCK_HEADER
    from ..functions.datekeys import date_key

    keys = ["consumptionhistid", "readsequence"]
    months = (
        hist.where(F.col("transactioncode") == TXN_BLOCK_HEADER)
        .select(*keys, F.floor(date_key("billdate") / 100).cast("int").alias(partition_col))
        .where(F.col(partition_col).isNotNull())
        .distinct()
    )
    clash = months.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if clash:
        raise ValueError(f"block key billed in more than one month, e.g. {clash[0][:2]}")

    def placed(df: DataFrame) -> DataFrame:
        return df.join(months, keys, "left").withColumn(partition_col, F.coalesce(partition_col, F.lit(NO_MONTH)))

    spark, carried = blocks.sparkSession, None
    if _exists(spark, path):
        waiting = landed_rows(spark, path, blocks, partition_col).where((F.col(partition_col) == NO_MONTH) & (F.col(INCREMENT_COL) != increment))
        carried = placed(waiting.drop(partition_col))
    land_increment(placed(blocks), path, partition_col, increment, [NO_MONTH, *_months_in(months, partition_col)], carried)


def land_tables(t: BillingTables, path: str, increment: int = 0) -> None:
    """Write all fourteen conformed tables under ``path/<table>``: the three history tables
    partitioned by bill month, blocks under their header's month, the reference tables whole.
    The history of an ``increment`` is added to what other increments have landed and replaces
    its own rows of an earlier run; the reference tables are replaced.
    ``read_tables(spark, path, known_schema=True)`` reads them back with
    the month as a partition column, so a window prunes every history scan."""
    from ..functions.datekeys import date_key

    root, month = path.rstrip("/"), "bill_month"
    bill_key = {"fcihistv": F.col("cihis_date"), "fcihistf": F.col("cihis_date"), "ciconsumptionhist": date_key("billdate")}
    for f in fields(t):
        name, df = f.name, getattr(t, f.name)
        if name in bill_key:
            dated = df.withColumn(month, F.coalesce(F.floor(bill_key[name] / 100).cast("int"), F.lit(NO_MONTH)))
            land_increment(dated, f"{root}/{name}", month, increment, _months_in(dated, month))
        elif name == "ciconsumptionhistblock":
            land_blocks_by_month(df, t.ciconsumptionhist, f"{root}/{name}", increment=increment)
        else:
            df.write.mode("overwrite").parquet(f"{root}/{name}")

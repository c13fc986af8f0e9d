"""Date keys and day counts.

Two integer date encodings live side by side in the billing history: ``YYYYMMDD``
(bill dates) and ``MMDDYYYY`` without a leading zero (item service periods).  Every
function here is a built-in column expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_MDY = 99999999  # eight digits: the widest value the zero-padded format can hold


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _idiv(c: Column, d: int) -> Column:
    return F.floor(c / d).cast("int")


def date_key(ts: Column | str) -> Column:
    """DATE/timestamp -> ``YYYYMMDD`` int (the time of day is dropped)."""
    t = _c(ts)
    return F.year(t) * 10000 + F.month(t) * 100 + F.dayofmonth(t)


def key_to_date(key: int) -> dt.date:
    return dt.date(key // 10000, key // 100 % 100, key % 100)


@dataclass(frozen=True)
class RelationKey:
    """A ``YYYYMMDD`` date in a column of a one-row relation.

    Each filter reads it as an uncorrelated scalar subquery, which Spark runs once before the
    scan and turns into a literal: it prunes partitions and row groups like a number known
    when the query is planned.  A relation without rows, or with a NULL, gives no rows;
    one of several rows is an error.
    """

    relation: DataFrame
    column: str

    def value(self, derived: Callable[[Column], Column] = lambda key: key) -> Column:
        """A value derived from the date inside the subquery, so the scan sees a bare literal."""
        return self.relation.select(derived(F.col(self.column).cast("int")).alias(self.column)).scalar()


DateKey = int | RelationKey


def date_range(spark: SparkSession, start_key: int, end_key: int) -> DataFrame:
    """The one-row window relation (start_date, end_date)."""
    return spark.range(1).select(F.lit(start_key).alias("start_date"), F.lit(end_key).alias("end_date"))


def window_keys(relation: DataFrame, start: str = "start_date", end: str = "end_date") -> tuple[RelationKey, RelationKey]:
    """The bounds of a one-row window relation, for the functions that take a first and a last
    bill date: ``transactions(t, *window_keys(relation))``."""
    return RelationKey(relation, start), RelationKey(relation, end)


def in_window(key: Column | str, start_key: DateKey, end_key: DateKey) -> Column:
    """``key BETWEEN start_key AND end_key`` for a ``YYYYMMDD`` column."""
    low, high = (b.value() if isinstance(b, RelationKey) else F.lit(b) for b in (start_key, end_key))
    return _c(key).between(low, high)


def _midnight(key: RelationKey, days_later: int = 0) -> Column:
    """The first instant of the date, or of a later one; NULL if it is no date."""
    return key.value(lambda k: F.date_add(F.try_to_date(k.cast("string"), "yyyyMMdd"), days_later).cast("timestamp_ntz"))


def key_in_range(ts: Column | str, start_key: DateKey, end_key: DateKey) -> Column:
    """``date_key(ts) BETWEEN start_key AND end_key`` written so the scan can use it.

    A cast of a timestamp to date compared with date literals is unwrapped by Catalyst
    into a timestamp range, which reaches the Parquet ``PushedFilters``; the arithmetic
    key does not.  A relation's dates are no literals when the query is planned, so their
    range is written out.
    """
    if isinstance(start_key, RelationKey) or isinstance(end_key, RelationKey):
        if not (isinstance(start_key, RelationKey) and isinstance(end_key, RelationKey)):
            raise ValueError("a window's first and last bill date are both numbers or both of a relation")
        return (_c(ts) >= _midnight(start_key)) & (_c(ts) < _midnight(end_key, 1))
    return F.to_date(_c(ts)).between(F.lit(key_to_date(start_key)), F.lit(key_to_date(end_key)))


def in_months(df: DataFrame, start_key: DateKey, end_key: DateKey, month_col: str = "bill_month") -> DataFrame:
    """Add a partition filter on ``month_col`` (YYYYMM) covering the window when the
    table is month-partitioned; otherwise return ``df`` unchanged.  Spark cannot derive
    this filter from a bill-date predicate by itself."""
    if start_key is None or end_key is None:
        raise ValueError("a window needs both its first and its last bill date")
    if month_col not in df.columns:
        return df
    low, high = (
        b.value(lambda k: F.floor(k / 100).cast("int")) if isinstance(b, RelationKey) else F.lit(b // 100)
        for b in (start_key, end_key)
    )
    return df.where(F.col(month_col).between(low, high))


def mdy_key(n: Column | str, strict: bool = True) -> Column:
    """``MMDDYYYY`` int -> ``YYYYMMDD`` int by arithmetic on the digits.

    The source pads to eight digits behind a sign slot and reads fixed offsets, so the
    sign never reaches the digits (hence ``abs``) and nine or more digits cannot be
    formatted: ``strict`` raises for those, otherwise they give NULL.
    """
    a = F.abs(_c(n))
    key = (a % 10000) * 10000 + _idiv(a, 1000000) * 100 + _idiv(a, 10000) % 100
    too_wide = a > MAX_MDY
    if strict:
        return F.when(too_wide, F.raise_error(F.concat(F.lit("MMDDYYYY value too wide: "), a.cast("string")))).otherwise(key)
    return F.when(~too_wide, key)


def mdy_date(n: Column | str, strict: bool = True) -> Column:
    """``MMDDYYYY`` int -> DATE.  Invalid dates raise when ``strict``, else NULL."""
    c = _c(n)
    parsed = F.when(
        (c >= 0) & (c <= MAX_MDY),
        F.try_to_date(F.lpad(c.cast("string"), 8, "0"), "MMddyyyy"),
    )
    if strict:
        bad = c.isNotNull() & parsed.isNull()
        return F.when(bad, F.raise_error(F.concat(F.lit("invalid MMDDYYYY date: "), c.cast("string")))).otherwise(parsed)
    return parsed


def whole_days(from_mdy: Column | str, to_mdy: Column | str, strict: bool = True) -> Column:
    """Whole days between two ``MMDDYYYY`` dates (``to - from``)."""
    return F.datediff(mdy_date(to_mdy, strict), mdy_date(from_mdy, strict))


def elapsed_days(start_ts: Column | str, end_ts: Column | str) -> Column:
    """Fractional days between two timestamps (``end - start``), e.g. 30.5."""
    micros = F.timestamp_diff("MICROSECOND", _c(start_ts), _c(end_ts))
    return micros / F.lit(86_400_000_000)

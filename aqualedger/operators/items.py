"""Flat-rate billable items: item records with service dates and billing period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import CLASS_TYPE_SALES, TYPE_ITEM_RECORD, TYPE_TOTAL_BILLING, item_service_size
from ..functions.datekeys import MAX_MDY, DateKey, date_key, in_months, in_window, mdy_key, whole_days

CHARGES = "decimal(28,4)"  # type of a sum of amounts
ITEM_GROUP_KEYS = [
    "cihis_cust",
    "cihis_date",
    "cihis_service",
    "cihis_class_num1",
    "cihis_rate1",
    "ssize",
    "serviceconnectdate",
    "serviceclosedate",
    "days",
    "fromdate",
    "todate",
    "efd",
    "edt",
]


def item_records(histv: DataFrame, start_key: DateKey | None = None, end_key: DateKey | None = None) -> DataFrame:
    """Sales item records (class type 4, type code 34); a window filters the bill date
    column directly, so it reaches the scan."""
    hv = histv.where((F.col("cihis_class_type1") == CLASS_TYPE_SALES) & (F.col("cihis_type_code") == TYPE_ITEM_RECORD))
    if start_key is not None:
        hv = in_months(hv, start_key, end_key).where(in_window("cihis_date", start_key, end_key))
    return hv


def billing_periods(histv: DataFrame, start_key: DateKey | None = None, end_key: DateKey | None = None) -> DataFrame:
    """Total billing records (type 95), renamed so they can join the item records.
    The type filter sits before the join: after it, unmatched items would be lost.
    They join on the item's bill date, so the item window applies to them as well."""
    tbr = histv.where(F.col("cihis_type_code") == TYPE_TOTAL_BILLING)
    if start_key is not None:
        tbr = in_months(tbr, start_key, end_key).where(in_window("cihis_date", start_key, end_key))
    return tbr.select(
        F.col("cihis_cust").alias("tbr_cust"),
        F.col("cihis_date").alias("tbr_date"),
        F.col("cihis_from_date").alias("tbr_from_date"),
        F.col("cihis_to_date").alias("tbr_to_date"),
    )


def period_copies(histv: DataFrame, start_key: DateKey | None = None, end_key: DateKey | None = None, strict: bool = True) -> DataFrame:
    """Distinct billing periods of a customer and bill date, each with the number of its
    total billing records: repeated records of a period are one row of a join.  Periods that
    give the same date keys are one (signs are dropped and, unless ``strict``, dates too wide)."""
    tbr = billing_periods(histv, start_key, end_key)
    ends = {c: F.abs(c) if strict else F.when(F.abs(c) <= MAX_MDY, F.abs(c)) for c in ("tbr_from_date", "tbr_to_date")}
    return tbr.withColumns(ends).groupBy(*tbr.columns).agg(F.count(F.lit(1)).alias("tbr_copies"))


def _with_service_dates(hv: DataFrame, items: DataFrame) -> DataFrame:
    cbi = items.select("customernumber", "servicenumber", "dateiteminstalled", "itemremovaldate")
    return hv.join(
        cbi,
        (F.col("customernumber") == F.col("cihis_cust")) & (F.col("servicenumber") == F.col("cihis_service")),
        "left",
    )


def _with_billing_period(hv: DataFrame, periods: DataFrame) -> DataFrame:
    return hv.join(
        periods,
        (F.col("tbr_cust") == F.col("cihis_cust")) & (F.col("tbr_date") == F.col("cihis_date")),
        "left",
    )


def item_service_dates(histv: DataFrame, items: DataFrame) -> DataFrame:
    """Item records with the connect and close dates of their billable item."""
    j = _with_service_dates(item_records(histv), items)
    return j.select(
        "cihis_cust",
        "cihis_date",
        "cihis_service",
        "cihis_amt",
        date_key("dateiteminstalled").alias("serviceconnectdate"),
        date_key("itemremovaldate").alias("serviceclosedate"),
    )


def item_with_billing_period(histv: DataFrame, strict: bool = True) -> DataFrame:
    """Item records with their own period and the total billing record's period.
    The same table is read in two roles, each with its own code filter."""
    j = _with_billing_period(item_records(histv), billing_periods(histv))
    return j.select(
        "cihis_cust",
        "cihis_date",
        "cihis_service",
        "cihis_amt",
        mdy_key("cihis_from_date", strict).alias("fromdate"),
        mdy_key("cihis_to_date", strict).alias("todate"),
        mdy_key("tbr_from_date", strict).alias("efd"),
        mdy_key("tbr_to_date", strict).alias("edt"),
    )


def billable_items(
    histv: DataFrame,
    items: DataFrame,
    start_key: DateKey | None = None,
    end_key: DateKey | None = None,
    strict: bool = True,
    sorted: bool = False,
) -> DataFrame:
    """Flat-rate charges summed per customer, bill date, service, class, rate, size,
    service dates, item period and billing period.

    Every grouping key stays, including ``efd``/``edt`` that later steps drop: two
    billing periods on one bill split the charges into two groups.  Several type-95
    records with the same period multiply the item's charge inside the sum, as written;
    they are counted before the join, so they multiply no rows.  The items are summed before
    they meet the periods: the sum runs on the partitioning of the service-date join, and the
    join with the periods (one row per period) shares its shuffles with no aggregate, so a
    customer and date with many items can be split.
    ``sorted`` orders the output by the group keys (ascending, NULLs last).
    """
    derived = _with_service_dates(item_records(histv, start_key, end_key), items).select(
        "cihis_cust",
        "cihis_date",
        "cihis_service",
        "cihis_class_num1",
        "cihis_rate1",
        item_service_size("cihis_rate1").alias("ssize"),
        date_key("dateiteminstalled").alias("serviceconnectdate"),
        date_key("itemremovaldate").alias("serviceclosedate"),
        whole_days("cihis_from_date", "cihis_to_date", strict).alias("days"),
        mdy_key("cihis_from_date", strict).alias("fromdate"),
        mdy_key("cihis_to_date", strict).alias("todate"),
        "cihis_amt",
    )
    own_keys = [k for k in ITEM_GROUP_KEYS if k not in ("efd", "edt")]
    summed = derived.groupBy(*own_keys).agg(F.sum("cihis_amt").cast(CHARGES).alias("charge"))
    j = _with_billing_period(summed, period_copies(histv, start_key, end_key, strict))
    times = F.coalesce("tbr_copies", F.lit(1)).cast("decimal(10,0)")
    out = j.select(
        *own_keys,
        mdy_key("tbr_from_date", strict).alias("efd"),
        mdy_key("tbr_to_date", strict).alias("edt"),
        (F.col("charge") * times).cast(CHARGES).alias("totalcharges"),
    )
    return out.orderBy(*[F.asc_nulls_last(k) for k in ITEM_GROUP_KEYS]) if sorted else out


def repeated_billing_periods(histv: DataFrame) -> DataFrame:
    """Diagnostic for double-counted item charges: total billing records (type 95) that
    occur more than once with the same customer, bill date and period.  Each extra copy
    multiplies the matching item rows inside ``billable_items``' sum."""
    keys = ["cihis_cust", "cihis_date", "cihis_from_date", "cihis_to_date"]
    return (
        histv.where(F.col("cihis_type_code") == TYPE_TOTAL_BILLING)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )

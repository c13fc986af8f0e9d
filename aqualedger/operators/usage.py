"""Metered services: readings with customer, premise and meter size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import SIZE_REGISTER, TXN_READING, register_service_size
from ..functions.datekeys import DateKey, date_key, elapsed_days, in_months, key_in_range
from ..functions.text import trim_to_null

USAGE_GROUP_KEYS = [
    "accountnumber",
    "billdate_ts",
    "servicenumbersequence",
    "mtr",
    "readingclass1",
    "rate1",
    "ssize",
    "days",
    "fromdate",
    "todate",
    "cisnumberofbilledaccount",
    "premisenumber",
]


def readings(hist: DataFrame, start_key: DateKey | None = None, end_key: DateKey | None = None) -> DataFrame:
    """Meter readings (code 2).  A window is written on the raw bill timestamp so the
    scan can use it; the bill time is a grouping key later, so this is exact."""
    ch = hist.where(F.col("transactioncode") == TXN_READING)
    if start_key is not None:
        ch = in_months(ch, start_key, end_key).where(key_in_range("billdate", start_key, end_key))
    return ch


def size_registers(registers: DataFrame) -> DataFrame:
    """Register 1 of each meter; filtered before the join so a reading without it is kept."""
    return registers.where(F.col("ciregister_num") == SIZE_REGISTER).select(
        "ciregister_device", "ciregister_device_cd", "ciregister_num", "ciregister_cmp_size"
    )


def _with_register(ch: DataFrame, registers: DataFrame) -> DataFrame:
    # The device is trimmed for output and grouping but joined untrimmed.
    return ch.join(
        size_registers(registers),
        (F.col("ciregister_device") == F.col("device")) & (F.col("ciregister_device_cd") == F.col("devicecode")),
        "left",
    )


def meter_register_size(hist: DataFrame, registers: DataFrame) -> DataFrame:
    """Readings with the size of register 1 ('9999' when there is none)."""
    j = _with_register(readings(hist), registers)
    return j.select(
        "accountnumber",
        "consumptionhistid",
        "readingclass1",
        "device",
        "devicecode",
        "ciregister_num",
        "ciregister_cmp_size",
        register_service_size("ciregister_cmp_size").alias("ssize"),
    )


def total_usage(
    hist: DataFrame,
    customers: DataFrame,
    registers: DataFrame,
    start_key: DateKey | None = None,
    end_key: DateKey | None = None,
    keep_raw_billdate: bool = False,
    sorted: bool = False,
) -> DataFrame:
    """Consumption and charges per account, bill time, service, meter, class, rate,
    size, days, read dates, CIS number and premise.

    Grouping is on the raw bill timestamp: two bills on one day stay two rows although
    both show the same YYYYMMDD ``billdate``.  ``days`` may be fractional.  The three
    "later" columns are typed NULLs.  ``sorted`` orders the output by the group keys
    (ascending, NULLs last; the bill time sorts by its raw value).

    Both joins are left joins on keys of the reading, so their order changes no row: the
    customer's comes last, as the sum can run on its partitioning by account.
    """
    ch = readings(hist, start_key, end_key)
    wcm = customers.select("customernumber", "cisnumberofbilledaccount", "premisenumber")
    j = _with_register(ch, registers).join(wcm, F.col("accountnumber") == F.col("customernumber"), "left")
    derived = j.select(
        "accountnumber",
        F.col("billdate").alias("billdate_ts"),
        "servicenumbersequence",
        trim_to_null("device").alias("mtr"),
        "readingclass1",
        "rate1",
        register_service_size("ciregister_cmp_size").alias("ssize"),
        elapsed_days("previousreaddate", "presentreaddate").alias("days"),
        date_key("previousreaddate").alias("fromdate"),
        date_key("presentreaddate").alias("todate"),
        "cisnumberofbilledaccount",
        "premisenumber",
        "consumption",
        "billingamount",
    )
    agg = derived.groupBy(*USAGE_GROUP_KEYS).agg(
        F.sum("consumption").alias("totalusage"), F.sum("billingamount").alias("totalcharges")
    )
    if sorted:
        agg = agg.orderBy(*[F.asc_nulls_last(k) for k in USAGE_GROUP_KEYS])
    raw = ["billdate_ts"] if keep_raw_billdate else []
    return agg.select(
        "accountnumber",
        date_key("billdate_ts").alias("billdate"),
        *raw,
        "servicenumbersequence",
        "mtr",
        "readingclass1",
        "rate1",
        "ssize",
        F.lit(None).cast("int").alias("serviceconnectdate"),
        F.lit(None).cast("int").alias("serviceclosedate"),
        "days",
        "fromdate",
        "todate",
        F.lit(None).cast("long").alias("billid"),
        "cisnumberofbilledaccount",
        "premisenumber",
        "totalusage",
        "totalcharges",
    )

"""Registered queries: one per operator of the billing query, run on the stand-in
tables derived from the driver's Parquet (``sources.standins``).

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole
tables.  Results are returned in *compare form*: decimals (exact sums) are cast to
double at the very end so both engines hand back the same Python values; the oracle SQL
does the same cast.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions import codes
from ..functions.datekeys import date_key, date_range, elapsed_days, mdy_key, whole_days, window_keys
from ..functions.text import trim_to_null
from ..operators import bill_lines as bl
from ..operators import blocks, items, rates, transactions, usage
from ..operators.ordering import with_position
from ..sources.landing import BillingTables
from ..sources.standins import standin_tables

# The stand-in data spans 1995-2001; this month is non-empty at every stage.
WINDOW = (19950701, 19950731)

Query = Callable[[SparkSession, str], DataFrame]


def compare_form(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        *[
            f"CAST(`{f.name}` AS DOUBLE) AS `{f.name}`" if isinstance(f.dataType, T.DecimalType) else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


def _q(build: Callable[[BillingTables], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return compare_form(build(standin_tables(spark, sf_dir)))

    run.__doc__ = build.__doc__
    return run


def _by_relation(t: BillingTables) -> DataFrame:
    """The transaction table with its window read from a one-row relation."""
    window = date_range(t.fcihistv.sparkSession, *WINDOW)
    return transactions.transactions(t, *window_keys(window))


def _all_lines(t: BillingTables) -> DataFrame:
    return transactions.bill_lines_in_window(t, None, None)


def _headers_all(t: BillingTables) -> DataFrame:
    return bl.bill_headers(t.fcihistf, t.wawatercustomermaster)


def _items_in_order(t: BillingTables) -> DataFrame:
    """The place of each group of flat-rate items in its 13-key order."""
    groups = items.billable_items(t.fcihistv, t.cibillableitem).select(*items.ITEM_GROUP_KEYS)
    return with_position(groups, items.ITEM_GROUP_KEYS, unique=True)


def _usage_in_order(t: BillingTables) -> DataFrame:
    """The place of each group of meter readings in its 12-key order (raw bill time)."""
    groups = usage.total_usage(t.ciconsumptionhist, t.wawatercustomermaster, t.fciregister, keep_raw_billdate=True)
    return with_position(groups.select(*usage.USAGE_GROUP_KEYS), usage.USAGE_GROUP_KEYS, unique=True)


def _rates_in_order(t: BillingTables) -> DataFrame:
    """The place of each rate-class row by rate kind and rate; ties by the other columns."""
    rows = rates.rate_class(t.ciratemaster, t.ciratekind, t.ciratedetail, t.ciitemratedetail, t.ciitemcode, t.cisteprate)
    return with_position(rows, ["ratekindid", "rate"])


BUILDERS: dict[str, Callable[[BillingTables], DataFrame]] = {
    # --- scalar functions -------------------------------------------------------------
    "date_to_key": lambda t: t.ciconsumptionhist.select(
        "consumptionhistid",
        "readsequence",
        "readingclass1",
        "transactioncode",
        date_key("billdate").alias("billdate"),
        date_key("fromdate").alias("fromdate"),
        date_key("todate").alias("todate"),
    ),
    "mdy_to_key": lambda t: t.fcihistv.select(
        "cihis_cust",
        "cihis_date",
        "cihis_from_date",
        "cihis_to_date",
        mdy_key("cihis_from_date").alias("fromdate"),
        mdy_key("cihis_to_date").alias("todate"),
    ),
    "mdy_days": lambda t: t.fcihistv.select(
        "cihis_cust",
        "cihis_date",
        "cihis_from_date",
        "cihis_to_date",
        whole_days("cihis_from_date", "cihis_to_date").alias("days"),
    ),
    "read_days": lambda t: usage.readings(t.ciconsumptionhist).select(
        "accountnumber",
        "consumptionhistid",
        "readingclass1",
        date_key("previousreaddate").alias("fromdate"),
        date_key("presentreaddate").alias("todate"),
        elapsed_days("previousreaddate", "presentreaddate").alias("days"),
    ),
    "trim_device": lambda t: t.ciconsumptionhist.select(
        "consumptionhistid", "readingclass1", "transactioncode", "device", trim_to_null("device").alias("mtr")
    ),
    "item_service_size": lambda t: t.fcihistv.select(
        "cihis_cust", "cihis_date", "cihis_rate1", codes.item_service_size("cihis_rate1").alias("ssize")
    ),
    "meter_service_size": lambda t: t.fciregister.select(
        "ciregister_device",
        "ciregister_device_cd",
        "ciregister_num",
        "ciregister_cmp_size",
        codes.register_service_size("ciregister_cmp_size").alias("ssize"),
    ),
    "rate_utility_type": lambda t: t.ciratemaster.select(
        "ratemasterid", "ratekindid", "rate", codes.utility_type("ratekindid", "rate").alias("utl_typ")
    ),
    "rate_schedule": lambda t: t.ciratemaster.select(
        "ratemasterid", "ratekindid", "rate", codes.rate_schedule("ratekindid", "rate").alias("rsch")
    ),
    # --- block use --------------------------------------------------------------------
    "block_use_pivot": lambda t: blocks.block_use(t.ciconsumptionhistblock),
    "tier_totals": lambda t: blocks.tier_totals(blocks.block_use(t.ciconsumptionhistblock)),
    "block_header": lambda t: blocks.block_header(t.ciconsumptionhist),
    "account_premise_link": lambda t: blocks.account_premise_link(t.fwacmas),
    "block_use_by_premise": lambda t: blocks.block_use_by_premise(
        blocks.block_header(t.ciconsumptionhist),
        blocks.block_use(t.ciconsumptionhistblock),
        blocks.account_premise_link(t.fwacmas),
    ),
    # --- flat-rate items --------------------------------------------------------------
    "item_service_dates": lambda t: items.item_service_dates(t.fcihistv, t.cibillableitem),
    "item_with_billing_period": lambda t: items.item_with_billing_period(t.fcihistv),
    "billable_items": lambda t: items.billable_items(t.fcihistv, t.cibillableitem),
    # --- metered usage ----------------------------------------------------------------
    "meter_register_size": lambda t: usage.meter_register_size(t.ciconsumptionhist, t.fciregister),
    "total_usage": lambda t: usage.total_usage(t.ciconsumptionhist, t.wawatercustomermaster, t.fciregister),
    "total_usage_raw_billdate": lambda t: usage.total_usage(
        t.ciconsumptionhist, t.wawatercustomermaster, t.fciregister, keep_raw_billdate=True
    ),
    # --- bill lines -------------------------------------------------------------------
    "bill_items_branch": lambda t: bl.bill_items_branch(
        _headers_all(t), items.billable_items(t.fcihistv, t.cibillableitem)
    ),
    "bill_metered_branch": lambda t: bl.bill_metered_branch(
        _headers_all(t), usage.total_usage(t.ciconsumptionhist, t.wawatercustomermaster, t.fciregister)
    ),
    "bill_lines_union": _all_lines,
    "bill_date_range": lambda t: transactions.bill_lines_in_window(t, *WINDOW),
    # --- final table ------------------------------------------------------------------
    "transactions": lambda t: transactions.transactions(t, *WINDOW),
    "transactions_by_relation": _by_relation,
    # --- rate class (kept out of the default output) ------------------------------------
    "latest_effective_date": lambda t: rates.latest_effective_date(t.ciratedetail),
    "latest_rate_detail": lambda t: rates.latest_rate_detail(t.ciratemaster, t.ciratedetail),
    "rate_class": lambda t: rates.rate_class(
        t.ciratemaster, t.ciratekind, t.ciratedetail, t.ciitemratedetail, t.ciitemcode, t.cisteprate
    ),
    "transactions_with_rate_class": lambda t: transactions.transactions(t, *WINDOW, with_rate_class=True),
    # --- sorted outputs, as the place of each row -----------------------------------------
    "rate_class_order": _rates_in_order,
    "billable_items_order": _items_in_order,
    "total_usage_order": _usage_in_order,
}


def queries() -> dict[str, Query]:
    return {name: _q(build) for name, build in BUILDERS.items()}

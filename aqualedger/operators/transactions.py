"""The monthly transaction table: bill lines with the tiered block use of the premise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.datekeys import DateKey, in_months, in_window
from ..sources.landing import BillingTables
from .bill_lines import bill_headers, bill_lines
from .blocks import account_premise_link, block_header, block_use, block_use_by_premise
from .items import billable_items
from .joins import expand, split_join, with_copies
from .rates import rate_class
from .usage import total_usage


def bill_lines_in_window(
    t: BillingTables,
    start_key: DateKey | None,
    end_key: DateKey | None,
    strict: bool = True,
) -> DataFrame:
    """Distinct bill lines whose bill date is in the window.  Every branch joins on the
    billing record's date, so the window is applied to each source before its aggregate;
    ``None`` bounds give all lines."""
    headers = bill_headers(t.fcihistf, t.wawatercustomermaster, start_key, end_key)
    items = billable_items(t.fcihistv, t.cibillableitem, start_key, end_key, strict)
    usage = total_usage(
        t.ciconsumptionhist, t.wawatercustomermaster, t.fciregister, start_key, end_key
    )
    if start_key is not None:
        # what the join would tell Spark of the date, told to both readings of its inputs
        usage = usage.where(in_window("billdate", start_key, end_key))
    return bill_lines(headers, items, usage)


def premise_block_use(
    t: BillingTables,
    start_key: DateKey | None,
    end_key: DateKey | None,
    n_tiers: int = 5,
) -> DataFrame:
    """Block use per premise for headers billed in the window.  Only blocks of those
    headers are aggregated (semi join before the pivot)."""
    headers = block_header(t.ciconsumptionhist, start_key, end_key)
    blocks = t.ciconsumptionhistblock
    if start_key is not None:
        # blocks landed under their header's bill month (``sinks.land_blocks_by_month``)
        blocks = in_months(blocks, start_key, end_key)
    pivot = block_use(blocks, n_tiers, only_keys=headers)
    return block_use_by_premise(headers, pivot, account_premise_link(t.fwacmas), n_tiers)


# Output name <- line or block-use column, in the table's column order.
LAYOUT = [
    ("rclass", "cihis_class_num1"),
    ("sch", "cihis_rate1"),
    ("SIZE", "ssize"),
    ("act", "cihis_cust"),
    ("cus", "cisnumberofbilledaccount"),
    ("prm", "premisenumber"),
    ("srvcid", "cihis_service"),
    ("bld", "cihis_date"),
    ("dys", "days"),
    ("efd", "fromdate"),
    ("edt", "todate"),
    ("billdate", "billdate"),
    ("numberofdays", "numberofdays"),
    ("tot_use", "tot_use"),
    ("tot_amt", "tot_amt"),
]


def _layout(df: DataFrame, n_tiers: int, with_rate_class: bool) -> DataFrame:
    cols = list(LAYOUT)
    if with_rate_class:
        cols.insert(1, ("rate_sch", "rsch"))
        cols.insert(cols.index(("edt", "todate")) + 1, ("utl", "utl_typ"))
    for measure, prefix in (("use", "blkuse"), ("amt", "blkamt"), ("rate", "blkrate")):
        cols += [(f"t{n}_{measure}", f"{prefix}_{n}") for n in range(1, n_tiers + 1)]
    return df.selectExpr(*[f"`{src}` AS `{out}`" for out, src in cols])


def transactions(
    t: BillingTables,
    start_key: DateKey,
    end_key: DateKey,
    n_tiers: int = 5,
    strict: bool = True,
    with_rate_class: bool = False,
) -> DataFrame:
    """One row per bill line billed in ``[start_key, end_key]`` (YYYYMMDD) and per block
    header of the line's premise on its bill date; lines with no header keep NULL tiers.

    The premise join is by premise and bill date only, so a line receives the block use
    of every header on that premise and day.  The result is a bag (no final distinct).
    A premise and day with many headers is dealt to seats (``split_join``), and rows that are
    equal from here on are repeated last, after every shuffle.
    The bounds are numbers, or ``datekeys.window_keys`` of a one-row relation.
    ``with_rate_class`` adds the rate schedule and utility type of the line's rate.
    """
    lines = bill_lines_in_window(t, start_key, end_key, strict).where(
        in_window("cihis_date", start_key, end_key)
    )
    tiers = [f"{p}_{n}" for p in ("blkuse", "blkamt", "blkrate") for n in range(1, n_tiers + 1)]
    b4 = premise_block_use(t, start_key, end_key, n_tiers).select(
        "premiseid", "billdate", "numberofdays", "tot_use", "tot_amt", *tiers
    )
    b4 = b4.where(in_window("billdate", start_key, end_key))  # as the lines', before the split counts its rows
    j = split_join(lines, b4, [("premisenumber", "premiseid"), ("cihis_date", "billdate")], copies="_times")
    if with_rate_class:
        # Both joins are left joins from the line on keys of the line only, so their order
        # does not change the bag.  Utility type and schedule follow from kind and rate, so a
        # rate's many details are a row per kind and their number, repeated at the very end.
        rc = rate_class(
            t.ciratemaster, t.ciratekind, t.ciratedetail, t.ciitemratedetail, t.ciitemcode, t.cisteprate
        ).select(F.col("rate").alias("rc_rate"), "rsch", "utl_typ")
        j = j.join(with_copies(rc, "_details"), F.col("cihis_rate1") == F.col("rc_rate"), "left")
        j = j.withColumn("_times", F.col("_times") * F.coalesce("_details", F.lit(1)))
    return _layout(expand(j, "_times"), n_tiers, with_rate_class)

"""Tiered ("block") water use: pivot, headers, account-to-premise link, totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import TXN_BLOCK_HEADER
from ..functions.datekeys import DateKey, date_key, in_months, key_in_range
from ..functions.text import zero_if_null_sum
from .joins import split_left_join

BLOCK_KEYS = ["consumptionhistid", "readsequence"]
MEASURES = [("blockusage", "blkuse"), ("blockamount", "blkamt"), ("blockrate", "blkrate")]


def tier_columns(n_tiers: int = 5) -> list[str]:
    return [f"{prefix}_{n}" for _, prefix in MEASURES for n in range(1, n_tiers + 1)]


def block_use(blocks: DataFrame, n_tiers: int = 5, only_keys: DataFrame | None = None) -> DataFrame:
    """One row per (consumptionhistid, readsequence) with use, amount and rate summed per
    tier 1..n_tiers.  A tier absent from a group stays NULL; rates are summed too; blocks
    above ``n_tiers`` are ignored.

    ``only_keys`` (a DataFrame with the two key columns) restricts the blocks before the
    aggregate with a semi join.  Only use it when the result feeds a left join from those
    keys: a group whose blocks are all above ``n_tiers`` is then also left out, which a
    left join cannot tell apart from an all-NULL row.
    """
    if only_keys is not None:
        blocks = blocks.where(F.col("blocknumber").between(1, n_tiers)).join(
            only_keys.select(*BLOCK_KEYS), BLOCK_KEYS, "left_semi"
        )
    tier = F.col("blocknumber")
    aggs = [
        F.sum(F.when(tier == n, F.col(measure))).alias(f"{prefix}_{n}")
        for measure, prefix in MEASURES
        for n in range(1, n_tiers + 1)
    ]
    return blocks.groupBy(*BLOCK_KEYS).agg(*aggs)


def block_header(hist: DataFrame, start_key: DateKey | None = None, end_key: DateKey | None = None) -> DataFrame:
    """Block-billed consumption headers (code 102) with dates turned into YYYYMMDD keys.
    With a window, only headers billed in it are read."""
    h = hist.where(F.col("transactioncode") == TXN_BLOCK_HEADER)
    if start_key is not None:
        h = in_months(h, start_key, end_key).where(key_in_range("billdate", start_key, end_key))
    return h.select(
        "accountnumber",
        "consumptionhistid",
        "readsequence",
        "device",
        date_key("billdate").alias("billdate"),
        "hasblocks",
        "numberofdays",
        date_key("fromdate").alias("fromdate"),
        date_key("todate").alias("todate"),
        "rate1",
        "ratekind1",
        "servicenumbersequence",
        "transactioncode",
    )


def account_premise_link(wacm: DataFrame) -> DataFrame:
    """Account -> premise link; one account may link to several premises."""
    return wacm.select(
        "wacm_cust",
        "wacm_address_seq_no",
        "wacm_occupant_cis_no",
        F.col("wacm_premise_no").alias("premiseid"),
        "wacm_ref_acct",
        "wacm_no_units",
    )


def tier_totals(blkuse: DataFrame, n_tiers: int = 5) -> DataFrame:
    """Null-safe totals of use and amount over the tiers (0 when no tier has a value)."""
    tiers = range(1, n_tiers + 1)
    return blkuse.select(
        *BLOCK_KEYS,
        zero_if_null_sum([f"blkuse_{n}" for n in tiers]).alias("tot_use"),
        zero_if_null_sum([f"blkamt_{n}" for n in tiers]).alias("tot_amt"),
    )


def block_use_by_premise(
    header: DataFrame,
    blkuse: DataFrame,
    link: DataFrame,
    n_tiers: int = 5,
) -> DataFrame:
    """Headers with their tiers and totals, fanned out to every premise of the account.

    The pivot is unique per key, so the first join keeps the header count; it shares the
    (consumptionhistid, readsequence) partitioning with the pivot's aggregate.
    """
    tiers = range(1, n_tiers + 1)
    with_blocks = header.join(blkuse, BLOCK_KEYS, "left")
    linked = split_left_join(
        with_blocks,
        link.select("wacm_cust", "premiseid", "wacm_address_seq_no"),
        [("accountnumber", "wacm_cust")],
    )
    return linked.select(
        "premiseid",
        "accountnumber",
        "wacm_address_seq_no",
        "servicenumbersequence",
        "device",
        "consumptionhistid",
        "billdate",
        "numberofdays",
        "fromdate",
        "todate",
        "rate1",
        zero_if_null_sum([f"blkuse_{n}" for n in tiers]).alias("tot_use"),
        zero_if_null_sum([f"blkamt_{n}" for n in tiers]).alias("tot_amt"),
        *tier_columns(n_tiers),
    )

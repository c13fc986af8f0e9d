"""Block use: pivot, headers, premise link, totals (FIXTURES.md §C R1-R4)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from conftest import rows

from aqualedger.operators import blocks

R1_BLOCKS = [
    dict(consumptionhistid=1, readsequence=1, blocknumber=1, blockusage=D(5), blockamount=D(10), blockrate=D(2)),
    dict(consumptionhistid=1, readsequence=1, blocknumber=1, blockusage=D(3), blockamount=D(6), blockrate=D(2)),
    dict(consumptionhistid=1, readsequence=1, blocknumber=3, blockusage=D(4), blockamount=D(12), blockrate=D(3)),
    dict(consumptionhistid=1, readsequence=1, blocknumber=6, blockusage=D(100), blockamount=D(1), blockrate=D(1)),
    dict(consumptionhistid=1, readsequence=2, blocknumber=2),
]


def test_pivot_sums_rates_and_ignores_tier_six(tables):  # R1
    t = tables(ciconsumptionhistblock=R1_BLOCKS)
    out = {(r.consumptionhistid, r.readsequence): r for r in blocks.block_use(t.ciconsumptionhistblock).collect()}
    a = out[(1, 1)]
    assert (a.blkuse_1, a.blkuse_3, a.blkamt_1, a.blkamt_3, a.blkrate_1, a.blkrate_3) == (8, 4, 16, 12, 4, 3)
    assert all(a[c] is None for c in ("blkuse_2", "blkuse_4", "blkuse_5", "blkamt_2", "blkrate_5"))
    assert all(v is None for k, v in out[(1, 2)].asDict().items() if k.startswith("blk"))


def test_block_header_keys(tables):  # R2
    t = tables(
        ciconsumptionhist=[
            dict(accountnumber=1, transactioncode=102, billdate=dt.datetime(2021, 3, 5, 23, 59)),
            dict(accountnumber=2, transactioncode=102, billdate=None),
            dict(accountnumber=3, transactioncode=2, billdate=dt.datetime(2021, 3, 5)),
            dict(accountnumber=4, transactioncode=7, billdate=dt.datetime(2021, 3, 5)),
        ]
    )
    assert rows(blocks.block_header(t.ciconsumptionhist), "billdate") == [(None,), (20210305,)]


def _header(account, hist, seq=1, day=5):
    return dict(
        accountnumber=account, consumptionhistid=hist, readsequence=seq, transactioncode=102,
        billdate=dt.datetime(2021, 3, day), numberofdays=30,
    )


def _by_premise(t, **kw):
    return blocks.block_use_by_premise(
        blocks.block_header(t.ciconsumptionhist),
        blocks.block_use(t.ciconsumptionhistblock),
        blocks.account_premise_link(t.fwacmas),
        **kw,
    )


def test_header_fans_out_to_premises(tables):  # R3
    t = tables(
        ciconsumptionhist=[_header(10, 1)],
        ciconsumptionhistblock=R1_BLOCKS,
        fwacmas=[dict(wacm_cust=10, wacm_premise_no=501), dict(wacm_cust=10, wacm_premise_no=502)],
    )
    assert rows(_by_premise(t), "premiseid", "tot_use", "tot_amt") == [(501, 12, 28), (502, 12, 28)]


def test_header_without_blocks_or_link(tables):  # R4
    t = tables(ciconsumptionhist=[_header(11, 9)])
    (r,) = _by_premise(t).collect()
    assert (r.premiseid, r.tot_use, r.tot_amt, r.blkuse_1, r.blkrate_5) == (None, 0, 0, None, None)


def test_hot_link_fans_out(tables):
    """A hot account meets all its premises; accounts without one keep their headers."""
    links = [dict(wacm_cust=10, wacm_premise_no=p) for p in range(40)] + [dict(wacm_cust=12, wacm_premise_no=7)]
    t = tables(
        ciconsumptionhist=[_header(10, 1), _header(10, 2), _header(12, 3), _header(13, 4)],
        ciconsumptionhistblock=R1_BLOCKS,
        fwacmas=links,
    )
    cols = ("premiseid", "accountnumber", "consumptionhistid", "tot_use")
    assert len(rows(_by_premise(t), *cols)) == 40 * 2 + 1 + 1


def test_invariants_on_standins(spark):
    """Pivot keys are unique; totals are never NULL; the pivot join keeps the header count."""
    from pyspark.sql import functions as F

    from aqualedger.sources.standins import standin_tables

    t = standin_tables(spark, "/root/testdata/sf0.001")
    piv = blocks.block_use(t.ciconsumptionhistblock)
    assert piv.count() == piv.select("consumptionhistid", "readsequence").distinct().count()
    hdr = blocks.block_header(t.ciconsumptionhist)
    joined = hdr.join(piv, ["consumptionhistid", "readsequence"], "left")
    assert joined.count() == hdr.count()
    tot = blocks.tier_totals(piv)
    assert tot.where(F.col("tot_use").isNull() | F.col("tot_amt").isNull()).count() == 0


def test_hot_keys_are_dealt_to_seats(spark):
    """A key with many rows on the right of a left join: its rows lie in as many partitions as
    it has seats at most, none of which holds much more than ``seat_rows`` of them."""
    from pyspark.sql import functions as F

    from aqualedger.operators.joins import split_join

    left = spark.range(6).selectExpr("id % 3 as a", "id as x")
    right = spark.range(4000).selectExpr("0L as b", "id as y").unionByName(spark.range(3).selectExpr("1L as b", "id as y"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = split_join(left, right, [("a", "b")], seat_rows=500).withColumn("part", F.spark_partition_id())
        parts = {r.part: r["count"] for r in joined.where("a = 0").groupBy("part").count().collect()}
        assert joined.count() == 2 * 4000 + 2 * 3 + 2
        two = split_join(left.distinct(), right, [("a", "b")], seat_rows=500, deal_left=True)
        assert two.count() == 2 * 4000 + 2 * 3 + 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(parts) >= 3 and max(parts.values()) < 0.7 * 8000

"""Bill lines and the transaction table (FIXTURES.md §C R15, R18, R23-R27, R29-R32)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from conftest import rows

from aqualedger.operators import bill_lines as bl
from aqualedger.operators import items, transactions, usage

START, END = 20210301, 20210331


def flat(cust=1, date=20210305, amt=5, class_num=3, rate=22, **kw):
    base = dict(
        cihis_cust=cust, cihis_date=date, cihis_service=0, cihis_class_num1=class_num, cihis_rate1=rate,
        cihis_from_date=3012021, cihis_to_date=3312021, cihis_amt=D(amt), cihis_type_code=34, cihis_class_type1=4,
    )
    base.update(kw)
    return base


def metered(cust=1, day=5, charge=7, rclass=5, rate=22, device="M1", hour=0, **kw):
    base = dict(
        accountnumber=cust, transactioncode=2, billdate=dt.datetime(2021, 3, day, hour), servicenumbersequence=0,
        device=device, devicecode=0, readingclass1=rclass, rate1=rate, previousreaddate=dt.datetime(2021, 3, 1),
        presentreaddate=dt.datetime(2021, 3, 31), consumption=D(1), billingamount=D(charge),
    )
    base.update(kw)
    return base


def bill(cust=1, date=20210305, code=99, ref=9001):
    return dict(cihis_cust=cust, cihis_date=date, cihis_code=code, cihis_reference=ref)


def header(account, hist, day=5):
    return dict(
        accountnumber=account, consumptionhistid=hist, readsequence=1, transactioncode=102,
        billdate=dt.datetime(2021, 3, day, 8), numberofdays=30,
    )


def block(hist, n=1, use=5, amt=10, rate=2):
    return dict(consumptionhistid=hist, readsequence=1, blocknumber=n, blockusage=D(use), blockamount=D(amt), blockrate=D(rate))


CUSTOMERS = [dict(customernumber=1, cisnumberofbilledaccount=100, premisenumber=501)]
REG = [dict(ciregister_device="M1", ciregister_device_cd=0, ciregister_num=1, ciregister_cmp_size=13)]


def lines(t, start=None, end=None):
    return transactions.bill_lines_in_window(t, start, end)


def test_two_periods_one_line(tables):  # R15: D8 part
    t = tables(
        fcihistv=[flat(), dict(cihis_cust=1, cihis_date=20210305, cihis_from_date=3012021, cihis_to_date=3312021, cihis_type_code=95),
                  dict(cihis_cust=1, cihis_date=20210305, cihis_from_date=2012021, cihis_to_date=2282021, cihis_type_code=95)],
        fcihistf=[bill()],
        wawatercustomermaster=CUSTOMERS,
    )
    assert items.billable_items(t.fcihistv, t.cibillableitem).count() == 2
    assert rows(lines(t), "totalcharges") == [(D(5),)]


def test_equal_charges_collapse(tables):  # R18, R23
    t = tables(
        ciconsumptionhist=[metered(charge=7, hour=0), metered(charge=7, hour=10), metered(charge=7, device="M2")],
        fcihistf=[bill()], wawatercustomermaster=CUSTOMERS,
    )
    assert usage.total_usage(t.ciconsumptionhist, t.wawatercustomermaster, t.fciregister).count() == 3
    assert lines(t).count() == 1


def test_different_charges_two_lines(tables):  # R17: D8 part
    t = tables(ciconsumptionhist=[metered(charge=7), metered(charge=8, hour=10)], fcihistf=[bill()], wawatercustomermaster=CUSTOMERS)
    assert rows(lines(t), "totalcharges") == [(D(7),), (D(8),)]


def test_bill_header_codes(tables):  # R24
    t = tables(
        fcihistv=[flat(cust=2)], ciconsumptionhist=[metered(cust=2)],
        fcihistf=[bill(cust=2, code=98), bill(cust=3, code=99)],
    )
    assert lines(t).count() == 0


def test_reading_and_item_equal_lines(tables):  # R29, R31
    same = dict(fcihistv=[flat(amt=7, class_num=3)], fciregister=REG, fcihistf=[bill()], wawatercustomermaster=CUSTOMERS)
    t = tables(ciconsumptionhist=[metered(charge=7, rclass=3)], **same)
    assert lines(t).count() == 1
    t = tables(ciconsumptionhist=[metered(charge=8, rclass=3)], **same)
    assert lines(t).count() == 2
    out = transactions.transactions(t, START, END)
    got = [tuple(r) for r in out.collect()]
    assert len(got) == 2 and got[0] == got[1]


def test_customer_listed_twice_lines(tables):  # R30
    t = tables(
        ciconsumptionhist=[metered()], fcihistf=[bill()],
        wawatercustomermaster=[dict(customernumber=1, premisenumber=501), dict(customernumber=1, premisenumber=502)],
    )
    assert rows(lines(t), "premisenumber", "totalcharges") == [(501, D(7)), (502, D(7))]


def test_window_bounds(tables):  # R25
    dates = [20210228, 20210301, 20210331, 20210401, None]
    t = tables(
        fcihistv=[flat(date=d) for d in dates], fcihistf=[bill(date=d) for d in dates], wawatercustomermaster=CUSTOMERS
    )
    assert rows(transactions.transactions(t, START, END), "bld") == [(20210301,), (20210331,)]


def test_null_premise_kept(tables):  # R26
    t = tables(
        fcihistv=[flat()], fcihistf=[bill()], wawatercustomermaster=[dict(customernumber=1, cisnumberofbilledaccount=100)],
        ciconsumptionhist=[header(1, 1)], ciconsumptionhistblock=[block(1)], fwacmas=[dict(wacm_cust=1)],
    )
    (r,) = transactions.transactions(t, START, END).collect()
    assert (r.prm, r.billdate, r.tot_use, r.t1_use) == (None, None, None, None)


def test_premise_day_fan_out_and_layout(tables):  # R27, R32
    t = tables(
        fcihistv=[flat(class_num=3)], ciconsumptionhist=[metered(rclass=5), header(1, 1), header(2, 2)],
        ciconsumptionhistblock=[block(1, 1, 5, 10, 2), block(1, 2, 3, 9, 3), block(2, 1, 4, 8, 2)],
        fwacmas=[dict(wacm_cust=1, wacm_premise_no=501), dict(wacm_cust=2, wacm_premise_no=501)],
        fcihistf=[bill()], fciregister=REG, wawatercustomermaster=CUSTOMERS,
    )
    out = transactions.transactions(t, START, END)
    assert len(out.columns) == 30 and out.columns[2] == "SIZE"
    assert rows(out, "rclass", "tot_use", "tot_amt", "t2_use") == [
        (3, D(4), D(8), None), (3, D(8), D(19), D(3)), (5, D(4), D(8), None), (5, D(8), D(19), D(3)),
    ]
    assert rows(out, "cus", "prm", "bld", "billdate", "numberofdays")[0] == (100, 501, 20210305, 20210305, 30)


def test_hot_premise_day_fans_out(tables):
    """Every line of a hot premise and day meets every header there."""
    hdrs = [header(a, a) for a in range(1, 30)]
    blks = [block(a, 1, a, a, 1) for a in range(1, 30)]
    links = [dict(wacm_cust=a, wacm_premise_no=501) for a in range(1, 30)]
    t = tables(
        fcihistv=[flat(), flat(cust=2, amt=9)], ciconsumptionhist=[metered(), *hdrs], ciconsumptionhistblock=blks,
        fwacmas=links, fcihistf=[bill(), bill(cust=2)], fciregister=REG,
        wawatercustomermaster=CUSTOMERS + [dict(customernumber=2, cisnumberofbilledaccount=7, premisenumber=501)],
    )
    assert transactions.transactions(t, START, END).count() == 3 * 29


def test_rate_class_enrichment_columns(tables):
    t = tables(
        fcihistv=[flat(rate=1)], fcihistf=[bill()], wawatercustomermaster=CUSTOMERS,
        ciratemaster=[dict(ratemasterid=1, ratekindid=0, rate=1, application=3)],
    )
    out = transactions.transactions(t, START, END, with_rate_class=True)
    assert out.columns[:2] == ["rclass", "rate_sch"] and "utl" in out.columns
    assert rows(out, "rate_sch", "utl") == [("RMWS", "W")]


def test_line_schema(tables):
    t = tables(fcihistv=[flat()], fcihistf=[bill()], wawatercustomermaster=CUSTOMERS)
    got = [(f.name, f.dataType) for f in lines(t).schema.fields]
    assert got == [(f.name, f.dataType) for f in bl.LINE_SCHEMA.fields]


def test_collapsed_lines_diagnostic(tables):  # Q1
    t = tables(
        ciconsumptionhist=[metered(charge=7, hour=0), metered(charge=7, hour=10), metered(charge=8, device="M2")],
        fcihistf=[bill()], wawatercustomermaster=CUSTOMERS,
    )
    heads = bl.bill_headers(t.fcihistf, t.wawatercustomermaster)
    tu = usage.total_usage(t.ciconsumptionhist, t.wawatercustomermaster, t.fciregister)
    r = bl.collapsed_lines(bl.bill_items_branch(heads, items.billable_items(t.fcihistv, t.cibillableitem)),
                           bl.bill_metered_branch(heads, tu)).first()
    assert (r.lines_before, r.lines_after, r.collapsed) == (3, 2, 1)


def test_invariants_on_standins(spark):
    """SURVEY §5 invariants: lines are distinct, every bill date is in the window, and the
    tier totals equal the sum of tiers 1..5 whenever a header matched."""
    from pyspark.sql import functions as F

    from aqualedger.sources.standins import standin_tables

    t = standin_tables(spark, "/root/testdata/sf0.001")
    ln = lines(t, 19950701, 19950731)
    assert ln.count() == ln.distinct().count() > 0
    out = transactions.transactions(t, 19950701, 19950731)
    assert out.where(~F.col("bld").between(19950701, 19950731) | F.col("bld").isNull()).count() == 0
    tiers = sum(F.coalesce(F.col(f"t{n}_use"), F.lit(0)) for n in range(1, 6))
    matched = out.where(F.col("billdate").isNotNull())
    assert matched.count() > 0
    assert matched.where(F.col("tot_use") != tiers).count() == 0

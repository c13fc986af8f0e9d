"""Metered usage (FIXTURES.md §C R17-R23, R30: D6 part)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from conftest import rows

from aqualedger.operators import usage


def reading(charge=7, hour=0, device=" M1 ", **kw):
    base = dict(
        accountnumber=1, transactioncode=2, billdate=dt.datetime(2021, 3, 5, hour), servicenumbersequence=0,
        device=device, devicecode=0, readingclass1=5, rate1=1, previousreaddate=dt.datetime(2021, 3, 1),
        presentreaddate=dt.datetime(2021, 3, 31, 12), consumption=D(1), billingamount=D(charge),
    )
    base.update(kw)
    return base


def _tu(t):
    return usage.total_usage(t.ciconsumptionhist, t.wawatercustomermaster, t.fciregister)


def test_two_bill_times_one_day(tables):  # R17
    t = tables(ciconsumptionhist=[reading(7, 0), reading(8, 10)])
    assert rows(_tu(t), "billdate", "totalcharges") == [(20210305, D(7)), (20210305, D(8))]


def test_fractional_days_and_keys(tables):  # R19
    t = tables(ciconsumptionhist=[reading()])
    assert rows(_tu(t), "days", "fromdate", "todate") == [(30.5, 20210301, 20210331)]


def test_register_join_untrimmed_output_trimmed(tables):  # R20
    t = tables(
        ciconsumptionhist=[reading(device="  A1 ")],
        fciregister=[dict(ciregister_device="  A1 ", ciregister_device_cd=0, ciregister_num=1, ciregister_cmp_size=2)],
    )
    assert rows(_tu(t), "mtr", "ssize") == [("A1", "0075")]


def test_register_two_only(tables):  # R21
    t = tables(
        ciconsumptionhist=[reading(device="  A1 ")],
        fciregister=[dict(ciregister_device="  A1 ", ciregister_device_cd=0, ciregister_num=2, ciregister_cmp_size=2)],
    )
    assert rows(_tu(t), "mtr", "ssize") == [("A1", "9999")]


def test_blank_device(tables):  # R22
    t = tables(ciconsumptionhist=[reading(device="    ")])
    assert rows(_tu(t), "mtr") == [(None,)]


def test_two_meters_stay_two_rows(tables):  # R23
    t = tables(ciconsumptionhist=[reading(device="A"), reading(device="B")])
    assert rows(_tu(t), "mtr") == [("A",), ("B",)]


def test_customer_listed_twice(tables):  # R30
    t = tables(
        ciconsumptionhist=[reading()],
        wawatercustomermaster=[dict(customernumber=1, premisenumber=501), dict(customernumber=1, premisenumber=502)],
    )
    assert rows(_tu(t), "premisenumber", "totalcharges") == [(501, D(7)), (502, D(7))]


def test_only_readings_counted(tables):
    t = tables(ciconsumptionhist=[reading(), reading(transactioncode=102), reading(transactioncode=7)])
    assert _tu(t).count() == 1


def test_raw_billdate_kept_on_request(tables):  # A6
    t = tables(ciconsumptionhist=[reading(7, 0), reading(8, 10)])
    out = usage.total_usage(t.ciconsumptionhist, t.wawatercustomermaster, t.fciregister, keep_raw_billdate=True)
    assert rows(out, "billdate_ts") == [(dt.datetime(2021, 3, 5, 0),), (dt.datetime(2021, 3, 5, 10),)]


def test_sorted_output_nulls_last(tables):  # O3
    t = tables(ciconsumptionhist=[reading(accountnumber=3), reading(accountnumber=None), reading(accountnumber=1)])
    out = usage.total_usage(t.ciconsumptionhist, t.wawatercustomermaster, t.fciregister, sorted=True)
    assert [r.accountnumber for r in out.collect()] == [1, 3, None]

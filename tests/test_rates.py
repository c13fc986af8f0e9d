"""Rate class branch (FIXTURES.md §C R12, R13, R28)."""

from __future__ import annotations

import datetime as dt

from conftest import rows

from aqualedger.operators import rates


def detail(master, ident, year, **kw):
    d = dict(ratemasterid=master, ratedetailid=ident, effectivedate=dt.datetime(year, 1, 1) if year else None)
    d.update(kw)
    return d


R12 = [detail(1, 10, 2020), detail(1, 11, 2021), detail(1, 12, 2021), detail(2, 13, None)]
MASTERS = [dict(ratemasterid=m, ratekindid=0, rate=1, application=3) for m in (1, 2, 3)]


def test_latest_keeps_ties_and_masters_without_detail(tables):  # R12
    t = tables(ciratemaster=MASTERS[:2], ciratedetail=R12)
    out = rates.latest_rate_detail(t.ciratemaster, t.ciratedetail)
    assert rows(out, "ratemasterid", "ratedetailid") == [(1, 11), (1, 12), (2, None)]


def test_latest_id_is_not_scoped_to_master(tables):  # R13
    t = tables(ciratemaster=MASTERS, ciratedetail=R12 + [detail(3, 10, 2022)])
    out = rates.latest_rate_detail(t.ciratemaster, t.ciratedetail)
    assert rows(out, "ratemasterid", "ratedetailid") == [(1, 10), (1, 11), (1, 12), (2, None), (3, 10)]


def test_group_max_matches_window_with_null_keys(tables):
    t = tables(ciratedetail=R12 + [detail(None, 20, 2019), detail(None, 21, 2018)])
    out = rates.latest_effective_date(t.ciratedetail)
    got = dict((r.ratedetailid, r.last_date) for r in out.collect())
    assert got[20] == got[21] == dt.datetime(2019, 1, 1)
    assert got[13] is None and got[10] == dt.datetime(2021, 1, 1)


def test_empty_text_is_null_for_nvl(tables):  # R28
    t = tables(
        ciratemaster=[dict(ratemasterid=1, ratekindid=0, rate=1, application=3, description="r")],
        ciratedetail=[detail(1, 10, 2021, billingdescription="")],
        ciitemratedetail=[dict(ratedetailid=10, itemcode=5, comments="x")],
    )
    out = rates.rate_class(t.ciratemaster, t.ciratekind, t.ciratedetail, t.ciitemratedetail, t.ciitemcode, t.cisteprate)
    assert rows(out, "bill_desc", "utl_typ", "rsch") == [("x", "W", "RMWS")]


def test_application_filter_and_sort(tables):
    t = tables(
        ciratemaster=[
            dict(ratemasterid=1, ratekindid=2, rate=50, application=3),
            dict(ratemasterid=2, ratekindid=0, rate=900, application=3),
            dict(ratemasterid=3, ratekindid=0, rate=1, application=1),
        ],
        ciratekind=[dict(ratekindid=0, description="metered"), dict(ratekindid=2, description="flat")],
    )
    out = rates.rate_class(
        t.ciratemaster, t.ciratekind, t.ciratedetail, t.ciitemratedetail, t.ciitemcode, t.cisteprate, sorted=True
    )
    assert [(r.ratekindid, r.rkind_desc, r.rsch) for r in out.collect()] == [(0, "metered", "NO BILL"), (2, "flat", "Backflow")]


def test_hot_master_keeps_every_tie(spark, tables):
    """One master with thousands of details, a third of them tied on the latest date, some
    repeated, some undated: all ties count, and older rows do not reach the shuffle."""
    dated = [detail(1, i, 2021 if i % 3 == 0 else 2000 + i % 20) for i in range(3000)] + [detail(1, 3, 2021)] * 50
    t = tables(ciratedetail=dated + [detail(1, 5000 + i, None) for i in range(100)] + [detail(2, 9000, 1990)])
    ids = rates.latest_detail_ids(t.ciratedetail)
    assert {r.ratedetailid for r in ids.collect()} == {i for i in range(0, 3000, 3)} | {9000}
    assert ids.count() == 1001
    assert "WindowGroupLimit" in ids._jdf.queryExecution().executedPlan().toString()

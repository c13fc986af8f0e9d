"""Flat-rate items (FIXTURES.md §C R14-R16) and the kept group keys."""

from __future__ import annotations

from decimal import Decimal as D

from conftest import rows

from aqualedger.operators import items


def _item(amt=5, **kw):
    base = dict(
        cihis_cust=1, cihis_date=20210305, cihis_service=0, cihis_class_num1=3, cihis_rate1=22,
        cihis_from_date=3012021, cihis_to_date=3312021, cihis_amt=D(amt), cihis_type_code=34, cihis_class_type1=4,
    )
    base.update(kw)
    return base


def _period(frm, to):
    return dict(cihis_cust=1, cihis_date=20210305, cihis_from_date=frm, cihis_to_date=to, cihis_type_code=95)


def test_same_period_twice_doubles_the_sum(tables):  # R14
    t = tables(fcihistv=[_item(), _period(3012021, 3312021), _period(3012021, 3312021)])
    out = items.billable_items(t.fcihistv, t.cibillableitem)
    assert rows(out, "totalcharges", "efd", "edt", "days", "ssize") == [(D(10), 20210301, 20210331, 30, "0125")]


def test_two_periods_split_the_groups(tables):  # R15
    t = tables(fcihistv=[_item(), _period(3012021, 3312021), _period(2012021, 2282021)])
    out = items.billable_items(t.fcihistv, t.cibillableitem)
    assert rows(out, "totalcharges", "efd") == [(D(5), 20210201), (D(5), 20210301)]


def test_no_billing_record_keeps_item(tables):  # R16
    t = tables(fcihistv=[_item()])
    out = items.billable_items(t.fcihistv, t.cibillableitem)
    assert rows(out, "totalcharges", "efd", "edt") == [(D(5), None, None)]


def test_item_filters_and_service_dates(tables):
    import datetime as dt

    t = tables(
        fcihistv=[_item(), _item(cihis_class_type1=1), _item(cihis_type_code=1)],
        cibillableitem=[dict(customernumber=1, servicenumber=0, dateiteminstalled=dt.datetime(2020, 1, 2, 8))],
    )
    out = items.item_service_dates(t.fcihistv, t.cibillableitem)
    assert rows(out, "serviceconnectdate", "serviceclosedate") == [(20200102, None)]


def test_window_filters_item_records(tables):
    t = tables(fcihistv=[_item(), _item(cihis_date=20210401)])
    out = items.billable_items(t.fcihistv, t.cibillableitem, 20210301, 20210331)
    assert rows(out, "cihis_date") == [(20210305,)]


def test_sorted_output_nulls_last(tables):  # O2
    t = tables(fcihistv=[_item(cihis_cust=2), _item(cihis_cust=None), _item(cihis_cust=1)])
    out = items.billable_items(t.fcihistv, t.cibillableitem, sorted=True)
    assert [r.cihis_cust for r in out.collect()] == [1, 2, None]


def test_repeated_billing_periods_diagnostic(tables):  # Q8
    t = tables(fcihistv=[_item(), _period(3012021, 3312021), _period(3012021, 3312021), _period(2012021, 2282021)])
    assert rows(items.repeated_billing_periods(t.fcihistv), "cihis_from_date", "copies") == [(3012021, 2)]


def test_repeated_periods_multiply_no_rows(spark, tables):
    """One customer and day: 2,000 items under 500 records of one period sum as written, but
    the join hands on 2,000 rows."""
    period = [_period(3012021, 3312021)] * 500
    t = tables(fcihistv=[_item(cihis_service=i) for i in range(2000)] + period)
    out = items.billable_items(t.fcihistv, t.cibillableitem)
    assert rows(out.groupBy("totalcharges", "efd").count(), "totalcharges", "efd", "count") == [(D(2500), 20210301, 2000)]
    joined = items._with_billing_period(items.item_records(t.fcihistv), items.period_copies(t.fcihistv))
    assert joined.count() == 2000


def test_hot_customer_day_is_split(spark, tables):
    """A hot (customer, bill date): the join with the billing periods shares its shuffles with no
    aggregate, so the final plan splits it without the forced setting, and the sums stay right."""
    t = tables(
        fcihistv=[_item(cihis_service=i, cihis_cust=1) for i in range(8000)]
        + [_item(cihis_cust=c) for c in range(2, 200)]
        + [_period(3012021, 3312021), _period(2012021, 2282021)],
        cibillableitem=[dict(customernumber=5000, servicenumber=0)],  # an empty side would drop its join
    )
    histv = t.fcihistv.repartition(8)  # many map tasks: a skewed partition is split by them
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",  # one map task's output is not split
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        out = items.billable_items(histv, t.cibillableitem)
        got = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(got) == 2 * 8000 + 198 and {r.totalcharges for r in got} == {D(5)}
    assert "skew=true" in plan

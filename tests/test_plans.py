"""Physical-plan checks on landed (column-typed) tables: the month reaches the Parquet
scans, no Python UDF, no cartesian product or nested-loop join."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from aqualedger.operators import transactions
from aqualedger.plans import checks
from aqualedger.sources.landing import read_tables
from aqualedger.sources.schemas import SCHEMAS


def _scans(df) -> list[str]:
    """Scan entries as text, for substring checks."""
    return [" | ".join(v for v in s.values()) for s in checks.scans(df)]


def test_month_pushed_to_history_scans(spark, tables, tmp_path):
    t = tables(
        fcihistv=[dict(cihis_cust=1, cihis_date=20210305, cihis_type_code=34, cihis_class_type1=4, cihis_amt=D(1))],
        fcihistf=[dict(cihis_cust=1, cihis_date=20210305, cihis_code=99)],
        ciconsumptionhist=[dict(accountnumber=1, transactioncode=2, billdate=dt.datetime(2021, 3, 5))],
    )
    for name in SCHEMAS:
        getattr(t, name).write.parquet(str(tmp_path / name))
    landed = read_tables(spark, str(tmp_path))
    scans = _scans(transactions.transactions(landed, 20210301, 20210331))
    hv = [s for s in scans if "cihis_class_type1" in s]
    assert hv and all("GreaterThanOrEqual(cihis_date,20210301)" in s for s in hv), hv
    hf = [s for s in scans if "cihis_code" in s]
    assert hf and all("LessThanOrEqual(cihis_date,20210331)" in s for s in hf), hf
    ch = [s for s in scans if "transactioncode" in s]
    assert ch and all("GreaterThanOrEqual(billdate,2021-03-01T00:00)" in s for s in ch), ch


def test_no_python_udf_no_cartesian(spark):
    from aqualedger.plans import catalog

    for key in ("transactions", "transactions_with_rate_class", "rate_class"):
        df = catalog.queries()[key](spark, "/root/testdata/sf0.001")
        assert checks.violations(df) == [], key


def test_scans_prune_columns(spark):
    from aqualedger.plans import catalog

    df = catalog.queries()["block_header"](spark, "/root/testdata/sf0.001")
    (orders,) = [s for s in checks.scans(df) if "orders" in s["location"]]
    assert "o_totalprice" not in orders["read_schema"] and "o_orderdate" in orders["read_schema"]
    assert checks.exchange_count(df) == 0  # a filter and a projection of one table, united with a join


def test_month_partitions_pruned(spark, tables, tmp_path):
    """History landed by bill month: the window prunes partitions of every history scan,
    blocks included, and the result equals the unpartitioned run."""
    import datetime as dt

    from aqualedger.sources.sinks import land_tables

    def hdr(hist, day, month=3):
        return dict(accountnumber=1, consumptionhistid=hist, readsequence=1, transactioncode=102,
                    billdate=dt.datetime(2021, month, day, 8), numberofdays=30)

    t = tables(
        fcihistv=[dict(cihis_cust=1, cihis_date=20210305, cihis_type_code=34, cihis_class_type1=4, cihis_amt=D(1),
                       cihis_from_date=3012021, cihis_to_date=3312021, cihis_rate1=1, cihis_class_num1=1, cihis_service=0)],
        fcihistf=[dict(cihis_cust=1, cihis_date=20210305, cihis_code=99, cihis_reference=7),
                  dict(cihis_cust=1, cihis_date=20210405, cihis_code=99, cihis_reference=8)],
        ciconsumptionhist=[hdr(1, 5), hdr(2, 5, month=4)],
        ciconsumptionhistblock=[dict(consumptionhistid=h, readsequence=1, blocknumber=1, blockusage=D(h),
                                     blockamount=D(1), blockrate=D(1)) for h in (1, 2)],
        fwacmas=[dict(wacm_cust=1, wacm_premise_no=5)],
        wawatercustomermaster=[dict(customernumber=1, cisnumberofbilledaccount=2, premisenumber=5)],
    )
    land_tables(t, str(tmp_path))
    landed = read_tables(spark, str(tmp_path), known_schema=True)
    out = transactions.transactions(landed, 20210301, 20210331)
    scans = _scans(out)
    month_scans = [s for s in checks.scans(out) if "bill_month" in s["partition_filters"]]
    assert len(month_scans) >= 4, scans
    assert all("202103" in s["partition_filters"] for s in month_scans)
    lines = transactions.bill_lines_in_window(landed, 20210301, 20210331)  # the plan of bill_date_range
    history = [s for s in checks.scans(lines) if any(f"/{n}]" in s["location"] for n in ("fcihistv", "fcihistf", "ciconsumptionhist"))]
    assert len(history) >= 4
    for s in history:
        assert "202103" in s["partition_filters"], s
        assert any(f"GreaterThanOrEqual({c},2021" in s["pushed_filters"] for c in ("cihis_date", "billdate")), s
    got = sorted(tuple(r) for r in out.drop("dys").collect())
    want = sorted(tuple(r) for r in transactions.transactions(t, 20210301, 20210331).drop("dys").collect())
    assert got == want and len(got) == 1 and got[0][-16] == D(1)


def test_final_plan_shares_headers_and_scans(spark):
    """Executed plans: both branches of the union read the billing records once (as do the counts of
    their split joins), and the latest rate details take two reads of the details."""
    from aqualedger.plans import catalog

    def final(df) -> str:
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]

    lines = final(catalog.queries()["bill_lines_union"](spark, "/root/testdata/sf0.01"))
    headers = [x for x in lines.splitlines() if "FileScan" in x and "o_orderpriority" in x]
    assert 1 <= len(headers) <= 2, headers  # at most one for the billing records and one for the billable items
    rates = final(catalog.queries()["rate_class"](spark, "/root/testdata/sf0.01"))
    assert sum("FileScan" in x and "l_partkey" in x for x in rates.splitlines()) <= 2


def test_every_role_is_scanned_once(spark, tmp_path):
    """Executed plan of the transaction table over landed tables, with every join shuffled: each
    role of a table is scanned at most once, though the split joins count their keys as well."""
    import collections
    import re

    from aqualedger.sources.sinks import land_tables
    from aqualedger.sources.standins import standin_tables

    land_tables(standin_tables(spark, "/root/testdata/sf0.001"), str(tmp_path))
    landed = read_tables(spark, str(tmp_path), known_schema=True)
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        out = transactions.transactions(landed, 19950701, 19950731, with_rate_class=True)
        assert len(out.collect()) > 0
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    scans = [x for x in plan.splitlines() if "FileScan" in x]
    roles = collections.Counter(re.search(r"ReadSchema: (.*)", x).group(1) for x in scans)  # no two tables or roles read the same columns
    assert max(roles.values()) == 1, roles
    assert len(scans) <= 18 and "ReusedExchange" in plan, len(scans)
    assert sum("ratemasterid" in r and "ratedetailid" in r for r in roles) <= 2, roles  # the details, and their latest ids


def test_window_relation_prunes_partitions_when_it_runs(spark, tmp_path):
    """A window held by a relation: every history scan has subqueries as partition filters, reads only
    the window's partitions, and the rows are those of the window given as numbers."""
    import re

    from aqualedger.functions.datekeys import date_range, window_keys
    from aqualedger.plans.catalog import WINDOW
    from aqualedger.sources.sinks import land_tables
    from aqualedger.sources.standins import standin_tables

    land_tables(standin_tables(spark, "/root/testdata/sf0.001"), str(tmp_path))
    landed = read_tables(spark, str(tmp_path), known_schema=True)
    out = transactions.transactions(landed, *window_keys(date_range(spark, *WINDOW)))
    history = ("fcihistv", "fcihistf", "ciconsumptionhist", "ciconsumptionhistblock")
    scans = [s for s in checks.scans(out) if any(f"/{n}]" in s["location"] for n in history)]
    assert len(scans) >= 5
    for s in scans:
        assert s["partition_filters"].count("scalar-subquery") + s["partition_filters"].count("Subquery") >= 2, s
    assert checks.violations(out) == []
    got = sorted(out.collect(), key=repr)
    assert got == sorted(transactions.transactions(landed, *WINDOW).collect(), key=repr) and got
    read, todo = [], [out._jdf.queryExecution().executedPlan()]
    while todo:  # partitions read by the scans that ran
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "FileSourceScanExec" and "bill_month" in node.toString():
            metric = node.metrics().get("numPartitions")
            read.append(metric.get().value())
            continue
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif re.search("QueryStageExec$", kind):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    assert read and max(read) == 1, read


def test_window_relation_bounds(spark, tables):
    """A relation without rows or with a NULL bound gives no rows; one of two rows is an error;
    bounds of both kinds are refused; any column names do."""
    import pytest

    from aqualedger.functions.datekeys import date_range, window_keys

    def hist(*days):
        return [dict(accountnumber=1, consumptionhistid=d, readsequence=1, transactioncode=102, billdate=dt.datetime(2021, 3, d, 23, 59, 59)) for d in days]

    from aqualedger.operators.blocks import block_header

    ch = tables(ciconsumptionhist=hist(1, 2, 30, 31)).ciconsumptionhist
    ids = lambda window, **names: sorted(r.consumptionhistid for r in block_header(ch, *window_keys(window, **names)).collect())
    assert ids(date_range(spark, 20210302, 20210330)) == [2, 30]
    assert ids(date_range(spark, 20210302, 20210330).toDF("a", "b"), start="a", end="b") == [2, 30]
    assert ids(spark.createDataFrame([(20210331, 20210401)], "start_date long, end_date long")) == [31]
    assert ids(spark.createDataFrame([], "start_date int, end_date int")) == []
    assert ids(spark.createDataFrame([(20210301, None)], "start_date int, end_date int")) == []
    with pytest.raises(Exception, match="(?i)scalar.subquery"):
        ids(spark.createDataFrame([(20210301, 20210331), (20210301, 20210302)], "start_date int, end_date int"))
    with pytest.raises(ValueError):
        block_header(ch, window_keys(date_range(spark, 20210302, 20210330))[0], 20210330)

"""Driver-style check: every registered query against its DuckDB oracle SQL on the
stand-in tables at sf0.001 (row count, column names, multiset of values)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from aqualedger.plans import catalog
from oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_every_query_has_oracle_sql():
    assert set(catalog.queries()) <= set(entry.queries()) and set(catalog.queries()) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["rclass", "sch", "SIZE"]


@pytest.mark.parametrize("key", sorted(catalog.queries()))
def test_query_matches_oracle(spark, key):
    res = compare(spark, SF, [key])[key]
    assert res["names_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["values_match"], res


def test_column_types_match_oracle(spark):
    """Same column types in both engines (Spark type -> DuckDB type), for every key."""
    from oracle_check import duck

    names = {"LongType()": "BIGINT", "IntegerType()": "INTEGER", "DoubleType()": "DOUBLE", "StringType()": "VARCHAR",
             "TimestampNTZType()": "TIMESTAMP"}
    con = duck(SF)
    qs, sqls = entry.queries(), entry.oracle_sql()
    for key in catalog.queries():
        spark_types = {f.name.lower(): names.get(str(f.dataType), str(f.dataType)) for f in qs[key](spark, SF).schema.fields}
        duck_types = {r[0].lower(): r[1] for r in con.execute(f"DESCRIBE ({sqls[key]})").fetchall()}
        assert spark_types == duck_types, key

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aqualedger.session import local_session  # noqa: E402
from aqualedger.sources.landing import BillingTables  # noqa: E402
from aqualedger.sources.schemas import SCHEMAS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, shuffle_partitions=8, app="aqualedger-tests")
    yield s
    s.stop()


@pytest.fixture()
def tables(spark):
    """Build BillingTables from literal rows: ``tables(fcihistv=[{...}, ...], ...)``.
    Missing columns are NULL; missing tables are empty."""

    def build(**rows: list[dict]) -> BillingTables:
        unknown = set(rows) - set(SCHEMAS)
        assert not unknown, unknown
        frames = {}
        for name, schema in SCHEMAS.items():
            data = [tuple(r.get(f.name) for f in schema.fields) for r in rows.get(name, [])]
            for r in rows.get(name, []):
                extra = set(r) - set(schema.fieldNames())
                assert not extra, (name, extra)
            frames[name] = spark.createDataFrame(data, schema)
        return BillingTables.from_mapping(frames)

    return build


def rows(df, *cols):
    """Rows as sorted tuples of the given columns (None sorts first)."""
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))

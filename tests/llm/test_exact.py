from __future__ import annotations

import hashlib
from collections import defaultdict

from aqualedger.llm import exact


def brute(docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[t or ""].append(i)
    out = []
    for i, t in docs:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


DOCS = [(1, None), (2, ""), (3, "a"), (4, "a "), (5, "A"), (6, "a"), (6, "a"), (None, "a"), (None, "zz"), (None, "zz"), (7, "é" * 200_000), (8, "é" * 200_000)]
DOCS += [(100 + i, "one large group") for i in range(50)] + [(200 + i, f"unique {i}") for i in range(300)]


def check(spark, **more):
    df = spark.createDataFrame([(i, t, b"x", True) for i, t in DOCS], "doc_id long, text string, digest binary, kept boolean").repartition(4)
    found = exact.exact_dedup(df, **more).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found), key=str) == brute(DOCS)
    return found


def test_matches_brute_force_and_only_possible_repeats_shuffle(spark):
    found = check(spark)
    assert not any(r.passed for r in found if r.group_size > 1)
    assert sum(r.passed for r in found) >= 290  # of 303 unique rows


def test_a_full_filter_loses_nothing(spark):
    check(spark, bits_per_row=1, hashes=1, max_filter_bits=64)


def test_rows_beyond_one_filter_still_pass(spark):
    found = check(spark, max_filter_bits=1 << 10)  # six parts
    assert not any(r.passed for r in found if r.group_size > 1)
    assert sum(r.passed for r in found) >= 285  # of 303 unique rows


def test_empty_table_and_native_plan(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = exact.exact_dedup(df)
    assert out.count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan

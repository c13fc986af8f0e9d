from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np

from aqualedger.llm import packing


def brute_pack(sizes, clusters, sources, capacity, per_source):
    bins, out = [], []
    for n, c, s in zip(sizes, clusters, sources):
        fits = [(capacity - b["used"] - 0, i) for i, b in enumerate(bins) if capacity - b["used"] >= n and (c is None or c not in b["c"]) and (s is None or b["s"][s] < per_source)]
        if fits:
            i = min(fits)[1]
        else:
            bins.append({"used": 0, "c": set(), "s": Counter()})
            i = len(bins) - 1
        bins[i]["used"] += n
        bins[i]["c"].add(c)
        bins[i]["s"][s] += 1
        out.append(i)
    return out


def test_best_fit_matches_brute_force():
    rng = random.Random(4)
    for case in range(20):
        n = rng.randint(1, 200)
        sizes = sorted((rng.randint(1, 100) for _ in range(n)), reverse=True)
        clusters = [rng.choice([None, 1, 1, *range(2, 40)]) for _ in range(n)]
        sources = [rng.choice([None, "hot", "hot", "a", "b"]) for _ in range(n)]
        per = rng.randint(1, 3)
        got = packing.pack_group(np.array(sizes), clusters, sources, 100, per)
        assert got.tolist() == brute_pack(sizes, clusters, sources, 100, per)


DOCS = [(i, "word " * (i % 50 + 1) + str(i), "hot" if i % 3 else "s") for i in range(400)] + [(1000 + i, "copied text", f"s{i % 5}") for i in range(150)]
DOCS += [(2000, None, None), (2001, "", "s"), (None, "no id", None), (2002, "w " * 100_000, "s"), (2003, "w " * 200, "s"), (2004, "same row", "s"), (2004, "same row", "s")]


def test_bins_hold_and_conflict_free(spark):
    df = spark.createDataFrame([(*d, 9, "c") for d in DOCS], "doc_id long, text string, source string, n_words int, bin string").repartition(4)
    rows = packing.best_fit(df, capacity=200, per_source=3, group_rows=100).collect()
    assert len(rows) == len(DOCS)
    bins, text = defaultdict(list), {d[0]: d[1] for d in DOCS}
    for r in rows:
        assert r.full_bins * 200 + r.bin_words == r.n_words == max(1, len((text[r.doc_id] or "").split()))
        assert (r.bin is None) == (r.bin_words == 0)
        if r.bin is not None:
            bins[r.bin_group, r.bin].append(r)
    for held in bins.values():
        assert sum(r.bin_words for r in held) <= 200
        words = Counter(t for r in held if (t := " ".join((text[r.doc_id] or "").lower().split())))
        assert max(words.values(), default=1) == 1
        assert max(Counter(r.source for r in held if r.source).values(), default=0) <= 3


def test_equal_rows_spread_over_groups(spark):
    rows = [(None, "the same words", "hot")] * 600 + [(i, f"text {i}", "s") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = packing.best_fit(df, capacity=200, group_rows=100).collect()
    assert len(out) == 1000 and sum(r.doc_id is None for r in out) == 600
    assert max(Counter(r.bin_group for r in out).values()) < 200
    copies = [(r.bin_group, r.bin) for r in out if r.doc_id is None]
    assert len(set(copies)) == 600


def test_empty_table(spark):
    assert packing.best_fit(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0

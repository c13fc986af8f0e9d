"""MinHash near-duplicates (op13): sketches, blocks and components against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from aqualedger.llm import minhash


def set_of(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(docs, k, percent, components=False):
    """(doc_id, n_shingles, component_id, kept) of every row, over all pairs of rows; or the
    smallest id of every component."""
    sets = [set_of(t, k) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    if components:
        return sorted(least.values())
    return sorted(((d, len(sets[i]), least.get(find(i)), d == least.get(find(i))) for i, (d, _) in enumerate(docs)), key=str)


def found(df, **options):
    return sorted((tuple(r) for r in minhash.minhash_components(df, **options).collect()), key=str)


def families(rng, n_bases=12, copies=12, words=60):
    """Texts of several families whose copies differ in few to many words."""
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(n_bases):
        base = [rng.choice(vocabulary) for _ in range(words)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(words)] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    return texts


ODD = [(900, ""), (901, None), (902, " \t\n"), (903, "one"), (904, "One"), (905, "one two"), (906, "one two three"), (None, "one two"), (None, ""), (None, "nothing like it at all"), (903, "one"), (903, "another text of id 903")]


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 100, 3000):
        s = minhash.sketch(rng.integers(0, 2**63, n).astype(np.uint64), 252)
        assert (s >> np.uint64(32)).max() < 2 * 252  # filled within the guaranteed rounds
    a = np.unique(rng.integers(0, 2**63, 900).astype(np.uint64))
    agree = []
    for _ in range(60):
        b = np.concatenate([rng.choice(a, 800, replace=False), rng.integers(0, 2**63, 100).astype(np.uint64)])
        agree.append((minhash.sketch(a, 252) == minhash.sketch(b, 252)).mean())
    assert abs(np.mean(agree) - 0.8) < 0.02 and np.std(agree) < 0.035


def test_sketch_does_not_hang_on_the_rounds_drawn_at_a_time():
    elements = np.arange(1, 40, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    t, values = 252, {}
    for i in map(np.uint64, range(2 * t)):  # one round after the other, as the definition says
        drawn = minhash._mixed(elements + np.array([i + np.uint64(1)]) * minhash.ODD)
        for x in drawn.tolist():
            place = (x >> 32) % t if i < t else int(i) - t
            values[place] = min(values.get(place, 1 << 64), int(i) << 32 | x & 0xFFFFFFFF)
    assert minhash.sketch(elements, t).tolist() == [values[p] for p in range(t)]


@pytest.mark.parametrize("block", [1 << 18, 600, 150])
def test_components_are_brute_force(spark, monkeypatch, block):
    """Also where groups are cut into size classes and blocks."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(11)
    texts = families(rng)
    docs = [(i, t) for i, t in enumerate(rng.sample(texts, len(texts)))] + ODD
    docs += [(500 + i, docs[i][1].upper()) for i in range(0, 60, 3)] + docs[:10]  # copies and repeated rows
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert found(df, shingle_words=4, percent=80) == brute(docs, 4, 80)


def test_five_words_by_default_and_other_thresholds(spark):
    rng = random.Random(2)
    docs = list(enumerate(families(rng, 5, 8)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(df) == brute(docs, 5, 80)
    assert found(df, percent=100) == brute(docs, 5, 100)
    with pytest.raises(ValueError):
        minhash.minhash_components(df, percent=0)


def test_exact_threshold_links(spark):
    """|A and B| = 8 of |A or B| = 10 links at 80 percent; 7 of 9 does not."""
    at = " ".join(f"a{i}" for i in range(12))  # 9 shingles of 4 words
    docs = [(1, at), (2, at + " z"), (3, at + " z y"), (4, at + " z y x")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    # a small set shares few coordinates by chance, so the bands of this test are short ones
    assert found(df, shingle_words=4, bands=126, rows=2) == brute(docs, 4, 80)


def test_empty_tables_long_texts_and_clashing_columns(spark):
    schema = "doc_id long, text string, node int, tag string, n double, own_id int, component_id int"
    empty = spark.createDataFrame([], schema)
    assert minhash.minhash_components(empty).count() == 0 and minhash.near_dedup(empty).count() == 0
    long = " ".join(str(i * i) for i in range(200_000))
    rows = [(2, long, 1, "t", 0.5, 1, 1), (1, long + " more", 1, "t", 0.5, 1, 1), (3, None, None, None, None, None, None), (None, " ", 1, "t", 0.5, 1, 1)]
    df = spark.createDataFrame(rows, schema)
    assert found(df, shingle_words=4) == brute([r[:2] for r in rows], 4, 80)
    kept = minhash.near_dedup(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3]


def test_near_dedup_keeps_one_row_of_each_component(spark):
    rng = random.Random(4)
    docs = list(enumerate(families(rng, 4, 6))) + [(1000 + i, "same text of some words here") for i in range(50)] + [(7, "same text of some words here")] * 5
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = sorted(r.doc_id for r in minhash.near_dedup(df).collect())
    assert kept == brute(docs, 5, 80, components=True)


def test_hot_group_is_cut_into_bounded_blocks(spark, monkeypatch):
    """Every two members of a large group whose sizes allow a link meet in exactly one task."""
    monkeypatch.setattr(minhash, "BLOCK", 100)
    sizes = {node: 10 + node % 30 for node in range(200)}
    members = spark.createDataFrame([(node, 0, n) for node, n in sizes.items()], "node long, component long, n long")
    tasks = {}
    for r in minhash._blocks(members, 80).collect():
        tasks.setdefault((r.g, r.a, r.b, r.i, r.j), []).append((r.node, r.side))
    met = {}
    for key, seats in tasks.items():
        assert sum(sizes[n] for n, _ in seats) <= 6 * 100
        left, right = [n for n, s in seats if s == 0], [n for n, s in seats if s == 1]
        one_block = key[1] == key[2] and key[3] == key[4]
        pairs = [(a, b) for a in left for b in left if a < b] if one_block else [(a, b) for a in left for b in right]
        for a, b in pairs:
            met[min(a, b), max(a, b)] = met.get((min(a, b), max(a, b)), 0) + 1
    for a in sizes:
        for b in sizes:
            if a < b and 100 * min(sizes[a], sizes[b]) >= 80 * max(sizes[a], sizes[b]):
                assert met.get((a, b)) == 1, (a, b)

from __future__ import annotations

import random

import numpy as np
import xxhash

from aqualedger.llm import components, simhash


def brute_fingerprint(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, w = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            if w:
                words.append(w)
            w = ""
        else:
            w += c
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps, d=4):
    root = {i: i for i in range(len(ids))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= d:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    comp = [find(i) for i in range(len(ids))]
    least = {}
    for i, c in zip(ids, comp):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return [least.get(c) for c in comp]


def test_fingerprint_matches_brute_force():
    rng = random.Random(1)
    words = ["Alpha", "beta", "Ärger", "ÉTÉ", "x", "long" * 30, "日本"]
    for n in (0, 1, 2, 3, 4, 5, 30, 400):
        t = "".join(rng.choice(words) + rng.choice([" ", "\n", "\t ", " ", "\x0b"]) for _ in range(n))
        assert simhash.fingerprint(t) == brute_fingerprint(t), n
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def test_blockwise_hashing_equals_whole(monkeypatch):
    t = " ".join(str(i % 97) for i in range(1000))
    whole = simhash.fingerprint(t)
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 7)
    assert simhash.fingerprint(t) == whole


def near_copies(rng, n_random=300, n_near=120):
    fps = [rng.getrandbits(64) for _ in range(n_random)]
    for _ in range(n_near):
        f = rng.choice(fps)
        for b in rng.sample(range(64), rng.randint(1, 5)):
            f ^= 1 << b
        fps.append(f)
    return sorted(set(fps + [0, 1, (1 << 64) - 1]))


def linked(fps, u, v):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in zip(u, v):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(f) for f in fps]


def test_ball_links_lose_no_link_at_any_split(monkeypatch):
    fps = near_copies(random.Random(2))
    want = brute_components(fps, fps)
    for limit in (4_000_000, 2_000):
        monkeypatch.setattr(simhash, "VARIANTS_AT_ONCE", limit)
        u, v = [], []
        arr = np.array(fps, dtype=np.uint64)
        for part in range(16):
            a, b = simhash.ball_links(part, arr, 4, 2)
            u += a.view(np.uint64).tolist()
            v += b.view(np.uint64).tolist()
        assert linked(fps, u, v) == want
        assert all((a ^ b).bit_count() <= 64 for a, b in zip(u, v))


def test_hot_parts_are_dealt_again(spark, monkeypatch):
    rng = random.Random(3)
    base = rng.getrandbits(64)
    fps = {base}
    while len(fps) < 400:  # one large group of near copies
        f = rng.choice(sorted(fps)) ^ (1 << rng.randrange(64))
        fps.add(f)
    fps = sorted(fps | {rng.getrandbits(64) for _ in range(50)})
    monkeypatch.setattr(simhash, "VARIANTS_AT_ONCE", 20_000)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    links = simhash.near_links(df).collect()
    as_u = lambda x: int(np.int64(x).astype(np.uint64))
    assert linked(fps, [as_u(r.u) for r in links], [as_u(r.v) for r in links]) == brute_components(fps, fps)


DOCS = [
    (1, "one two three four five six"), (2, "ONE two three four five six"), (3, "one two three four five six"),
    (9, None), (8, ""), (4, " \t\n"), (5, "solo"), (6, "solo"), (6, "solo"), (None, "solo"), (None, "nobody else here at all"),
    (7, "w " * 30_000), (10, " ".join(str(i) for i in range(500))), (11, " ".join(str(i) for i in range(501))),
]


def test_components_match_brute_force(spark):
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in DOCS], "doc_id long, text string, fp string, component int")
    got = sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.simhash_components(df).collect()), key=str)
    fps = [brute_fingerprint(t) for _, t in DOCS]
    want = sorted(zip([i for i, _ in DOCS], fps, brute_components([i for i, _ in DOCS], fps)), key=str)
    assert got == want
    kept = simhash.near_dedup(df)
    assert kept.columns == df.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {i for i in ids if i is not None} == {c for *_, c in want if c is not None}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_components(df).count() == 0 and simhash.near_dedup(df).count() == 0


def test_connected_components_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 400)]
    df = spark.createDataFrame(chain + star + [(5, 5), (7, 200)], "u long, v long").repartition(8)
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    assert got == {i: 100 for i in range(101, 161)} | {i: 7 for i in range(200, 400)}


def test_one_row_of_each_component_stays(spark):
    rows = [(None, "one text that has no id", "a"), (None, "one text that has no id", "a"), (None, "one text that has no id", "b")]
    rows += [(None, None, "a"), (3, "", "a"), (3, "three and other words here", "a"), (3, "three and other words here", "b"), (4, "three and other words here", "a")]
    rows += [(5, "five with words of its own", "a")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = sorted(((r.doc_id, r.text) for r in simhash.near_dedup(df).collect()), key=str)
    assert kept == sorted([(None, "one text that has no id"), (3, ""), (3, "three and other words here"), (5, "five with words of its own")], key=str)
    first = sorted(map(str, simhash.near_dedup(df).collect()))
    assert first == sorted(map(str, simhash.near_dedup(df.repartition(5)).collect()))

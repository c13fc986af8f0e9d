from __future__ import annotations

import math
from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aqualedger.llm import mixing


DOCS = [(i, f"text {i}", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(900)] + [(None, None, None), (5000, "", None), (7, "text 7", "s0"), (7, "text 7", "s0"), (5001, "w " * 100_000, "s1")]


@pytest.mark.parametrize("weights", [None, {}, 0.5, {"hot": 1.0, "s1": 3.0}])
def test_mix_keeps_all_rows_and_tracks_weights(spark, weights, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 50)
    df = spark.createDataFrame([(*d, 1, "c") for d in DOCS], "doc_id long, text string, source string, rank int, MIX_SLOT string").repartition(4)
    out = mixing.mix(df, weights, block_docs=10, frame=64)
    assert out.columns == [*df.columns, "_mix_slot", "mix_pos"]
    rows = out.collect()
    assert sorted(((r.doc_id, r.text, r.source) for r in rows), key=str) == sorted(DOCS, key=str)
    assert len({(r._mix_slot, r.mix_pos) for r in rows}) == len(rows)
    owner = {}
    for r in rows:
        assert owner.setdefault(r._mix_slot, r.source) == r.source and 0 <= r.mix_pos < 10
    if weights is None:  # every source keeps its share to the end
        order, n = [owner[t] for t in sorted(owner)], Counter(owner.values())
        for t in range(1, len(order) + 1):
            for s, c in Counter(order[:t]).items():
                assert abs(c - n[s] * t / len(order)) <= 2
    shuffled = mixing.mixed(df, weights, block_docs=10, frame=64)
    assert shuffled.columns == df.columns and shuffled.count() == len(DOCS)


def test_empty_table_and_limits(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(df).count() == 0 and mixing.mix(df, {}).count() == 0 and mixing.mix(df, 0.5).count() == 0
    some = spark.createDataFrame(DOCS, "doc_id long, text string, source string")
    with pytest.raises(ValueError):
        mixing.mix(some, max_sources=3)
    with pytest.raises(ValueError):
        mixing.mix(some, {"hot": 0.0})


def lags(order, blocks, weights):
    """Largest distance of any source from its ideal share, over all slots.  At virtual time v
    a source has min(w v, n) blocks and the slot is the sum."""
    ends = sorted({Fraction(blocks[s]) / weights[s] for s in blocks})
    got, worst, p = Counter(), Fraction(0), 0
    for t, s in enumerate(order, 1):
        got[s] += 1
        while sum(min(weights[x] * ends[p], blocks[x]) for x in blocks) < t:
            p += 1
        live = [x for x in blocks if Fraction(blocks[x]) / weights[x] >= ends[p]]
        v = (t - sum(blocks[x] for x in blocks if x not in live)) / sum(weights[x] for x in live)
        worst = max(worst, *(abs(got[x] - min(weights[x] * v, blocks[x])) for x in blocks))
    assert got == Counter(blocks)
    return worst


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.floats(1e-4, 100)), min_size=1, max_size=8))
def test_schedule_stays_within_one_block_of_the_real_weights(sources):
    blocks = {str(i): n for i, (n, _) in enumerate(sources)}
    whole, _ = mixing.whole_weights({str(i): w for i, (_, w) in enumerate(sources)})
    order = [str(i) for i, _ in mixing.schedule(mixing.Ideal(list(blocks.values()), list(whole.values())))]
    assert lags(order, blocks, {s: Fraction(w) for s, (_, w) in zip(blocks, sources)}) < 1


def windows(blocks, weights):
    """(release, due) of every block, from the ideal mixture alone."""
    def slot(v):
        return sum(min(w * v, Fraction(n)) for n, w in zip(blocks, weights))

    return {(s, i): (math.floor(slot(Fraction(i, w))), math.ceil(slot(Fraction(i + 1, w)))) for s, (n, w) in enumerate(zip(blocks, weights)) for i in range(n)}


def plain_edf(window):
    """Earliest deadline first, slot by slot over all blocks."""
    left, out = dict(window), []
    for t in range(len(window)):
        _, s, i = min((due, s, i) for (s, i), (release, due) in left.items() if release <= t)
        out.append((s, i))
        del left[s, i]
    return out


SOURCES = st.lists(st.tuples(st.integers(0, 60), st.integers(1, 30)), min_size=1, max_size=9)


@settings(max_examples=60, deadline=None)
@given(SOURCES)
def test_schedule_is_earliest_deadline_first(sources):
    blocks, weights = [n for n, _ in sources], [w for _, w in sources]
    assert list(mixing.schedule(mixing.Ideal(blocks, weights))) == plain_edf(windows(blocks, weights))


@settings(max_examples=200, deadline=None)
@given(SOURCES, st.integers(0, 20))
def test_stretches_scheduled_apart_keep_every_window(sources, more):
    blocks, weights = [n for n, _ in sources], [w for _, w in sources]
    window = windows(blocks, weights)
    span = math.ceil(Fraction(sum(weights), min(weights))) + 2 + more
    order = [x for t in range(0, sum(blocks), span) for x in mixing.schedule(mixing.Ideal(blocks, weights), t, t + span)]
    assert sorted(order) == sorted(window)
    assert all(window[x][0] <= t < window[x][1] for t, x in enumerate(order))
    assert lags([s for s, _ in order], {s: n for s, n in enumerate(blocks) if n}, dict(enumerate(weights))) < 1 if sum(blocks) else not order


def test_stretches_meet_in_spark(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STRETCH", 50)
    monkeypatch.setattr(mixing, "SLOTS_PER_SOURCE", 1)
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 20)
    monkeypatch.setattr(mixing, "BUCKETS_PER_RANGE", 7)
    rows = [(i, f"text {i}", f"s{min(i % 13, 6)}") for i in range(3000)]
    order = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), 0.5, block_docs=2, frame=16).orderBy("mix_slot", "mix_pos").collect()
    assert sorted((r.doc_id, r.text, r.source) for r in order) == sorted(rows)
    n = Counter(r[2] for r in rows)
    names = sorted(n)
    window = windows([-(-n[s] // 2) for s in names], [round(1000 * n[s] ** 0.5) for s in names])
    blocks = {}
    for r in order:
        blocks.setdefault(r.mix_slot, []).append(r.source)
    assert sorted(blocks) == list(range(len(window))) and all(len(set(x)) == 1 for x in blocks.values())
    done = Counter()
    for t in sorted(blocks):
        s = names.index(blocks[t][0])
        release, due = window[s, done[s]]
        assert release <= t < due
        done[s] += 1


@pytest.mark.parametrize("weights", [{}, {"s0": 0.37, "s1": 0.0001, "s2": 1.1}])
def test_mixture_keeps_to_the_real_weights_over_many_frames(spark, weights):
    rows = [(i, f"text {i}", f"s{i % 7}") for i in range(1400)] + [(9000 + i, "more", "s3") for i in range(60)]
    order = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights, block_docs=1, frame=16).orderBy("mix_slot").collect()
    assert [r.mix_slot for r in order] == list(range(len(rows)))
    mean = sum(map(Fraction, weights.values())) / len(weights) if weights else Fraction(1)
    blocks = Counter(r[2] for r in rows)
    assert lags([r.source for r in order], blocks, {s: Fraction(weights[s]) if s in weights else mean for s in blocks}) < 1


@pytest.mark.parametrize("weights", [None, {}, 0.5, {"d1": 2.0, "d2": 1.0}])
def test_thousands_of_sources(spark, weights):
    rows = [(i, f"text {i}", f"d{i % 2500}") for i in range(4000)] + [(9000 + i, "more", "d7") for i in range(50)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights, block_docs=1).collect()
    assert sorted((r.doc_id, r.text, r.source) for r in out) == sorted(rows) and sorted(r.mix_slot for r in out) == list(range(len(rows)))
    if weights == {}:  # rounds: everyone once, those with two again, then the rest of the largest
        assert len({r.source for r in out if r.mix_slot < 2500}) == 2500 and len({r.source for r in out if 2500 <= r.mix_slot < 4000}) == 1500
        assert {r.source for r in out if r.mix_slot >= 4000} == {"d7"}

"""Toxicity and language identification: held-out accuracy and defined results."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from aqualedger.llm import langid, toxicity

SF = "/root/testdata/sf0.1"


def test_kneser_ney_matches_a_direct_computation():
    s = toxicity.Settings(order=3, prior=7.0)
    texts, toxic = ["the cat sat on the mat", "you rat you ratty cat", "a cat"], np.array([0, 1, 0])
    g, gram, n = toxicity.count_grams(texts, toxic, 3)
    ids = np.unique(gram)
    counts = [np.array([n[(g == c) & (gram == i)].sum() for i in ids]) for c in (0, 1)]
    model = toxicity.Model(ids, counts[0], counts[1], s)

    own = [Counter(), Counter()]
    for t, c in zip(texts, toxic):
        for w in t.split():
            padded = "  " + w + " "
            own[c].update(padded[i : i + 3] for i in range(len(padded) - 2))
    pool = own[0] + own[1]

    def level(table, x):  # one discounted level: (n, total of its context, kinds in its context)
        ctx = [k for k in table if k[:-1] == x[:-1]]
        return table.get(x, 0), sum(table[k] for k in ctx), len(ctx)

    tables = {3: pool}
    for m in (2, 1):
        tables[m] = Counter(k[1:] for k in tables[m + 1])

    def shared(x):
        p = 1 / 64
        for m in (1, 2, 3):
            k, t, kinds = level(tables[m], x[-m:])
            if t:
                p = (max(k - s.discount, 0) + s.discount * kinds * p) / t
        return p

    def prob(c, x):
        k, t, kinds = level(own[c], x)
        return (max(k - s.discount, 0) + (s.discount * kinds + s.prior) * shared(x)) / (t + s.prior)

    for x in ["  t", " th", "the", "e  ", "at ", "tty", "zqx", "caz", " ca"]:
        key = np.array([sum(int(v) << 6 * (2 - i) for i, v in enumerate(toxicity.letter_classes(x)))])
        got = [float(v[0]) for v in model.log_likelihoods(key)]
        assert got == pytest.approx([math.log(prob(0, x)), math.log(prob(1, x))])


def test_blocks_of_long_texts_change_nothing(monkeypatch):
    texts = ["one two three " * 500, "", "four", "1 2 3"]
    whole = [sorted(zip(*map(list, toxicity.count_grams(texts, np.arange(4), 4))))]
    monkeypatch.setattr(toxicity, "CHARS_AT_ONCE", 64)
    split = defaultdict(int)
    for g, x, n in zip(*map(list, toxicity.count_grams(texts, np.arange(4), 4))):
        split[g, x] += n
    assert whole[0] == sorted((g, x, n) for (g, x), n in split.items())


def test_toxicity_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity_scores(docs, labels)
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out for r in rows)
    hit = sum(r.predicted == 1 and r.toxic == 1 for r in rows)
    assert hit / sum(r.predicted for r in rows) > 0.9 and hit / sum(r.toxic for r in rows) > 0.8
    assert all(r.predicted == (r.score >= 0.5) for r in rows)


def test_toxicity_odd_rows(spark):
    docs = [(1, "you are trash " * 20), (2, "a calm day " * 20), (3, None), (4, ""), (5, "12 ## 3"), (None, "you are trash"), (6, "x" * 300_000), (1, "you are trash " * 20)]
    docs += [(i, ("you trash scum " if i % 3 == 0 else "calm mild day ") * 9 + str(i)) for i in range(20, 120)]
    df = spark.createDataFrame([(i, t, 1.0, 9) for i, t in docs], "doc_id long, text string, score double, toxic int")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(20, 120)] + [(20, 0), (3, None), (4, 7)], "doc_id long, toxic int")
    got = toxicity.toxicity_scores(df, labels).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[1].predicted == 1 and by[2].predicted == 0 and by[3].score == by[4].score == by[5].score
    none = toxicity.toxicity_scores(df, labels.limit(0)).collect()
    assert len(none) == len(docs) and len({round(r.score, 6) for r in none}) == 1
    kept = toxicity.drop_toxic(df, labels)
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == df.columns and ids >= {2, 3, 4, 5}
    assert not ids & {1, None}  # rows go by id and text, also without an id and repeated
    empty = toxicity.toxicity_scores(df.limit(0), labels)
    assert empty.count() == 0


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.predict_language(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97


def test_language_odd_rows(spark):
    en, de = "the cat and the dog with that", "der hund und die katze mit dem"
    docs = [(i, (en if i % 2 else de) + f" {i}", "en" if i % 2 else "de") for i in range(60)]
    docs += [(100, None, "en"), (101, "", None), (102, "12 34 !?", "de"), (None, en, "en"), (103, "x" + "the and " * 200_000, None), (104, "日本語 の 文", "ja"), (105, "日本語 の 文", "ja"), (106, en, None), (106, en, None), (107, "\u00b2 \u00bd 3", None)]
    df = spark.createDataFrame([(i, t, x, 0.5) for i, t, x in docs], "doc_id long, text string, lang string, score double")
    got = langid.predict_language(df).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    assert all(by[i].lang_pred == "und" for i in (100, 101, 102, 107))
    assert all(by[i].lang_pred == ("en" if i % 2 else "de") for i in range(60)) and by[106].lang_pred == by[103].lang_pred == "en"
    assert {r.lang_pred for r in langid.predict_language(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.predict_language(df.limit(0)).count() == 0


def _sample(spark, x, lang, s):
    rows = [(s.families.get(v, v), v, i, langid.packed(row)) for i, (row, v) in enumerate(zip(x, lang.tolist()))]
    return spark.createDataFrame(rows, "family string, lang string, h long, x binary").repartition(3)


def test_family_comes_first(spark):
    s = langid.Settings(epochs=5, buckets=6)
    x = np.eye(6)[[0, 1, 2, 3, 4, 5] * 4]
    lang = np.array(["en", "de", "fr", "es", "ru", "xx"] * 4)
    model = langid.fit_sample(_sample(spark, x, lang, s), s)
    own = model.languages
    assert sorted(own) == ["germanic", "romance", "slavic", "xx"] and own["romance"].names == ["es", "fr"]
    assert model.family.names == sorted(own) and len(own["xx"].weights) == 0
    family = [model.family.names[i] for i in model.family.shares(x[:6]).argmax(axis=1)]
    assert family == ["germanic", "germanic", "romance", "romance", "slavic", "xx"]


def test_families_are_told_apart_on_a_pool(spark):
    """Each family's machine is fitted on its own texts and the pool's others, as fitted plainly; a
    smaller pool still tells them apart; vectors survive packing; too many languages are an error."""
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(40, 96))
    lang = np.array([f"l{i:02d}" for i in range(40)] * 12)
    x = (centre[np.arange(480) % 40] + rng.normal(scale=0.2, size=(480, 96))).astype(np.float32)
    x[:, 3] = 0
    x = np.abs(x) / np.linalg.norm(x, axis=1, keepdims=True)  # unit vectors of shares, as features() gives
    assert (langid.unpacked(pd.Series([langid.packed(v) for v in x]), 96) == x).all()
    for pool in (480, 100):
        s = langid.Settings(buckets=96, pool=pool)
        model = langid.fit_sample(_sample(spark, x, lang, s), s)
        for i in (0, 17):
            rest = np.flatnonzero((lang != f"l{i:02d}") & (np.arange(480) < pool))  # the pool: the first by h
            at = sorted([*np.flatnonzero(lang == f"l{i:02d}"), *rest], key=lambda j: (lang[j], langid.packed(x[j])))
            w, b = langid.fit_svm(x[at], np.where(lang[at] == f"l{i:02d}", 1.0, -1.0), s.epochs, s.ridge)
            assert np.allclose(model.family.weights[i], w) and np.isclose(model.family.intercepts[i], b)
        got = [model.family.names[j] for j in model.family.shares(x).argmax(axis=1)]
        assert np.mean(np.array(got) == lang) > 0.9, pool
    docs = spark.createDataFrame([(i, "abc " + v, v) for i, v in enumerate(lang.tolist())], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        langid.predict_language(docs, langid.Settings(max_langs=39))


def test_toxic_rows_go_by_id_and_text(spark):
    bad, good = "you are trash " * 20, "a calm day " * 20
    docs = [(None, bad), (None, good), (1, bad), (1, good), (2, bad)] + [(i, ("you trash scum " if i % 3 == 0 else "calm mild day ") * 9 + str(i)) for i in range(20, 120)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(20, 120)], "doc_id long, toxic int")
    kept = {(r.doc_id, r.text) for r in toxicity.drop_toxic(spark.createDataFrame(docs, "doc_id long, text string"), labels).collect()}
    assert {(i, t) for i, t in kept if i is None or i < 20} == {(None, good), (1, good)}


def test_pairs_vote_within_a_family(spark):
    """Four languages: a machine for every two, fitted on those two alone, and the majority of
    their votes (ties by margins, then by name), against a plain count."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(4, 12))
    lang = np.array(["da", "de", "en", "nl"] * 60)
    x = (centre[np.arange(240) % 4] + rng.normal(scale=0.5, size=(240, 12))).astype(np.float32)
    at = sorted(range(240), key=lambda i: (lang[i], langid.packed(x[i])))
    x, lang = x[at], lang[at]
    s = langid.Settings(epochs=8, buckets=12)
    pairs = langid.fit_sample(_sample(spark, x, lang, s), s).languages["germanic"]
    assert len(pairs.weights) == 6
    machines = {}
    for a, b in [("da", "de"), ("da", "en"), ("da", "nl"), ("de", "en"), ("de", "nl"), ("en", "nl")]:
        own = (lang == a) | (lang == b)
        machines[a, b] = langid.fit_svm(x[own], np.where(lang[own] == a, 1.0, -1.0), s.epochs, s.ridge)
    for v in rng.normal(scale=2, size=(300, 12)):
        votes, sums = dict.fromkeys(pairs.names, 0), dict.fromkeys(pairs.names, 0.0)
        for (a, b), (w, c) in machines.items():
            m = float(w @ v + c)
            votes[a if m >= 0 else b] += 1
            sums[a] += m
            sums[b] -= m
        got, sure = pairs.decide(v)
        want = sorted(pairs.names, key=lambda n: (-votes[n], -round(sums[n], 9), n))[0]
        assert got == want and 0 <= sure <= 1
    assert np.mean([pairs.decide(v)[0] == n for v, n in zip(x, lang)]) > 0.8


def test_ties_go_by_margins_then_by_name():
    # a beats b, b beats c, c beats a: one vote each
    ring = langid.Pairs(["a", "b", "c"], np.zeros((3, 1)), np.array([1.0, -1.0, 2.0]))
    assert ring.decide(np.zeros(1))[0] == "b"
    even = langid.Pairs(["a", "b", "c"], np.zeros((3, 1)), np.array([1.0, -1.0, 1.0]))
    assert even.decide(np.zeros(1))[0] == "a"
    alone = langid.Pairs(["x"], np.zeros((0, 1)), np.zeros(0))
    assert alone.decide(np.zeros(1)) == ("x", 1.0)


def test_three_close_languages_of_one_family(spark):
    """Texts of three languages of one family that share most of their words."""
    import random

    rng = random.Random(6)
    shared = ["ala", "brona", "kerit", "dolum", "sanet", "vireo", "tamar", "polen"]
    own = {"es": ["que", "los", "muy"], "pt": ["nao", "uma", "dos"], "it": ["che", "gli", "per"], "de": ["und", "der", "sch"]}
    docs = [(i, " ".join(rng.choice(own[lang] if rng.random() < 0.35 else shared) for _ in range(30)), lang) for i, lang in enumerate(["es", "pt", "it", "de"] * 80)]
    got = langid.predict_language(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()
    truth = {i: lang for i, _, lang in docs}
    out = [r for r in got if r.held_out]
    assert len(out) > 40 and sum(r.lang_pred == truth[r.doc_id] for r in out) / len(out) > 0.95

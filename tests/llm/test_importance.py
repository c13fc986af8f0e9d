"""Importance resampling (op11): the overlapped scan, gains, weights and the draw."""

from __future__ import annotations

import math
import re
from hashlib import sha256
from zlib import crc32

import pytest

from aqualedger.llm.importance import feature_buckets, importance_resample, importance_scores

TEXTS = [
    "", None, "  ,;", "a", "a b", "One, two--THREE four.", "x\x00y \x7f z{q}|r", "İstanbul straße é 漢字 漢字", "word " * 50,
    "the quick brown fox jumps over the lazy dog " * 5, "to be or not to be that is the question " * 4 + "indeed", "\U0001f600 b \U0001f600 b",
]


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def features_of(text, buckets):
    w = words_of(text)
    return [crc32(" ".join(w[i : i + n]).encode()) % buckets for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target, percent=5, buckets=10_000, min_words=20):
    """(doc_id, n_features, weight, score, rank) of every row."""
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for b in features_of(text, buckets):
                counts[b] += 1
    top, low = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (top + buckets) / ((s[b] + 1) * (low + buckets)))) for b in range(buckets)]
    rows = []
    for ident, text in docs:
        f = features_of(text, buckets)
        h = int(sha256(f"42:{'' if ident is None else ident}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([ident, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words_of(text)) >= min_words])
    enough = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(enough[: len(enough) * percent // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=str)


def scored(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize("max_n", [1, 2, 3, 4])
def test_scan_is_every_run_of_words(max_n):
    for text in TEXTS:
        w = words_of(text)
        n_words, found = feature_buckets(text or "", 10_000, max_n)
        want = [crc32(" ".join(w[i : i + n]).encode()) % 10_000 for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]
        assert n_words == len(w) and sorted(found.tolist()) == sorted(want), text


def test_scores_and_ranks_are_brute_force(spark):
    docs = [(i, t) for i, t in enumerate(TEXTS * 6)] + [(3, TEXTS[9]), (3, TEXTS[9]), (None, TEXTS[10]), (None, TEXTS[10])]
    target = ["the lazy dog is the question", None, "", "to be or not"]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    for percent in (5, 40, 100):
        assert scored(importance_scores(df, aim, percent=percent)) == brute(docs, target, percent)
    assert scored(importance_scores(df, aim.limit(0), percent=40)) == brute(docs, [], 40)
    assert scored(importance_scores(df, aim, percent=40, buckets=7, min_words=1)) == brute(docs, target, 40, 7, 1)


def test_empty_table_long_text_and_clashing_columns(spark):
    schema = "doc_id long, text string, tag int, weight string, `rank` double, own_id int, drawn int, copy_no int"
    empty = spark.createDataFrame([], schema)
    aim = spark.createDataFrame([("a b",)], "text string")
    assert importance_scores(empty, aim).count() == 0 and importance_resample(empty, aim).count() == 0
    long = "lorem ipsum dolor " * 100_000
    rows = [(1, long, 1, "w", 0.5, 1, 1, 1), (2, "x y", None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    got = {r.doc_id: r for r in importance_scores(df, aim, percent=100).collect()}
    assert got[1].n_features == 3 * 300_000 - 3 and got[1].rank == 1 and got[2].rank is None
    drawn = importance_resample(df, aim, percent=100)
    assert drawn.columns == df.columns and [tuple(r) for r in drawn.collect()] == [rows[0]]


def test_resample_returns_whole_rows_as_often_as_drawn(spark):
    text = "alpha beta gamma delta " * 6
    docs = [(7, text)] * 5 + [(8, text + "x"), (None, text)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    aim = spark.createDataFrame([("alpha beta",)], "text string")
    for percent in range(0, 101, 15):
        ranked = [r for r in importance_scores(df, aim, percent=percent).collect() if r["rank"]]
        got = sorted((r.doc_id for r in importance_resample(df, aim, percent=percent).collect()), key=str)
        assert len(got) == 7 * percent // 100 and got == sorted((r.doc_id for r in ranked), key=str)

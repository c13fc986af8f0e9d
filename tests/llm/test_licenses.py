from __future__ import annotations

import re

from aqualedger.llm import licenses

NOTICE = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"


def brute(docs):
    out = []
    for i, t in docs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        starts, labels = [], set()
        for phrase, label in licenses.BASE_PHRASES:
            p = phrase.split()
            own = [s for s in range(len(words) - len(p) + 1) if words[s : s + len(p)] == p]
            starts += own
            labels |= {label} if own else set()
        out.append((i, len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))))
    return sorted(out, key=str)


DOCS = [
    (1, "The MIT License, and again: mit-license!"), (2, "mit license mit license mit mit license license"), (3, "GNU General Public License, general public license"),
    (4, "Apache\nLicense, Version 2.0"), (4, "Apache\nLicense, Version 2.0"), (4, "another text of four, mit license"), (5, None), (6, ""), (7, "mit"), (None, "mit license"),
    (8, "général public license"), (9, "MİT License"), (10, "the MIT. License" + " filler word" * 50_000 + " apache license"), (11, "public license general"), (12, "... --- 42 mit  license"),
    (13, NOTICE), (14, NOTICE.replace("free of charge", "at no cost whatever and free of charge")), (15, "permission is hereby denied to any person " * 3),
    (16, "x Licensed under the Apache License, Version 2.0 y"), (17, "İ mit_license K mit\x7flicense"),
]


def test_base_places_match_brute_force(spark):
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in DOCS], "doc_id long, text string, words int, label string").repartition(3)
    got = licenses.license_scan(df).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str) == brute(DOCS)
    by = {r.doc_id: r for r in got}
    assert by[13].labels == by[14].labels == "mit" and by[13].score == 1.0 and 0.7 <= by[14].score < 1
    assert by[15].labels == "" and by[15].score == 0.0
    assert by[3].labels == "gpl" and by[16].labels == "apache"
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


def test_empty_table_and_native_plan(spark):
    out = licenses.license_scan(spark.createDataFrame([], "doc_id long, text string"))
    assert out.count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_labels_survive_overlapping_phrases_and_long_templates(spark):
    long_words = [f"w{i % 40}x{i // 40}" for i in range(300)]
    cut = long_words[:100] + ["two", "more"] + long_words[100:200] + long_words[203:]
    texts = [
        (1, "GNU Lesser General Public License, General Public License"), (2, "General Public License, GNU Lesser General Public License"),
        (3, "GNU Lesser General Public License " * 4), (4, " ".join(long_words)), (5, "x " + " ".join(cut) + " y"), (6, " ".join(long_words[:150])),
        (7, f"{NOTICE} and more of it: {NOTICE}"),
    ]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    templates = [*licenses.TEMPLATES, licenses.Template(" ".join(long_words), "long", False)]
    got = {r.doc_id: r for r in licenses.license_scan(df, templates).collect()}
    assert [got[i].labels for i in (1, 2, 3)] == ["gpl,lgpl"] * 3
    assert got[4].labels == got[5].labels == "long" and got[4].score == 1.0 and 0.9 < got[5].score < 1 and got[6].labels == ""
    spans = licenses.license_spans(df.where("doc_id = 7")).where("not base").orderBy("first_word").collect()
    n = len(re.findall(r"\w+", NOTICE))
    assert [(r.first_word, r.last_word, r.cover) for r in spans] == [(0, n - 1, 1.0), (n + 4, 2 * n + 3, 1.0)]

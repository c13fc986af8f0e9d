"""Fill-in-middle (op12): cuts, forms and the exact round trip."""

from __future__ import annotations

from hashlib import sha256

import pytest
from hypothesis import given
from hypothesis import strategies as st

from aqualedger.llm import fim


def brute(ident, text):
    """(n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    digest = sha256(f"1:{'' if ident is None else ident}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:i], text[i:j], text[j:]
    if h[3] % 100 < 20:
        return n, "spm", i, j - i, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", i, j - i, f"<P>{p}<S>{s}<M>{m}"


@given(st.text(max_size=60), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1))
def test_cuts_are_the_drawn_places(text, a, b):
    n = len(text)
    want = (n, *sorted((a % (n + 1), b % (n + 1))))
    assert fim.cut_offsets(text, a, b) == want


@pytest.mark.parametrize("at_once", [1, 2, 5, 7])
def test_pieces_of_a_long_text_give_the_same_cuts(monkeypatch, at_once):
    text = "a\nb\r \U0001f600\x00é" * 3
    monkeypatch.setattr(fim, "UNITS_AT_ONCE", at_once)
    for a in range(len(text) + 1):
        for b in (0, 1, a, len(text)):
            assert fim.cut_offsets(text, a, b) == (len(text), *sorted((a, b)))


ODD = ["", None, "x", "\n", "<P>", "a <S", "S>", "<", "<M", "M><P", "no <M> here", "<S><S>", "漢字\U0001f600\n\r\x85é" * 9, "plain words " * 40, "<<P", "P>"]


def test_forms_outputs_and_round_trip(spark):
    docs = [(i, t) for i, t in enumerate(ODD * 40)] + [(None, "no id at all"), (None, None), (5, "again"), (5, "again")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    out = fim.fill_in_middle(df).withColumn("back", fim.restored())
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in out.collect()), key=str)
    want = sorted(((d, *brute(d, t), t or "") for d, t in docs), key=str)
    assert got == want
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_empty_table_long_text_and_clashing_columns(spark):
    schema = "doc_id long, text string, h1 string, form int, n double, output int"
    assert fim.fill_in_middle(spark.createDataFrame([], schema)).count() == 0
    long = "0123456789" * 200_000
    df = spark.createDataFrame([(i, long, "h", 1, 0.5, 2) for i in range(3)], schema)
    out = fim.fill_in_middle(df).withColumn("back", fim.restored()).collect()
    assert [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in sorted(out)] == [(i, *brute(i, long)) for i in range(3)]
    assert all(r.back == long for r in out)


def test_other_id_type_and_shares(spark):
    df = spark.range(4000).selectExpr("concat('k', id) as key", "repeat('ab ', 20) as body")
    out = fim.fill_in_middle(df, id_col="key", text_col="body", plain_percent=50, spm_percent=50)
    share = {r.form: r["count"] / 4000 for r in out.groupBy("form").count().collect()}
    assert out.schema["doc_id"].dataType.simpleString() == "string"
    assert abs(share["plain"] - 0.5) < 0.05 and abs(share["psm"] - share["spm"]) < 0.05

from __future__ import annotations

from collections import Counter

import pytest
import corpus_pipeline
from aqualedger.llm import simhash
from aqualedger.llm.util import LAST_ID
from test_lines import brute as brute_lines
from test_simhash import brute_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.materialize(stage(spark, out[-1], SF), name))
    return out


def test_columns_and_types(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_stages_match_brute_force(stages):
    raw, mild, cut, one, mixed, packed = ([r for r in df.collect()] for df in stages)
    assert {r.doc_id for r in mild} <= {r.doc_id for r in raw}
    want = {i: t for i, t, *_ in brute_lines([(r.doc_id, r.text) for r in mild])}
    assert {r.doc_id: r.text for r in cut} == want and all(r.n_chars == len(r.text) for r in cut)
    ids, fps = [r.doc_id for r in cut], [simhash.fingerprint(r.text) for r in cut]
    assert sorted(r.doc_id for r in one) == sorted(set(brute_components(ids, fps)))
    assert sorted(map(tuple, mixed)) == sorted(map(tuple, one))
    assert sorted(r.doc_id for r in packed) == sorted(r.doc_id for r in one)


def test_clean_documents_stay(spark, stages):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1].select("doc_id").collect()}
    clean = [i for i, t in labels.items() if t == 0]
    assert sum(i in kept for i in clean) / len(clean) > 0.97


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


EXTRA = ["id", "tag", "fp", "n_lines", "gone_id", "bad_id", "mix_slot", "rank", "bin", "n_words"]


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties, copies, and
    extra columns with names that the operators use themselves."""
    texts = [None, "", "\n\n", "\u00e9" * 300_000, "one line of shared text\nown", "one line of shared text\nother", "word " * 60_000, "same", "same"]
    rows = [(900_000 + i, t, "en", "s", len(t) if t is not None else None) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, "no id at all, twice", "en", "s", 19), (None, "no id at all, twice", "en", "s", 19), (None, None, None, None, None)]
    rows += [(900_100, "text without a source", None, None, None)]
    rows += [(910_000 + i, "a large group of copies of a text that is long enough", "en", "hot", 53) for i in range(300)]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(rows, docs.schema)
    return docs.unionByName(odd).selectExpr("*", *[f"'x' AS {c}" for c in EXTRA]).repartition(5)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.materialize(stage(spark, out[-1], SF), name))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out[-1].dtypes == docs.dtypes, name
    raw, mild, cut, one, mixed, packed = (df.collect() for df in out)
    scores = corpus_pipeline.toxicity.toxicity_scores(docs, corpus_pipeline.table(spark, SF, "labels")).collect()
    assert Counter(r.doc_id for r in mild) == Counter(r.doc_id for r in scores if not r.predicted)  # null is an id like others
    assert sum(r.doc_id is None for r in raw) == 3 and any(r.doc_id is None for r in mild)
    want = {i: t for i, t, *_ in brute_lines([(r.doc_id, r.text) for r in mild if r.doc_id is not None])}
    assert len(mild) == len(cut)
    assert all((r.text or "") == (want[r.doc_id] or "") for r in cut if r.doc_id is not None)
    ids = [LAST_ID if r.doc_id is None else r.doc_id for r in cut]  # null ids come last
    smallest = set(brute_components(ids, [simhash.fingerprint(r.text) for r in cut]))
    assert sorted(LAST_ID if r.doc_id is None else r.doc_id for r in one) == sorted(smallest)  # one row of each component
    assert sorted(map(str, mixed)) == sorted(map(str, one)) and len(packed) == len(one)
    assert {r.doc_id for r in packed} == {r.doc_id for r in one}


def test_packing_follows_the_mixture(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    rows = [(i, f"text number {i}", "en", "hot" if i % 10 else f"s{i % 4}", 10) for i in range(2000)]
    one = corpus_pipeline.materialize(spark.createDataFrame(rows, docs.schema).repartition(3), "one")
    mixed = corpus_pipeline.materialize(corpus_pipeline.mix_sources(spark, one, SF), "mixed")
    order = [r.doc_id for r in corpus_pipeline.mixing.mix(one, 0.5).orderBy("mix_slot", "mix_pos").select("doc_id").collect()]
    packed = corpus_pipeline.packing.best_fit(mixed, group_rows=300, in_order=True).collect()
    assert [r.doc_id for r in sorted(packed, key=lambda r: r.place)] == order and [r.bin_group for r in sorted(packed, key=lambda r: r.place)] == [i // 300 for i in range(2000)]
    as_set = lambda df: {(r.doc_id, r.place, r.bin_group, r.bin) for r in corpus_pipeline.pack(spark, df, SF).collect()}
    assert as_set(mixed) != as_set(one) and {i for i, *_ in as_set(one)} == set(order)
    lazy = corpus_pipeline.packing.best_fit(corpus_pipeline.mix_sources(spark, one, SF), in_order=True).collect()
    assert [r.doc_id for r in sorted(lazy, key=lambda r: r.place)] == order

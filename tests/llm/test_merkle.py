from __future__ import annotations

from pyspark.sql import functions as F

from aqualedger.llm import merkle, queries

PAGES = [(i, f"http://h/{i}", f"<p>{i}</p>" * (i % 40)) for i in range(300)] + [(None, None, None), (5, "http://h/5", "twin"), (5, "http://h/5", "twin"), (400, "u", ""), (401, None, "x" * 300_000)]


def records(spark, pages=PAGES):
    df = spark.createDataFrame([(*p, "c", 1) for p in pages], "page_id long, url string, html string, file string, offset int").repartition(3)
    return merkle.warc_records(df, pages_per_file=100)


def test_records_lie_end_to_end(spark):
    rows = records(spark).collect()
    assert len(rows) == len(PAGES)
    for file in {r.file for r in rows}:
        own = sorted((r.offset, r.length) for r in rows if r.file == file)
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))


def test_audit_finds_exactly_the_differences(spark):
    a = records(spark)
    rows = sorted(a.collect(), key=lambda r: (r.file, r.offset))
    hurt = {(rows[i].file, rows[i].offset): kind for i, kind in ((3, "changed"), (4, "changed"), (120, "missing"), (299, "changed"), (303, "missing"))}
    b = []
    for r in rows:
        kind = hurt.get((r.file, r.offset))
        if kind != "missing":
            b.append((r.file, r.offset, r.length, "bad" if kind else r.digest))
    b.append((77, 10, 5, "stray"))
    other = spark.createDataFrame(b, "file long, offset long, length long, digest string")
    for leaf, fanout in ((500, 2), (65536, 16), (10**9, 4)):
        got = {(r.file, r.offset): r.kind for r in merkle.audit(a, other, leaf, fanout).collect()}
        assert got == hurt | {(77, 10): "extra"}, (leaf, fanout)


def test_only_differing_branches_are_read(spark):
    a = records(spark)
    levels = merkle.tree(a, 500, 2)
    assert [x.count() for x in levels] == sorted((x.count() for x in levels), reverse=True)
    assert levels[-1].groupBy("file").count().where("count > 1").isEmpty()
    assert merkle.audit(a, a, 500, 2).count() == 0
    assert merkle._differing(levels[-1], levels[-1].withColumn("digest", F.lit("x"))).count() == levels[-1].count()


def test_empty_replicas(spark):
    a, none = records(spark, PAGES[:3]), records(spark, [])
    assert merkle.audit(none, none).count() == 0
    assert {r.kind for r in merkle.audit(a, none).collect()} == {"missing"} and {r.kind for r in merkle.audit(none, a).collect()} == {"extra"}


def test_hot_and_null_ids(spark, monkeypatch):
    """A third of the rows without an id, a third under one id, many of them equal: records
    still lie end to end, each row once, in order of id and digest."""
    monkeypatch.setattr(merkle, "COPIES_AT_ONCE", 7)
    pages = [(None, "u", f"{i % 60}") for i in range(100)] + [(5, "u", "twin" if i % 2 else f"{i}") for i in range(100)] + [(i, "v", "") for i in range(100)]
    rows = records(spark, pages).collect()
    assert len(rows) == len(pages) and sum(r.page_id is None for r in rows) == 100
    for file in {r.file for r in rows}:
        own = sorted(rows, key=lambda r: r.offset)
        own = [r for r in own if r.file == file]
        assert own[0].offset == 0 and all(a.offset + a.length == b.offset for a, b in zip(own, own[1:]))
        keys = [(2**63 - 1 if r.page_id is None else r.page_id, r.digest) for r in own]
        assert keys == sorted(keys)


def test_query_counts_pages_without_an_id(spark, tmp_path):
    """The registered audit reports what was planted, and nothing else, for null and repeated ids too."""
    pages = [(i if i % 3 else None, f"u{i}", "x" * (i % 400)) for i in range(600)] + [(7, "twin", "y" * 16)] * 3 + [(None, None, None)] * 2
    spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    want = {"changed": 0, "missing": 0, "extra": 0}
    for _, _, html in pages:
        n = len(html or "")
        rotten, lost, stray = n % 11 == 5, n % 29 == 7, n % 31 == 3
        kind = None if lost and stray else "missing" if lost else "extra" if stray else "changed" if rotten else None
        if kind:
            want[kind] += 1
    got = [r.kind for r in queries.op1_merkle_fixity(spark, str(tmp_path)).collect()]
    assert {k: got.count(k) for k in want} == want and min(want.values()) > 5

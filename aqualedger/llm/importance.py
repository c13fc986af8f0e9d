"""Target-distribution importance resampling over hashed word n-grams.

Texts are scanned by one overlapped regular expression: separators collapse to single
spaces, and a match starts at every word, its groups the spans of the 1-, 2- and 3-grams that
begin there; each span's UTF-8 bytes are hashed by CRC32 into a bucket.  A bucket's gain is the log ratio of its smoothed frequency in the target to that in
the corpus, a document's weight the sum of its features' gains, and documents are drawn
without replacement by weight plus Gumbel noise (the highest scores)."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import with_position
from .util import each_copy, fresh, materialize, whole_text

# A-Z in lower case; every separator byte (all ASCII but digits and letters) as a space
PLAIN = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
ROWS_AT_ONCE = 500  # texts whose features a task hands on together
NO_WORD = b" \x00"  # stands behind a text's last words, so that a span of the most words starts at each


def gram_pattern(max_n: int) -> regex.Pattern:
    """A space and the spans of the 1 to ``max_n`` words behind it as nested groups, the longest
    first; the last word ends before a space."""
    spans = b"([^ ]++)"
    for _ in range(max_n - 1):
        spans = b"(" + spans + b" [^ ]++)"
    return regex.compile(b" " + spans + b"(?= )")


def collapsed(text: str) -> bytes:
    """UTF-8 bytes with A-Z lower-cased and every run of separators as one space."""
    return b" ".join(text.encode("utf-8", "surrogatepass").translate(PLAIN).split())


def feature_buckets(text: str, buckets: int, max_n: int = 3) -> tuple[int, np.ndarray]:
    """(number of words, bucket of every feature in the text, repeats included)."""
    line = collapsed(text)
    if not line:
        return 0, np.empty(0, np.uint32)
    line = b" " + line + NO_WORD * (max_n - 1) + b" "
    spans = map(regex.Match.groups, gram_pattern(max_n).finditer(line, overlapped=True))
    crcs = np.frombuffer(array("I", map(crc32, chain.from_iterable(spans))), np.uint32).reshape(-1, max_n)
    words = len(crcs)
    # the column of n-word spans comes max_n - n-th; its last n - 1 rows run into NO_WORD
    found = [crcs[: max(0, words - n + 1), max_n - n] for n in range(1, max_n + 1)]
    return words, np.concatenate(found) % np.uint32(buckets)


def _number(buckets: int) -> str:
    """The stored type of a bucket number."""
    return "<u2" if buckets <= 1 << 16 else "<u4"


def _scanned(rows: DataFrame, buckets: int, max_n: int) -> DataFrame:
    """(doc_id, tag, n_words, n_features, seen binary): the bucket of every feature of a text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), ROWS_AT_ONCE):
                part = pdf.iloc[at : at + ROWS_AT_ONCE]
                n_words, seen = [], []
                for text in part["text"]:
                    words, found = feature_buckets(text, buckets, max_n)
                    n_words.append(words)
                    seen.append(found.astype(_number(buckets)).tobytes())
                size = np.dtype(_number(buckets)).itemsize
                yield pd.DataFrame({"doc_id": part["doc_id"], "tag": part["tag"], "n_words": n_words, "n_features": [len(x) // size for x in seen], "seen": seen})

    return rows.mapInPandas(run, "doc_id string, tag long, n_words long, n_features long, seen binary")


def _totals(scanned: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n): features per bucket; every task sums its texts before the shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for pdf in batches:
            for seen in pdf["seen"]:
                total += np.bincount(np.frombuffer(seen, _number(buckets)), minlength=buckets)
        hit = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": hit, "n": total[hit]})

    return scanned.select("seen").mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) for each of the B buckets, in doubles; at most B
    rows of each table come to the driver."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, totals in ((s, corpus), (t, target)):
        for r in totals.collect():
            counts[r.bucket] = r.n
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def _digest_head(seed: int) -> Column:
    """The first 8 hex digits of sha256(`seed:doc_id`) as a number; a null id reads as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce("doc_id", F.lit("")))
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")


def importance_scores(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    buckets: int = 10_000,
    max_n: int = 3,
    min_words: int = 20,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, tag, n_words, n_features, weight, score, rank), all
    long but for the id, which keeps its type; ``tag`` is the text's hash.  ``rank`` counts from 1
    over the floor(percent * N / 100) highest scores of the N documents with at least
    ``min_words`` words (ties to the smaller id, null ids last) and is null for all others.

    Null and empty texts, and texts without words, have no features, weight 0 and no rank.  Whole
    texts are scanned, however long.  Repeated rows score alike and are ranked one after the
    other.  An empty ``docs`` gives no rows; an empty ``target`` gives smoothed counts only.
    Only the id and text columns are read, so other columns may have any name.
    """
    kind = docs.schema[id_col].dataType

    def rows(df: DataFrame, ident: Column) -> DataFrame:
        text = whole_text(text_col).cast("string")
        return df.select(ident.cast("string").alias("doc_id"), F.xxhash64(text).alias("tag"), text.alias("text"))

    scanned = materialize(_scanned(rows(docs, F.col(id_col)), buckets, max_n), "importance-features")
    aimed = _scanned(rows(target, F.lit(None)), buckets, max_n)
    gains = bucket_gains(_totals(scanned, buckets), _totals(aimed, buckets), buckets)

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sums = [int(gains[np.frombuffer(seen, _number(buckets))].sum()) for seen in pdf["seen"]]
            yield pd.DataFrame({c: pdf[c] for c in ("doc_id", "tag", "n_words", "n_features")} | {"weight": sums})

    weighed = scanned.mapInPandas(weigh, "doc_id string, tag long, n_words long, n_features long, weight long")
    noise = F.floor(-1000 * F.log(-F.log((_digest_head(seed) + 0.5) / 4294967296.0))).cast("long")
    scored = weighed.withColumn("score", F.col("weight") + noise)
    scored = scored.withColumn("doc_id", F.col("doc_id").cast(kind)).withColumn("enough", F.col("n_words") >= min_words)
    placed = with_position(scored, ["enough", "score", "doc_id"], "place", descending=("enough", "score"))
    drawn = placed.agg(F.floor(F.count(F.when(F.col("enough"), 1)) * percent / 100).alias("drawn"))  # one row
    ranked = placed.crossJoin(F.broadcast(drawn))
    rank = F.when(F.col("place") <= F.col("drawn"), F.col("place"))
    return ranked.select("doc_id", "tag", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def importance_resample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs`` (columns id ``doc_id`` and ``text``), whole and with all their
    columns; of rows equal in id and text as many as were drawn.  See ``importance_scores``."""
    own_id, null_id, tag, drawn, rows, copy_no = fresh(docs.columns, "own_id", "null_id", "tag", "drawn", "rows", "copy_no")
    own = {own_id: F.coalesce(F.col("doc_id").cast("string"), F.lit("")), null_id: F.col("doc_id").isNull(), tag: F.xxhash64(whole_text("text").cast("string"))}
    scores, key = importance_scores(docs, target, **options), [own_id, null_id, tag]
    counts = scores.select(own[own_id].alias(own_id), own[null_id].alias(null_id), F.col("tag").alias(tag), "rank").groupBy(*key)
    counts = counts.agg(F.count("rank").alias(drawn), F.count(F.lit(1)).alias(rows)).where(F.col(drawn) > 0)
    counts = materialize(counts, "importance-drawn")
    keyed = docs.withColumns(own)
    whole = keyed.join(counts.where(F.col(drawn) == F.col(rows)).select(*key), key, "left_semi").select(*docs.columns)
    cut = counts.where(F.col(drawn) < F.col(rows)).select(*key, drawn)  # the draw ends among these equal rows: one key at most
    part = keyed.join(cut.select(*key), key, "left_semi").dropDuplicates(key).join(cut, key)
    return whole.unionByName(each_copy(part, drawn, copy_no).select(*docs.columns))

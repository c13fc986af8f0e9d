"""Line dedup: every line that several documents hold stays in the first of them only.

Line hashes are range-partitioned by (hash, document, position) and sorted, so one hash's
rows lie in order, in as many partitions as they need, and a stream over a partition sees
the first occurrence of each run before the others.  Only a partition's first run may have
begun in an earlier partition; the at most two boundary runs per partition are settled
against each other afterwards.  Texts are not shuffled for this: the result is one
compressed bitmap of kept lines per document."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import fresh, materialize, order_id, whole_text

BLANKS = b" \t\n\x0b\x0c\r"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
DROP, FIRST_RUN, EDGE = 0, 1, 2
_MARKED = "kind int, h1 long, h2 long, id long, tag long, pos int"


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tag, text): rows that share an id are told apart by their text's hash."""
    text = whole_text(text_col)
    return docs.select(order_id(id_col).alias("id"), F.xxhash64(text).alias("tag"), text.alias("text"))


def line_hashes(rows: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, id, tag, pos) for each line whose key has at least ``min_chars`` code points."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), 500):  # bounds the lines held at once by a few texts
                ids, tags, pos, digests = [], [], [], []
                part = pdf.iloc[lo : lo + 500]
                for i, tag, text in zip(part["id"], part["tag"], part["text"]):
                    raw = text.encode("utf-8", "surrogatepass").translate(LOWER)
                    for p, line in enumerate(raw.split(b"\n")):
                        key = line.strip(BLANKS)
                        if len(key) >= min_chars and len(key.decode("utf-8", "surrogatepass")) >= min_chars:
                            ids.append(i)
                            tags.append(tag)
                            pos.append(p)
                            digests.append(xxhash.xxh3_128_digest(key))
                h = np.frombuffer(b"".join(digests), dtype=">i8").reshape(-1, 2).astype(np.int64)
                yield pd.DataFrame({"h1": h[:, 0], "h2": h[:, 1], "id": np.array(ids, np.int64), "tag": np.array(tags, np.int64), "pos": np.array(pos, np.int32)})

    return rows.mapInPandas(run, "h1 long, h2 long, id long, tag long, pos int")


def mark_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One sorted partition: rows to DROP (a later document of a run), all rows of the
    partition's FIRST_RUN, and the EDGE runs (the first and the last) with their first id."""
    run, first_run = None, True  # run: (h1, h2, first id)
    for pdf in batches:
        if pdf.empty:
            continue
        h1, h2, ids = (pdf[c].to_numpy(np.int64) for c in ("h1", "h2", "id"))
        starts = np.ones(len(ids), bool)
        starts[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        goes_on = run is not None and run[:2] == (h1[0], h2[0])
        starts[0] = not goes_on
        at = np.maximum.accumulate(np.where(starts, np.arange(len(ids)), -1))
        keeper = np.where(at < 0, run[2] if goes_on else 0, ids[np.maximum(at, 0)])
        if run is None:
            yield pd.DataFrame({"kind": [EDGE], "h1": [h1[0]], "h2": [h2[0]], "id": [ids[0]], "tag": [0], "pos": [0]})
            new = np.flatnonzero(starts[1:]) + 1
        else:
            new = np.flatnonzero(starts)
        in_first = np.zeros(len(ids), bool)
        if first_run:
            in_first[: new[0] if len(new) else len(ids)] = True
            first_run = not len(new)
        kind = np.where(in_first, FIRST_RUN, DROP)
        keep = in_first | (ids != keeper)
        out = pdf.loc[keep, ["h1", "h2", "id", "tag", "pos"]]
        out.insert(0, "kind", kind[keep].astype(np.int32))
        yield out
        run = (h1[-1], h2[-1], int(keeper[-1]))
    if run is not None:
        yield pd.DataFrame({"kind": [EDGE], "h1": [run[0]], "h2": [run[1]], "id": [run[2]], "tag": [0], "pos": [0]})


def dropped_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """Distinct (id, tag, pos) of the lines that an earlier document holds."""
    order = ["h1", "h2", "id", "tag", "pos"]
    dealt = line_hashes(rows, min_chars).repartitionByRange(*order).sortWithinPartitions(*order)
    marked = materialize(dealt.mapInPandas(mark_runs, _MARKED), "line-runs")
    # at most two rows per partition, so small enough to broadcast
    edges = marked.where(F.col("kind") == EDGE).groupBy("h1", "h2").agg(F.min("id").alias("keeper"))
    later = marked.where(F.col("kind") == FIRST_RUN).join(F.broadcast(edges), ["h1", "h2"]).where("id <> keeper")
    lost = marked.where(F.col("kind") == DROP).select("id", "tag", "pos").unionAll(later.select("id", "tag", "pos"))
    return lost.distinct()


def keep_bitmaps(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct (id, text): (id, tag, n_lines long, n_dropped long, keep binary).

    ``keep`` is the zlib-compressed bitmap of kept lines (bit i of byte i // 8, least
    significant first), null where every line stays.  A line's key is the line stripped of
    blanks at both ends, A-Z lower-cased; keys shorter than ``min_chars`` code points always
    stay.  Null and empty texts have one empty line.  Rows with the same id count as one
    document and null ids as one document after all others (id LAST_ID here); other columns
    are not read."""
    rows = _identified(docs, id_col, text_col)
    lost = dropped_lines(rows, min_chars).groupBy("id", "tag").agg(F.collect_list("pos").alias("lost"))
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    sizes = rows.select("id", "tag", n_lines.cast("long").alias("n_lines")).distinct()

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            maps = []
            for n, lost in zip(pdf["n_lines"], pdf["lost"]):
                if lost is None:
                    maps.append(None)
                    continue
                keep = np.ones(n, np.uint8)
                keep[np.asarray(lost)] = 0
                maps.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
            yield pd.DataFrame({"id": pdf["id"], "tag": pdf["tag"], "n_lines": pdf["n_lines"], "n_dropped": [0 if x is None else len(x) for x in pdf["lost"]], "keep": maps})

    return sizes.join(lost, ["id", "tag"], "left").mapInPandas(pack, "id long, tag long, n_lines long, n_dropped long, keep binary")


def kept_text(text: str, keep: bytes | None) -> str:
    """The kept lines of a text, joined by newlines."""
    if keep is None:
        return text
    lines = text.split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines), bitorder="little")
    return "\n".join(line for line, bit in zip(lines, bits) if bit)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text cut to the kept lines and the columns n_lines and n_dropped
    added (with leading underscores where docs has such columns).  A null text whose one
    line stays is returned as null."""
    n_lines, n_dropped, keep, tag, lid, ltag = fresh(docs.columns, "n_lines", "n_dropped", "keep", "tag", "line_id", "line_tag")
    maps = bitmaps.toDF(lid, ltag, n_lines, n_dropped, keep)
    tagged = docs.withColumns({tag: F.xxhash64(whole_text(text_col))})
    both = tagged.join(maps, (order_id(id_col) == F.col(lid)) & (F.col(tag) == F.col(ltag)))

    @F.pandas_udf("string")
    def cut(text: pd.Series, keep: pd.Series) -> pd.Series:
        return pd.Series([kept_text(t, k) for t, k in zip(text, keep)], dtype=object)

    text = F.when(F.col(keep).isNull(), F.col(text_col)).otherwise(cut(whole_text(text_col), F.col(keep)))
    return both.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns], n_lines, n_dropped)


def line_dedup(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """``docs`` cut to the lines that stay, with n_lines and n_dropped added."""
    return apply_bitmaps(docs, keep_bitmaps(docs, min_chars))

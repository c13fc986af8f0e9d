"""Conflict-constrained best-fit packing of documents into bins of fixed capacity.

Documents are dealt by hash into packing groups of bounded size, with equal rows counted and
dealt one by one; or, to keep a mixture, groups are consecutive stretches of the documents'
order.  Within a group they are packed longest first.  Bins are kept in order of their residual capacity and carry bitmaps
of the duplicate clusters and of the sources they hold; a document starts at the smallest
residual that takes it and goes on to the next larger one until a bin is compatible.
Clusters and sources that occur once in a group need no bit."""

from __future__ import annotations

import bisect
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import ascii_lower, each_copy, fresh, materialize, order_id, whole_text


class Bins:
    """Open bins by (residual, number), with cluster and source bitmaps.  ``per_source``
    bitmaps count a source's documents: a source is refused when all have its bit."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.order: list[tuple[int, int]] = []
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []

    def place(self, size: int, cluster: int, source: int) -> int:
        """Number of the tightest compatible bin, a new one if there is none.  ``cluster`` and
        ``source`` are bits, or 0 where there is nothing to conflict with."""
        at = bisect.bisect_left(self.order, (size, -1))
        while at < len(self.order):
            residual, b = self.order[at]
            if not self.clusters[b] & cluster and not (source and all(plane & source for plane in self.sources[b])):
                del self.order[at]
                break
            at += 1
        else:
            residual, b = self.capacity, len(self.clusters)
            self.clusters.append(0)
            self.sources.append([0] * self.per_source)
        self.clusters[b] |= cluster
        for p, plane in enumerate(self.sources[b]):
            if not plane & source:
                self.sources[b][p] |= source
                break
        if residual > size:
            bisect.insort(self.order, (residual - size, b))
        return b


def pack_group(sizes: np.ndarray, clusters: list, sources: list, capacity: int, per_source: int) -> np.ndarray:
    """Bin number of each document, in the order given (longest first)."""
    bits = []
    for values, least in ((clusters, 2), (sources, per_source + 1)):
        often = [v for v, n in Counter(v for v in values if v is not None).items() if n >= least]
        bits.append({v: 1 << i for i, v in enumerate(often)})
    bins = Bins(capacity, per_source)
    return np.array([bins.place(int(n), bits[0].get(c, 0), bits[1].get(s, 0)) for n, c, s in zip(sizes, clusters, sources)], dtype=np.int64)


def word_count(text: str = "text") -> Column:
    """Length of a text in blank-separated words; at least 1, so that empty texts take a place."""
    return F.greatest(F.lit(1), F.size(F.array_remove(F.split(whole_text(text), r"[\x20\x09-\x0D]+"), ""))).cast("long")


def text_cluster(text: str = "text") -> Column:
    """Duplicate cluster of a text: equal words without regard to case or blanks; null for
    texts without words, which conflict with nothing."""
    words = F.trim(F.regexp_replace(ascii_lower(whole_text(text)), r"[\x20\x09-\x0D]+", " "))
    return F.when(words != "", F.xxhash64(words))


def row_places(docs: DataFrame) -> DataFrame:
    """``docs`` with (part, row): where a row stands.  Parquet files as they were read: the
    file and the row in it.  Anything else: the partition and the row in it."""
    if docs._jdf.queryExecution().analyzed().children().isEmpty():  # a sort, filter or join above the files has an order of its own
        try:
            meta = docs.metadataColumn("_metadata")
            return docs.select("*", meta["file_path"].alias("part"), meta["row_index"].alias("row"))
        except AnalysisException:
            pass
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return docs.select("*", F.lpad(F.spark_partition_id().cast("string"), 10, "0").alias("part"), row.alias("row"))


def _part_order(part: str) -> tuple[int, str]:
    number = re.search(r"part-(\d+)[^/]*$", part)
    return int(number[1]) if number else -1, part


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (part, row and others) with ``place``, the number of the row in the whole order.
    One number per file or partition goes through the driver."""
    counts = sorted(((r["part"], r["count"]) for r in rows.groupBy("part").count().collect()), key=lambda x: _part_order(x[0]))
    before, at = [], 0
    for part, n in counts:
        before.append((part, at))
        at += n
    starts = rows.sparkSession.createDataFrame(before, "part string, before long")
    return rows.join(F.broadcast(starts), "part").withColumn("place", F.col("before") + F.col("row")).drop("part", "row", "before")


def best_fit(
    docs: DataFrame, capacity: int = 4096, per_source: int = 8, group_rows: int = 5000, size: Column | None = None, cluster: Column | None = None,
    id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", in_order: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, source, n_words, full_bins, bin_group, bin, bin_words).
    With ``in_order``, ``place`` (the row's number in the order of ``docs``) comes last, and group
    g holds the rows g * ``group_rows`` to (g + 1) * ``group_rows`` - 1 of that order.

    A document longer than ``capacity`` fills ``full_bins`` bins of its own and only its rest
    (``bin_words``) is packed; with no rest, bin is null.  A bin of (bin_group, bin) never holds
    two documents of one cluster, nor more than ``per_source`` of one source.  Null sources and
    null clusters conflict with nothing; null texts count as empty and every text has at least
    one word.  Repeated rows share a cluster, so each gets a bin of its own.  Without
    ``in_order``, groups hold about ``group_rows`` rows, dealt by hash and, among equal rows, by their number, however
    large a source, a cluster or a set of equal rows is."""
    n_words = size if size is not None else word_count(text_col)
    mark = cluster if cluster is not None else text_cluster(text_col)
    names = ["doc_id", "id", "source", "n_words", "cluster", "tag"]
    columns = [
        F.col(id_col).cast("long").alias("doc_id"), order_id(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        n_words.alias("n_words"), mark.alias("cluster"), F.xxhash64(whole_text(text_col)).alias("tag"),
    ]
    if in_order:
        part, row = fresh(docs.columns, "part", "row")
        standing = row_places(docs).toDF(*docs.columns, part, row)
        rows = numbered(materialize(standing.select(*columns, F.col(part).alias("part"), F.col(row).alias("row")), "pack-rows"))
        group, place = F.floor(F.col("place") / group_rows).cast("long"), ["place"]
    else:
        rows = materialize(docs.select(*columns).groupBy(*names).agg(F.count("*").alias("copies")), "pack-rows")
        groups = max(1, -(-(rows.agg(F.sum("copies")).first()[0] or 0) // group_rows))
        rows = each_copy(rows, "copies", "copy")
        group, place = F.pmod(F.xxhash64("id", "tag", "source", "copy"), F.lit(groups)), []
    rest = F.pmod(F.col("n_words"), F.lit(capacity))
    rows = rows.withColumn("full_bins", (F.col("n_words") - rest) / capacity).withColumn("bin_words", rest)
    rows = rows.withColumn("full_bins", F.col("full_bins").cast("long")).withColumn("bin_group", group)
    out = ["doc_id", "source", "n_words", "full_bins", "bin_group", "bin", "bin_words", *place]
    schema = ", ".join(f"{c} {'string' if c == 'source' else 'long'}" for c in out)
    whole = rows.where("bin_words = 0").withColumn("bin", F.lit(None).cast("long")).select(*out)

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bin_words", "id", "tag", "source", *place], ascending=[False, True, True, True, *(True for _ in place)], na_position="last", kind="stable")
        own = [None if pd.isna(c) else int(c) for c in pdf["mark"]]
        src = [None if pd.isna(x) else x for x in pdf["source"]]
        pdf["bin"] = pack_group(pdf["bin_words"].to_numpy(np.int64), own, src, capacity, per_source)
        return pdf[out]

    # clusters travel as text: a nullable long would lose bits on its way through doubles
    packed = rows.where("bin_words > 0").withColumn("mark", F.col("cluster").cast("string")).drop("cluster").groupBy("bin_group").applyInPandas(pack, schema)
    return packed.unionByName(whole)

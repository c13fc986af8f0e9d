"""Exact dedup by two-pass Bloom filtering, in DataFrame functions only.

The text is read once, for its SHA-256.  Pass one counts the Bloom slots of all digests
(partially aggregated longs) and keeps the slots that were hit twice or more, as bitmaps.
Pass two probes them: digests with a slot hit only once are surely unique and pass straight
through; only the rest shuffle by digest.  A filter has at most ``max_filter_bits``: beyond the
rows that fit, digests are dealt to parts, each with a filter of its own, one after the other,
so the share of unique rows that pass straight through does not fall with the input."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import materialize, whole_text

PAGE_BITS = 8 * 4096  # size of one bitmap of bitmap_construct_agg


def _slots(digest: str, hashes: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.col(digest), F.lit(j)), F.lit(bits)) for j in range(hashes)]


def repeated_slots(rows: DataFrame, bits: int, hashes: int) -> DataFrame:
    """(page, bitmap): the Bloom slots that at least two insertions hit."""
    hit = rows.select(F.explode(F.array(*_slots("digest", hashes, bits))).alias("slot")).groupBy("slot").count()
    twice = hit.where("count > 1").select((F.expr(f"slot div {PAGE_BITS}")).alias("page"), (F.col("slot") % PAGE_BITS).alias("bit"))
    return twice.groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def _bit_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.expr("1").cast("int") == F.call_function("getbit", byte, (bit % 8).cast("int")), F.lit(False))


def possibly_repeated(rows: DataFrame, pages: DataFrame, bits: int, hashes: int) -> DataFrame:
    """``rows`` with ``maybe``: whether all the digest's slots were hit twice."""
    out, tests = rows, []
    for j, slot in enumerate(_slots("digest", hashes, bits)):
        # at most bits / 8 bytes in all: bounded by max_filter_bits
        own = F.broadcast(pages.toDF(f"page{j}", f"bitmap{j}"))
        out = out.withColumn(f"slot{j}", slot).join(own, F.expr(f"slot{j} div {PAGE_BITS}") == F.col(f"page{j}"), "left")
        tests.append(_bit_set(F.col(f"bitmap{j}"), F.col(f"slot{j}") % PAGE_BITS))
    return out.select(*rows.columns, reduce(lambda a, b: a & b, tests).alias("maybe"))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits_per_row: int = 16, hashes: int = 3, max_filter_bits: int = 1 << 28
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, keep_id, group_size long, kept boolean,
    text_sha256 string, passed boolean: did not shuffle).

    Texts are equal when identical (by SHA-256); null counts as empty.  The largest doc_id of
    equal texts stays; null ids are smaller than all others.  Repeated rows each count in
    group_size, and rows that repeat the kept doc_id are all marked kept.  Other columns are
    not read.  Very long texts count as one digest; an empty table gives no rows."""
    rows = materialize(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(whole_text(text_col), 256)).alias("digest")), "digests"
    )
    wanted = rows.count() * bits_per_row
    parts = max(1, -(-wanted // max_filter_bits))
    if parts == 1:
        return _filtered(rows, min(max_filter_bits, 1 << max(15, (wanted - 1).bit_length())), hashes)
    # sorted within each task's file, so a part reads only its own pages of them
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("digest", F.lit("part")), F.lit(parts)).cast("int"))
    dealt = materialize(dealt.sortWithinPartitions("part"), "digest-parts")
    done = [materialize(_filtered(dealt.where(F.col("part") == p).drop("part"), max_filter_bits, hashes), f"exact-{p}") for p in range(parts)]
    return reduce(DataFrame.unionByName, done)


def _filtered(rows: DataFrame, bits: int, hashes: int) -> DataFrame:
    """The result for rows of (doc_id, digest) through one filter."""
    pages = materialize(repeated_slots(rows, bits, hashes), "bloom")
    probed = possibly_repeated(rows, pages, bits, hashes)
    alone = probed.where("not maybe").select(
        "doc_id", "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("passed")
    )
    several = probed.where("maybe").select("doc_id", "digest")
    groups = several.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    # the second key keeps the join's exchange apart from the aggregate's: AQE can split hot digests
    met = several.withColumn("k", F.xxhash64("digest")).join(groups.withColumn("k", F.xxhash64("digest")), ["digest", "k"])
    met = met.select("doc_id", "digest", "keep_id", "group_size", F.lit(False).alias("passed"))
    return alone.unionByName(met).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "passed",
    )

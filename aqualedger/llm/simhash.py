"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most ``2 r`` bits apart have a common point at most ``r`` bits from
each.  So every distinct fingerprint emits its whole ball of radius r = max_bits / 2 (2081
variants for r = 2) and fingerprints that meet on a variant are links.  Variants are
shuffled by their leading bits: a fingerprint goes to each leading-bit partition that its
ball touches, and the part of the ball that lies there is enumerated inside the task.  The
partitions hold disjoint ranges of variants, so this is the shuffle on variants without
writing 2081 rows per fingerprint."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components, local_forest
from .util import fresh, materialize, order_id, whole_text

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SHINGLES_AT_ONCE = 200_000  # hashes held at a time, however long the text
VARIANTS_AT_ONCE = 4_000_000  # ball points that a task enumerates at a time


def fingerprint(text: str | None, shingle_words: int = 4) -> int:
    """64-bit SimHash over word shingles with repeats; 0 for no words."""
    words = WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(LOWER))
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = (ends[shingle_words - 1 :] if len(words) >= shingle_words else ends[-1:]).tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, SHINGLES_AT_ONCE):
        part = slice(at, at + SHINGLES_AT_ONCE)
        h = np.array([digest(joined[i:j], 42) for i, j in zip(starts[part], stops[part])], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 4, id_col: str = "doc_id", text_col: str = "text", more: Mapping[str, Column] | None = None) -> DataFrame:
    """(doc_id, fp long): the fingerprint of every whole text, as a signed long; and ``more``
    longs by name."""
    more = more or {}
    kept = list(more)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = np.array([fingerprint(t, shingle_words) for t in pdf["text"]], dtype=np.uint64)
            yield pd.DataFrame({"id": pdf["id"], "null_id": pdf["null_id"], "fp": fp.view(np.int64)} | {c: pdf[c] for c in kept})

    src = docs.select(order_id(id_col).alias("id"), F.col(id_col).isNull().alias("null_id"), F.col(text_col).cast("string").alias("text"), *[x.alias(c) for c, x in more.items()])
    return src.mapInPandas(run, ", ".join(["id long, null_id boolean, fp long", *(f"{c} long" for c in more)])).select(
        F.when(~F.col("null_id"), F.col("id")).alias("doc_id"), "fp", *more
    )


def masks(bits: Iterable[int], radius: int) -> np.ndarray:
    """All XOR masks that flip at most ``radius`` of the given bits."""
    return np.array([sum(1 << b for b in c) for k in range(radius + 1) for c in combinations(bits, k)], dtype=np.uint64)


def ball_links(part: int, fps: np.ndarray, lead: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among the distinct fingerprints ``fps`` that meet on a variant whose first
    ``lead`` bits equal ``part``, as a spanning forest (node, smaller node).  Parts with
    more than VARIANTS_AT_ONCE points are enumerated piece by piece, by further bits."""
    flips = np.bitwise_count((fps >> np.uint64(64 - lead)) ^ np.uint64(part))
    inside = flips <= radius
    fps, flips = fps[inside], flips[inside]
    rings = [(fps[flips == k], masks(range(64 - lead), radius - k)) for k in range(radius + 1)]
    sizes = [len(own) * len(m) for own, m in rings]
    if sum(sizes) > VARIANTS_AT_ONCE and lead <= 56:
        found = [ball_links(part << 4 | piece, fps, lead + 4, radius) for piece in range(16)]
        return local_forest(*(np.concatenate(side) for side in zip(*found)))
    low = np.uint64((1 << (64 - lead)) - 1)
    points = np.concatenate([((own & low)[:, None] ^ m[None, :]).ravel() for own, m in rings])
    order = np.sort(points)
    met = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(met):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # only points on which two met; those who meet are linked to the smallest of them
    slot = np.minimum(np.searchsorted(met, points), len(met) - 1)
    hit = np.flatnonzero(met[slot] == points)
    slot = slot[hit]
    owner = np.concatenate([np.repeat(own, len(m)) for own, m in rings])[hit].view(np.int64)
    least = np.full(len(met), np.iinfo(np.int64).max)
    np.minimum.at(least, slot, owner)
    pairs = np.unique(np.stack([owner, least[slot]]), axis=1)
    near = np.bitwise_count(pairs[0].view(np.uint64) ^ pairs[1].view(np.uint64)) <= 2 * radius
    return local_forest(pairs[0][near], pairs[1][near])


def _deal(fps: DataFrame, lead: int, radius: int) -> DataFrame:
    """(fp, part, n): each fingerprint at every leading-bit part its ball touches, with the
    number of its variants there."""
    reach = masks(range(lead), radius).astype(np.int64)
    points = [len(masks(range(64 - lead), radius - k)) for k in range(radius + 1)]
    seats = F.array(*[F.struct(F.lit(int(m)).alias("m"), F.lit(points[int(m).bit_count()]).alias("n")) for m in reach])
    own = F.shiftrightunsigned("fp", 64 - lead)
    return fps.select("fp", F.inline(seats)).select("fp", own.bitwiseXOR(F.col("m")).alias("part"), "n")


def near_links(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """Distinct fingerprints (fp long) -> (u, v) links that connect exactly the fingerprints
    which chains of at most ``max_bits`` differing bits connect.

    Parts that hold many times the expected variants (large groups of near copies) are
    dealt out again by four more leading bits, until no part is hot."""
    if max_bits % 2 or not 0 < max_bits <= 8:
        raise ValueError("max_bits must be 2, 4, 6 or 8: half of it is the ball's radius")
    radius = max_bits // 2
    ball = len(masks(range(64), radius))
    lead = max(4, min(20, int(np.ceil(np.log2(max(1, fps.count() * ball / VARIANTS_AT_ONCE))))))

    def solver(lead: int):
        def solve(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            u, v = ball_links(int(key[0]), pdf["fp"].to_numpy(np.int64).view(np.uint64), lead, radius)
            return pd.DataFrame({"u": u, "v": v})

        return solve

    dealt, links = _deal(fps, lead, radius), None
    while True:
        hot = dealt.groupBy("part").agg(F.sum("n").alias("n")).where(F.col("n") > 4 * VARIANTS_AT_ONCE).select("part")
        hot = materialize(hot, "simhash-hot") if lead <= 40 else hot.limit(0)
        last = lead > 40 or hot.isEmpty()
        calm = dealt if last else dealt.join(hot, "part", "left_anti")
        out = calm.groupBy("part").applyInPandas(solver(lead), "u long, v long")
        links = out if links is None else links.unionAll(out)
        if last:
            return links
        lead += 4
        parent = F.shiftrightunsigned("part", 4)
        dealt = _deal(fps, lead, radius).join(hot.withColumnRenamed("part", "hot_part"), parent == F.col("hot_part"), "left_semi")


def _grouped(fps: DataFrame, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """``fps`` (doc_id, fp and others) written once, and the components of its fingerprints:
    (fp, first_id, root)."""
    rows = materialize(fps, "simhash-fp")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = connected_components(near_links(distinct.select("fp"), max_bits))
    return rows, distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("root")
    )


def simhash_components(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, fp long, component_id), the smallest doc_id
    reachable over fingerprints at most ``max_bits`` apart.

    Null texts count as empty; texts without words have fingerprint 0 and link like any
    other.  A null doc_id is returned as null and never names a component unless the whole
    component has null ids.  Repeated rows stay repeated; other columns are not read."""
    rows, placed = _grouped(fingerprints(docs, shingle_words, id_col, text_col), max_bits)
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = placed.select("fp", "root", F.xxhash64("root").alias("k")).join(
        least.withColumn("k", F.xxhash64("root")), ["root", "k"]
    ).select("fp", "component_id")
    return rows.withColumn("k", F.xxhash64("fp")).join(named.withColumn("k", F.xxhash64("fp")), ["fp", "k"]).select(
        "doc_id", "fp", "component_id"
    )


def near_dedup(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: the smallest doc_id (null
    ids come last), among several texts or rows of that id the smallest hash."""
    names = fresh(docs.columns, "own_id", "null_id", "tag", "whole_row")
    own_id, null_id, tag, whole_row = names
    hashes = {tag: F.xxhash64(whole_text("text")), whole_row: F.xxhash64(*docs.columns)}
    rows, placed = _grouped(fingerprints(docs, shingle_words, more={"tag": hashes[tag], "whole_row": hashes[whole_row]}), max_bits)
    # equal rows are counted, then the first of each fingerprint and component found: no task holds a whole group
    copies = rows.groupBy("doc_id", "fp", "tag", "whole_row").agg(F.count("*").alias("copies"))
    mark = F.struct(order_id("doc_id").alias(own_id), F.col("doc_id").isNull().alias(null_id), F.col("tag").alias(tag), F.col("whole_row").alias(whole_row), "copies")
    least = copies.groupBy("fp").agg(F.min(mark).alias("m")).join(placed, "fp").groupBy("root").agg(F.min("m").alias("m")).select("m.*")
    least = materialize(least, "simhash-kept")
    keyed = docs.withColumns({own_id: order_id("doc_id"), null_id: F.col("doc_id").isNull(), **hashes})
    kept = keyed.join(least.where("copies = 1").drop("copies"), names, "left_semi")
    often = least.where("copies > 1").drop("copies")
    if not often.isEmpty():  # only rows that repeat are sorted with their texts
        kept = kept.unionByName(keyed.join(often, names, "left_semi").dropDuplicates(names))
    return kept.select(*docs.columns)

"""MinHash near-duplicates by fast similarity sketching, banding and exact verification.

A set's sketch has t coordinates.  Round i hashes every element anew: in the first t rounds
to a coordinate of its own choice, in the t rounds after them to coordinate i - t, and each
coordinate keeps its smallest (round, hash).  So rounds stop as soon as every coordinate is
filled, at the latest after 2 t rounds, and the coordinates agree with the probability of
the sets' Jaccard similarity, as concentrated as t independent ones.

Sets that agree on all rows of a band are candidates.  Texts with equal sets are one node;
a band's bucket links its nodes to its smallest one, and the components of these links are
the groups within which links are confirmed on full sets.  A group goes through tasks in
blocks of bounded size: by size class (sets whose sizes differ by more than the threshold
cannot be linked) and by hash, every two blocks that may hold a link meeting in one task."""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components, local_forest
from .util import fresh, materialize, order_id, whole_text

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
BANDS, ROWS = 42, 6  # 252 coordinates; a link at exactly 0.8 is missed with probability 3e-6
BLOCK = 1 << 18  # shingles of a group that one task holds of either block (8 bytes each)
ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str, words_each: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles (fewer words: the whole
    sequence; none: empty)."""
    words = WORD.findall(text.encode("utf-8", "surrogatepass").translate(LOWER))
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: max(1, len(words) - words_each + 1)]
    stops = ends[words_each - 1 :] if len(words) >= words_each else ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[i:j]) for i, j in zip(starts.tolist(), stops.tolist())), np.uint64, len(starts)))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sketch(elements: np.ndarray, t: int) -> np.ndarray:
    """The fast similarity sketch of a non-empty set: t values (round above, hash below)."""
    values = np.full(t, np.iinfo(np.uint64).max, np.uint64)
    at, step = 0, 1 + 3 * t // len(elements)  # so many rounds at a time as draw a few times t hashes
    while at < 2 * t:
        rounds = np.arange(at, min(at + step, 2 * t), dtype=np.uint64)
        drawn = _mixed(elements[None, :] + (rounds[:, None] + np.uint64(1)) * ODD)
        place = np.where(rounds[:, None] < t, (drawn >> np.uint64(32)) % np.uint64(t), rounds[:, None] - np.uint64(t))
        value = (rounds[:, None] << np.uint64(32)) | (drawn & np.uint64(0xFFFFFFFF))
        np.minimum.at(values, place.ravel().astype(np.int64), value.ravel())
        if values.max() != np.iinfo(np.uint64).max:
            break  # later rounds only bring larger values
        at += step
    return values


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for the values of each band and its number; sketches row by row, keys too."""
    banded = values.reshape(-1, bands, rows)
    keys = np.arange(bands, dtype=np.uint64)[None, :]
    for r in range(rows):
        keys = _mixed(keys * ODD + banded[:, :, r])
    return keys


def _sketched(docs: DataFrame, shingle_words: int, bands: int, rows: int, id_col: str, text_col: str, more: dict[str, Column]) -> DataFrame:
    """(id, null_id, tag, others, node, n, keys): a text's hash, the digest and size of its set,
    and its band keys (8 bytes each); node and keys are null for empty sets."""
    kept = ["id", "null_id", "tag", *more]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            node, n, sketches = [], [], []
            for text in pdf["text"]:
                own = shingle_set(text, shingle_words)
                n.append(len(own))
                node.append(xxhash.xxh3_64_intdigest(own.astype("<u8").tobytes()) - (1 << 63) if len(own) else None)
                if len(own):
                    sketches.append(sketch(own, bands * rows))
            found = iter(band_keys(np.array(sketches), bands, rows).astype("<u8") if sketches else ())
            keys = [next(found).tobytes() if k else None for k in n]
            yield pd.DataFrame({c: pdf[c] for c in kept} | {"node": pd.array(node, dtype="Int64"), "n": n, "keys": keys})

    text = whole_text(text_col).cast("string")
    src = docs.select(
        order_id(id_col).alias("id"), F.col(id_col).isNull().alias("null_id"), F.xxhash64(text).alias("tag"), *[c.alias(k) for k, c in more.items()], text.alias("text")
    )
    schema = ", ".join(["id long, null_id boolean, tag long", *(f"{k} long" for k in more), "node long, n long, keys binary"])
    return src.mapInPandas(run, schema)


def _candidate_groups(distinct: DataFrame) -> DataFrame:
    """(node, component) of every node that shares a band key with another; the smallest node of
    a component is in it, too."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = np.frombuffer(b"".join(pdf["keys"]), "<u8").astype(np.uint64).view(np.int64)
            each = len(keys) // max(1, len(pdf))
            yield pd.DataFrame({"bucket": keys, "node": np.repeat(pdf["node"].to_numpy(np.int64), each)})

    seats = distinct.select("node", "keys").mapInPandas(spread, "bucket long, node long")
    first = seats.groupBy("bucket").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last")
    # a second key column keeps the join's exchange apart from the aggregate's, so AQE may split a hot bucket
    links = seats.withColumn("k", F.xxhash64("bucket")).join(first.withColumn("k", F.xxhash64("bucket")), ["bucket", "k"])
    links = links.where("node <> first").select(F.col("node").alias("u"), F.col("first").alias("v"))
    found = materialize(connected_components(links), "minhash-groups")
    return found.unionAll(found.select(F.col("component").alias("node"), "component").distinct())


def _blocks(members: DataFrame, percent: int) -> DataFrame:
    """(node, component, seat columns g, a, b, i, j, side) for (node, component, n): the tasks a
    node goes to.

    Whole components up to BLOCK shingles share a task with others.  A larger one is cut into
    size classes, whose bounds differ by the threshold, and each class into blocks by hash; a
    block meets every block of its own class and of the next, once each."""
    ratio = -log(percent / 100) if percent < 100 else None
    size_class = F.floor(F.log("n") / ratio).cast("int") if ratio else F.col("n").cast("int")
    sized = members.withColumn("c", size_class)
    weights = sized.groupBy("component", "c").agg(F.sum("n").alias("w"))
    weights = materialize(weights, "minhash-weights")
    totals = weights.groupBy("component").agg(F.sum("w").alias("total"))
    small = totals.where(F.col("total") <= BLOCK)
    packs = max(1, int((small.agg(F.sum("total")).first()[0] or 0) / BLOCK))
    key = F.xxhash64("component")
    together = members.withColumn("k", key).join(small.select("component", key.alias("k")), ["component", "k"])
    zero = F.lit(0).cast("int")
    together = together.select(
        "node", "component", F.pmod(F.xxhash64("component", F.lit(1)), F.lit(packs)).alias("g"),
        *[(zero - 1).alias(c) for c in ("a", "b")], *[zero.alias(c) for c in ("i", "j", "side")],
    )
    parts = weights.join(totals.where(F.col("total") > BLOCK).select("component"), "component")
    parts = parts.select("component", "c", F.ceil(F.col("w") / BLOCK).cast("int").alias("k_own"))
    above = parts.select("component", (F.col("c") - 1).alias("c"), F.col("k_own").alias("k_above"))
    below = parts.select("component", (F.col("c") + 1).alias("c"), F.col("k_own").alias("k_below"))
    plan = parts.join(above, ["component", "c"], "left").join(below, ["component", "c"], "left")
    cut = sized.withColumn("h", F.xxhash64("component", "c")).join(plan.withColumn("h", F.xxhash64("component", "c")), ["component", "c", "h"])
    cut = cut.withColumn("own", F.pmod(F.xxhash64("node", F.lit(2)), F.col("k_own")).cast("int"))

    def seats(count: str) -> Column:
        return F.sequence(zero, F.col(count) - 1)

    def seat(a: Column, b: Column, i: Column, j: Column, side: Column) -> Column:
        return F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"), i.alias("i"), j.alias("j"), side.cast("int").alias("side"))

    own, c = F.col("own"), F.col("c")
    same = F.transform(seats("k_own"), lambda x: seat(c, c, F.least(own, x), F.greatest(own, x), F.when(own > x, 1).otherwise(0)))
    up = F.when(F.col("k_above").isNotNull(), F.transform(seats("k_above"), lambda x: seat(c, c + 1, own, x, F.lit(0))))
    down = F.when(F.col("k_below").isNotNull(), F.transform(seats("k_below"), lambda x: seat(c - 1, c, x, own, F.lit(1))))
    none = F.array().cast("array<struct<a:int,b:int,i:int,j:int,side:int>>")
    apart = cut.select("node", "component", F.col("component").alias("g"), F.explode(F.concat(same, F.coalesce(up, none), F.coalesce(down, none))).alias("s"))
    return together.unionAll(apart.select("node", "component", "g", "s.*"))


def linked_forest(nodes: np.ndarray, sets: list[np.ndarray], side: np.ndarray | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smaller node) that connect exactly what chains of pairs with
    100 |A and B| >= percent |A or B| connect, over all pairs or, given sides 0 and 1, those across."""
    m = len(nodes)
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(m), sizes)
    _, code, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = held[code] > 1  # a shingle of one set only is in no intersection
    owner, code = owner[keep], code[keep]
    by_code = np.argsort(code, kind="stable")
    holders, stop = owner[by_code], np.cumsum(np.bincount(code, minlength=len(held)))
    start = stop - np.bincount(code, minlength=len(held))
    first = np.searchsorted(owner, np.arange(m + 1))
    root = np.arange(m)
    apart = m
    across = np.ones(m, bool) if side is None else side == 1
    for u in range(m) if side is None else np.flatnonzero(side == 0):
        if apart == 1:
            break
        own = code[first[u] : first[u + 1]]
        lengths = stop[own] - start[own]
        total = int(lengths.sum())
        if not total:
            continue
        # all holders of all its shingles: their counts are the intersections with every set
        at = np.repeat(start[own] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(total)
        common = np.bincount(holders[at], minlength=m)
        common[u] = 0
        hit = np.flatnonzero(100 * common >= percent * (sizes[u] + sizes - common))
        hit = hit[(common[hit] > 0) & across[hit]]
        roots = np.unique(np.append(root[hit], root[u]))
        if len(roots) > 1:
            root[np.isin(root, roots)] = roots[0]
            apart -= len(roots) - 1
    own = nodes[root]
    moved = own != nodes
    return nodes[moved], own[moved]


def _verified_links(placed: DataFrame, percent: int) -> DataFrame:
    """(u, v) for (node, component, shingles binary, g, a, b, i, j, side)."""

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        us, vs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        seat = pdf.iloc[0]
        one_block = seat["a"] == seat["b"] and seat["i"] == seat["j"]
        for _, own in pdf.drop_duplicates(["node", "side"]).groupby("component", sort=False):
            sets = [np.frombuffer(b, "<u8") for b in own["shingles"]]
            u, v = linked_forest(own["node"].to_numpy(np.int64), sets, None if one_block else own["side"].to_numpy(), percent)
            us.append(u)
            vs.append(v)
        u, v = local_forest(np.concatenate(us), np.concatenate(vs))
        return pd.DataFrame({"u": u, "v": v})

    return placed.groupBy("g", "a", "b", "i", "j").applyInPandas(solve, "u long, v long")


def _linked(docs: DataFrame, shingle_words: int, percent: int, bands: int, rows: int, id_col: str, text_col: str, more: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """The sketched rows of ``docs``, written once, and (node, root) of every node with a link."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be in 1..100")
    sketched = materialize(_sketched(docs, shingle_words, bands, rows, id_col, text_col, more), "minhash-rows")
    full = sketched.where(F.col("node").isNotNull())
    # equal sets have equal keys and sizes, so the first ones do; any row may stand for the node
    distinct = full.groupBy("node").agg(F.first("n").alias("n"), F.first("keys").alias("keys"))
    groups = materialize(_candidate_groups(distinct), "minhash-candidates")
    # one row to rebuild each candidate's set from: the smallest (id, text)
    reps = full.groupBy("node", "id", "null_id", "tag").agg(F.count(F.lit(1)).alias("times"), F.first("n").alias("n"))
    reps = reps.groupBy("node").agg(F.min(F.struct("id", "null_id", "tag", "times", "n")).alias("r")).select("node", "r.*")
    members = materialize(reps.join(groups, "node").select("node", "component", "id", "null_id", "tag", "times", "n"), "minhash-members")

    text = whole_text(text_col).cast("string")
    texts = docs.select(order_id(id_col).alias("id"), F.col(id_col).isNull().alias("null_id"), F.xxhash64(text).alias("tag"), text.alias("text"))
    key = ["id", "null_id", "tag"]
    chosen = texts.join(members.where("times = 1").select("node", *key).hint("merge"), key)  # alike at every size
    often = members.where("times > 1").select("node", *key)
    if not often.isEmpty():  # only rows that repeat are sorted with their texts
        chosen = chosen.unionByName(texts.join(often.select(*key), key, "left_semi").dropDuplicates(key).join(often, key))

    def rebuild(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"node": pdf["node"], "shingles": [shingle_set(t, shingle_words).astype("<u8").tobytes() for t in pdf["text"]]})

    sets = chosen.select("node", "text").mapInPandas(rebuild, "node long, shingles binary")
    placed = _blocks(members.select("node", "component", "n"), percent).join(sets, "node")
    links = materialize(_verified_links(placed, percent), "minhash-links")
    found = materialize(connected_components(links), "minhash-components")
    return sketched, found.select("node", F.col("component").alias("root"))


def minhash_components(
    docs: DataFrame,
    shingle_words: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id, kept).

    Texts whose sets of distinct word shingles have 100 |A and B| >= percent |A or B| are linked,
    always on the full sets; ``component_id`` is the smallest doc_id reachable.  Candidates come
    from ``bands`` bands of ``rows`` sketch coordinates.  Texts with fewer words than a shingle
    have one shingle, their whole sequence.  Null and empty texts and texts without words have an
    empty set and are linked with nothing, one another included.  A null doc_id is returned as
    null, names a component only if all its ids are null, and is ``kept`` only then.  Repeated
    rows stay repeated and are all ``kept`` where their id names the component.  Sets are told
    apart by 64-bit digests.  Whole texts are read, however long; an empty table gives no rows.
    Only the id and text columns are read, so other columns may have any name."""
    sketched, linked = _linked(docs, shingle_words, percent, bands, rows, id_col, text_col, {})
    own = F.when(~F.col("null_id"), F.col("id"))
    full = sketched.where(F.col("node").isNotNull())
    least = full.groupBy("node").agg(F.min(own).alias("first_id"))
    least = least.join(linked, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "first_id")
    named = least.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # second keys keep the exchanges apart from the aggregates', so AQE may split hot ones
    named = least.withColumn("k", F.xxhash64("root")).join(named.withColumn("k", F.xxhash64("root")), ["root", "k"]).select("node", "component_id")
    out = sketched.withColumn("k", F.xxhash64("node")).join(named.withColumn("k", F.xxhash64("node")), ["node", "k"], "left")
    component = F.when(F.col("node").isNull(), own).otherwise(F.col("component_id"))
    return out.select(own.alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), own.eqNullSafe(component).alias("kept"))


def near_dedup(docs: DataFrame, shingle_words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row of ``docs`` (columns id ``doc_id`` and ``text``) for each component, with all its
    columns: the smallest doc_id (null ids come last), among several texts or rows of that id the
    smallest hash; all rows with an empty set stay.  See ``minhash_components``."""
    own_id, null_id, tag, whole_row = fresh(docs.columns, "own_id", "null_id", "tag", "whole_row")
    key = [own_id, null_id, tag, whole_row]
    sketched, linked = _linked(docs, shingle_words, percent, bands, rows, "doc_id", "text", {"whole_row": F.xxhash64(*docs.columns)})
    mark = F.struct(F.col("id").alias(own_id), F.col("null_id").alias(null_id), F.col("tag").alias(tag), F.col("whole_row").alias(whole_row), "copies")
    copies = sketched.where(F.col("node").isNotNull()).groupBy("id", "null_id", "tag", "whole_row", "node").agg(F.count(F.lit(1)).alias("copies"))
    least = copies.groupBy("node").agg(F.min(mark).alias("m")).join(linked, "node", "left")
    least = least.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("m").alias("m")).select("m.*")
    bare = sketched.where(F.col("node").isNull()).select(F.col("id").alias(own_id), F.col("null_id").alias(null_id), F.col("tag").alias(tag), F.col("whole_row").alias(whole_row))
    least = materialize(least.unionByName(bare.distinct().withColumn("copies", F.lit(1).cast("long"))), "minhash-kept")
    hashes = {own_id: order_id("doc_id"), null_id: F.col("doc_id").isNull(), tag: F.xxhash64(whole_text("text").cast("string")), whole_row: F.xxhash64(*docs.columns)}
    keyed = docs.withColumns(hashes)
    kept = keyed.join(least.where("copies = 1").select(*key), key, "left_semi")
    often = least.where("copies > 1").select(*key)
    if not often.isEmpty():
        kept = kept.unionByName(keyed.join(often, key, "left_semi").dropDuplicates(key))
    return kept.select(*docs.columns)

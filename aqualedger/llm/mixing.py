"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in hash order, form blocks.  Time is counted in block slots.  All
sources advance evenly: at virtual time v a source of weight w has min(w v, its blocks) in
the ideal mixture, and T(v), the sum over the sources, is the slot reached.  Block i is
released at floor(T(i / w)) and due at ceil(T((i + 1) / w)); the earliest deadline among the
released blocks goes next.  That keeps every source less than one block from its ideal share
at every slot, to the end, also where sources run out and the others' shares grow.  Releases
and deadlines are computed from the exact rational weights, so nothing accumulates.

The slots are cut into stretches that are scheduled apart.  At a cut, a source has at most one
block whose window spans it, f of which the ideal mixture has run.  Which of these blocks run
before the cut is decided from the cut alone: earliest deadline first, taking at most ceil(sum
of f) among those released at or after any slot.  So many slots are free of blocks due before
the cut; and since whole numbers within both orders' bounds exist where fractions do, at least
floor(sum of f) of those due by any slot are taken, which leaves the rest room behind it.
Stretches are longer than any window, so no block spans two cuts.  No document is dropped or
repeated."""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction
from itertools import groupby, islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .util import each_copy, fresh, materialize, order_id, whole_text

NO_SOURCE = ""  # name under which rows without a source are mixed
ROWS_PER_BUCKET = 1000
BUCKETS_PER_RANGE = 1000
STRETCH = 65536  # least slots of a stretch
SLOTS_PER_SOURCE = 16  # a cut costs a step for each source


class Ideal:
    """The ideal mixture of sources with ``blocks`` and whole-number ``weights`` (any common scale)."""

    def __init__(self, blocks: Sequence[int], weights: Sequence[int]):
        self.blocks, self.weights = blocks, weights
        self.live = sorted((s for s, n in enumerate(blocks) if n > 0), key=lambda s: Fraction(blocks[s], weights[s]))
        self.slots = sum(blocks[s] for s in self.live)
        # T(v) = ended + v * total until a source ends: (its blocks, its weight, ended, total)
        self.pieces, self.ends, self.tops = [], [], []
        ended, total = 0, sum(weights[s] for s in self.live)
        for s in self.live:
            self.pieces.append((blocks[s], weights[s], ended, total))
            self.ends.append(Fraction(blocks[s], weights[s]))
            self.tops.append(ended + self.ends[-1] * total)
            ended, total = ended + blocks[s], total - weights[s]

    def piece(self, s: int, i: int) -> int:
        """The piece in which source s has run i blocks."""
        return bisect_left(self.ends, Fraction(i, self.weights[s]))

    def reach(self, s: int, i: int, p: int) -> tuple[int, int, int]:
        """Floor and ceil of T(i / w) and its piece, which is ``p`` or a later one."""
        w = self.weights[s]
        while i * self.pieces[p][1] > self.pieces[p][0] * w:
            p += 1
        _, _, ended, total = self.pieces[p]
        return ended + i * total // w, ended - (-i * total // w), p

    def before(self, t: int) -> list[int]:
        """How many blocks of each source run before a cut at slot t."""
        if t >= self.slots:
            return list(self.blocks)
        done = [0] * len(self.blocks)
        if t <= 0:
            return done
        _, _, ended, total = self.pieces[bisect_left(self.tops, t)]
        v = t - ended  # over total
        spanning = []
        for s in self.live:
            if self.blocks[s] * total <= self.weights[s] * v:
                done[s] = self.blocks[s]
                continue
            done[s], part = divmod(self.weights[s] * v, total)
            if part:
                release, _, p = self.reach(s, done[s], self.piece(s, done[s]))
                spanning.append((release, self.reach(s, done[s] + 1, p)[1], s, part))
        room, parts = {}, 0
        for _, _, s, part in sorted(spanning, reverse=True):  # by release, last first
            parts += part
            room[s] = -(-parts // total)
        free = list(range(parts // total + 1))  # the last free place at or before each

        def last_free(x: int) -> int:
            while free[x] != x:
                free[x] = free[free[x]]
                x = free[x]
            return x

        for _, s in sorted((due, s) for _, due, s, _ in spanning):
            x = last_free(room[s])
            if x:
                free[x] = x - 1
                done[s] += 1
        return done


def schedule(ideal: Ideal, start: int = 0, stop: int | None = None) -> Iterator[tuple[int, int]]:
    """(source, block) of each slot of a stretch: earliest deadline first among the released."""
    stop = ideal.slots if stop is None else min(stop, ideal.slots)
    done, last = ideal.before(start), ideal.before(stop)
    piece, after = {}, {}  # after: release of the next block
    waiting: list[tuple[int, int]] = []
    for s, i in enumerate(done):
        if i < last[s]:
            release, _, piece[s] = ideal.reach(s, i, ideal.piece(s, i))
            waiting.append((max(release, start), s))
    heapq.heapify(waiting)
    ready: list[tuple[int, int]] = []
    for t in range(start, stop):
        while waiting and waiting[0][0] <= t:
            _, s = heapq.heappop(waiting)
            after[s], due, piece[s] = ideal.reach(s, done[s] + 1, piece[s])
            heapq.heappush(ready, (min(due, stop), s))
        _, s = heapq.heappop(ready)
        yield s, done[s]
        done[s] += 1
        if done[s] < last[s]:
            heapq.heappush(waiting, (after[s], s))


def whole_weights(weights: Mapping[str, float]) -> tuple[dict[str, int], int]:
    """The weights times a common factor that makes them whole numbers, and their mean so."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    mean = sum(exact.values()) / len(exact)
    scale = math.lcm(mean.denominator, *(w.denominator for w in exact.values()))
    return {s: int(w * scale) for s, w in exact.items()}, int(mean * scale)


def _scheduled(sources: DataFrame, at_once: int) -> DataFrame:
    """(name, blocks, weight) -> (name, k, slot) of every block.  Each stretch of slots is a
    piece of work of its own, which holds the sources and hands over ``at_once`` slots at a time."""
    weight = F.col("weight").cast("double")
    of = sources.agg(F.count("*").alias("n"), F.sum("blocks").alias("slots"), (F.sum(weight) / F.min(weight)).alias("window")).first()
    slots = of.slots or 0
    window = slots if of.window is None or of.window > slots else math.ceil(of.window * 1.001) + 2  # of the smallest weight
    span = max(STRETCH, SLOTS_PER_SOURCE * of.n, window)
    stretches = max(1, -(-slots // span))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = ((r.stretch, r.name, r.blocks, int(r.weight)) for pdf in batches for r in pdf.itertuples(index=False, name="Row"))
        for stretch, own in groupby(rows, key=lambda r: r[0]):
            _, names, blocks, weights = zip(*own)
            at, placed = stretch * span, schedule(Ideal(blocks, weights), stretch * span, (stretch + 1) * span)
            while held := list(islice(placed, at_once)):
                of, k = zip(*held)
                yield pd.DataFrame({"name": [names[s] for s in of], "k": k, "slot": range(at, at + len(held))})
                at += len(held)

    spread = each_copy(sources.withColumn("stretches", F.lit(stretches).cast("long")), "stretches", "stretch")
    spread = spread.repartition(stretches, "stretch").sortWithinPartitions("stretch", "name")
    return spread.select("stretch", "name", "blocks", "weight").mapInPandas(run, "name string, k long, slot long")


def mix(
    docs: DataFrame, weights: Mapping[str, float] | float | None = None, block_docs: int = 64, frame: int = 8192, max_sources: int | None = None,
    id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """``docs`` with mix_slot (the slot of the document's block) and mix_pos (its place in the
    block) added, leading underscores where such columns exist.  Ordering by both gives the
    mixture.

    ``weights`` by source (positive, any scale); a source without one gets the mean of those
    given, and no weights at all ({}) are equal ones.  A number a gives every source the weight
    n^a of its n documents, rounded to thousandths: 1 keeps the sources' shares, less raises small
    sources.  Without weights (None), every source has its share of blocks, which lasts to the
    end.  Null sources are one source, named ''.  Any number of sources; more than
    ``max_sources``, where it is given, are an error.  Slots are handed over ``frame`` at a time.
    Rows equal in id and text share a place in the order and are told apart by nothing else.  Null
    and empty texts are documents like others, long ones count as one; an empty table gives none."""
    slot_col, pos_col, src, h, bucket, rank, k, src2, bucket2, before, k2, slot2 = fresh(
        docs.columns, "mix_slot", "mix_pos", "src", "h", "bucket", "rank", "k", "src2", "bucket2", "before", "k2", "slot2"
    )
    if isinstance(weights, Mapping) and any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    source = F.coalesce(F.col(source_col).cast("string"), F.lit(NO_SOURCE))
    keyed = docs.withColumns({src: source, h: F.xxhash64(order_id(id_col), whole_text(text_col))})
    sources = keyed.groupBy(F.col(src).alias("name")).agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / block_docs).cast("long"))
    sources = materialize(sources, "mix-sources")
    if max_sources is not None and sources.limit(max_sources + 1).count() > max_sources:
        raise ValueError(f"more than {max_sources} sources")

    # ranks within a source without a window over the whole source: hash buckets, ranges of them, then offsets
    n_buckets = max(1, -(-(sources.agg(F.sum("n")).first()[0] or 0) // ROWS_PER_BUCKET))
    keyed = keyed.withColumn(bucket, F.pmod(F.col(h), F.lit(n_buckets)))
    heads = keyed.groupBy(F.col(src).alias(src2), F.col(bucket).alias(bucket2)).count()
    heads = materialize(heads.withColumn("range", F.floor(F.col(bucket2) / BUCKETS_PER_RANGE)), "mix-heads")
    upto = lambda *keys: F.sum("count").over(W.partitionBy(*keys[:-1]).orderBy(keys[-1])) - F.col("count")
    ranges = heads.groupBy(F.col(src2).alias("of"), F.col("range").alias("at")).agg(F.sum("count").alias("count")).withColumn("head", upto("of", "at")).drop("count")
    offsets = heads.withColumn("inner", upto(src2, "range", bucket2)).join(ranges, (F.col(src2) == F.col("of")) & (F.col("range") == F.col("at")))
    offsets = materialize(offsets.select(src2, bucket2, (F.col("head") + F.col("inner")).alias(before)), "mix-offsets")
    within = F.row_number().over(W.partitionBy(src, bucket).orderBy(h, order_id(id_col))) - 1
    ranked = keyed.withColumn(rank, within).join(offsets, (F.col(src) == F.col(src2)) & (F.col(bucket) == F.col(bucket2))).drop(src2, bucket2)
    ranked = ranked.withColumn(rank, F.col(rank) + F.col(before)).withColumn(k, F.floor(F.col(rank) / block_docs))
    if weights is None:
        weighted = sources.withColumn("weight", F.col("blocks").cast("string"))
    elif isinstance(weights, Mapping):
        given, mean = whole_weights(weights) if weights else ({}, 1)
        known = docs.sparkSession.createDataFrame([(s, str(w)) for s, w in given.items()], "name string, weight string")
        weighted = sources.join(known, "name", "left").withColumn("weight", F.coalesce("weight", F.lit(str(mean))))
    else:
        scaled = F.greatest(F.lit(1), F.round(1000 * F.pow(F.col("n").cast("double"), F.lit(float(weights)))).cast("long"))
        weighted = sources.withColumn("weight", scaled.cast("string"))
    slots = materialize(_scheduled(weighted.select("name", "blocks", "weight"), frame), "mix-slots").toDF(src2, k2, slot2)
    placed = ranked.join(slots, (F.col(src) == F.col(src2)) & (F.col(k) == F.col(k2)))
    return placed.select(*docs.columns, F.col(slot2).cast("long").alias(slot_col), (F.col(rank) % block_docs).cast("long").alias(pos_col))


def mixed(docs: DataFrame, weights: Mapping[str, float] | float | None = None, **more) -> DataFrame:
    """``docs`` in the mixture's order (range-partitioned, so files read in order are the
    mixture), with their own columns only."""
    slot_col, pos_col = fresh(docs.columns, "mix_slot", "mix_pos")
    return mix(docs, weights, **more).orderBy(slot_col, pos_col).select(*docs.columns)

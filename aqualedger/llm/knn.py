"""Exact top-k inner-product search by a Voronoi join.

All vectors fall to the nearest of a set of pivots, themselves rows.  A query's exact
scores against the pivots give a lower bound on its k-th best score; a cell's summary
(its radius around the pivot) gives an upper bound on any score in it, q.p + |q| r.  Queries
are grouped by pivots, and a cell's rows go only to the groups in which some query's bounds
leave it open.  Groups solve each block of a cell locally; the best k are merged.  Scores that
doubles or 64-bit integers cannot hold are computed with Python's integers."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .util import materialize

SLACK = 1e-6  # relative, against rounding of the bounds' square roots
ROUNDING = 1e-9  # relative, far above the rounding of a sum of products in doubles
EXACT = 2.0**53  # whole numbers below are exact in doubles
LARGEST = 2**63 - 1


@dataclass(frozen=True)
class Settings:
    max_pivots: int = 16384  # about sqrt(rows) pivots are taken, in tables of at most pivot_bytes
    pivot_bytes: int = 64 << 20
    queries_per_group: int = 4096
    rows_per_block: int = 8192


def as_matrix(vectors: pd.Series) -> np.ndarray:
    """Rows of whole numbers, padded with zeros to the longest of them."""
    rows = [np.asarray(v, dtype=np.float64) for v in vectors]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of a and b: 64-bit integers, or Python's where a product
    of some row may not fit."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not width or not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    most, more = np.abs(a).max(axis=1), np.abs(b).max(axis=1)
    with np.errstate(over="ignore"):
        if most.max() * more.max() * width < EXACT:  # exact in doubles, and fast
            return (a @ b.T).astype(np.int64)
        # a row is small if its products with all small rows of the other side are exact
        limit = (EXACT / width) ** 0.5
        small, fine = most < limit, more < limit
    out = np.zeros((len(a), len(b)), object)
    out[np.ix_(small, fine)] = (a[small] @ b[fine].T).astype(np.int64).astype(object)
    as_int = lambda x: [[int(c) for c in row] for row in x]
    left, right = as_int(a), as_int(b)
    for i, j in zip(*np.nonzero(~small[:, None] | ~fine[None, :])):
        out[i, j] = sum(x * y for x, y in zip(left[i], right[j]))
    return out


def rounded(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inner products in doubles and a bound on their error (0 where they are exact); what no
    double holds is nan or infinite."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    with np.errstate(over="ignore", invalid="ignore"):
        scores, size = a @ b.T, np.abs(a) @ np.abs(b).T
        return scores, np.where(size < EXACT, 0.0, size * ROUNDING)


def squares(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (x**2).sum(axis=1)


def as_long(scores: list[int]) -> list[int]:
    """Scores as 64-bit integers, the nearest where they do not fit."""
    return [max(-LARGEST, min(LARGEST, int(x))) for x in scores]


def beyond(score: int) -> str:
    """Orders, as text, the scores that ``as_long`` makes equal: '' if it fits."""
    score = int(score)
    if abs(score) < LARGEST:
        return ""
    digits = str(abs(score))
    size = f"{len(digits):04d}{digits}"
    return size if score > 0 else size.translate(str.maketrans("0123456789", "9876543210"))


def top(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> list[np.ndarray]:
    """Per row of ``scores``: positions of the k best, ties to the smaller id, own id left out."""
    out = []
    for row, me in zip(scores, own):
        if row.dtype == object:
            at = np.flatnonzero(ids != me)
            out.append(np.array(sorted(at, key=lambda j: (-row[j], ids[j]))[:k], np.int64))
            continue
        if len(row) > 4 * k + 8:
            kth = np.partition(row, len(row) - k - 1)[len(row) - k - 1]  # one more than k, for the own row
            at = np.flatnonzero(row >= kth)
        else:
            at = np.arange(len(row))
        at = at[ids[at] != me]
        if len(at) < min(k, int((ids != me).sum())):
            at = np.flatnonzero(ids != me)
        out.append(at[np.lexsort((ids[at], -row[at]))][:k])
    return out


class Cells:
    """Pivots with their ids, cell radii, and the query group of each pivot."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.norms = squares(vectors)
        self.radius = np.zeros(len(ids))
        self.first_block = np.zeros(len(ids), np.int64)
        self.blocks = np.zeros(len(ids), np.int64)
        self.group = np.zeros(len(ids), np.int64)

    def set_blocks(self, sizes: dict[int, int], rows_per_block: int) -> None:
        """Small cells share a block, large ones have several of their own."""
        block, room = -1, 0
        for c, n in sorted(sizes.items()):
            if n > room:
                block, room = block + 1, rows_per_block
            self.first_block[c], self.blocks[c] = block, -(-n // rows_per_block)
            block += int(self.blocks[c]) - 1
            room = room - n if n <= rows_per_block else 0

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance) of each row; ties go to the first pivot."""
        own = squares(x)
        scores, error = rounded(x, self.vectors)
        with np.errstate(over="ignore", invalid="ignore"):
            gap = own[:, None] + self.norms[None, :] - 2.0 * scores
            gap += 2.0 * error + np.where(gap + 2.0 * np.abs(scores) < EXACT, 0.0, ROUNDING * (own[:, None] + self.norms[None, :]))
        gap = np.nan_to_num(gap, nan=np.inf)  # beyond doubles: as far as can be
        cell = gap.argmin(axis=1)
        return cell, np.sqrt(np.maximum(gap[np.arange(len(x)), cell], 0))

    def open_cells(self, q: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(floor, open): each query's proven lower bound on its k-th score, and whether a cell
        may hold a score of at least that."""
        scores, error = rounded(q, self.vectors)
        with np.errstate(over="ignore", invalid="ignore"):
            low = np.nan_to_num(scores - error, nan=-np.inf)
            real = np.where(self.ids[None, :] == ids[:, None], -np.inf, low)
            floor = np.sort(real, axis=1)[:, -k] if real.shape[1] >= k else np.full(len(q), -np.inf)
            floor = np.where(np.abs(floor) < EXACT, floor, floor - SLACK * np.abs(floor))  # below the true k-th score
            floor = np.where(np.isfinite(floor), floor, -np.inf)
            reach = np.sqrt(squares(q))[:, None] * self.radius[None, :]
            high = scores + error + reach
            high += SLACK * (np.abs(scores) + reach + 1)
        return floor, (np.nan_to_num(high, nan=np.inf, neginf=np.inf) >= floor[:, None]) & (self.blocks > 0)[None, :]


def quantized(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component, a whole number in a double, exact at any
    size; vectors that are null, or hold null or non-finite components (also scale * x), are left
    out, as are null ids and repeats of a whole row."""
    c = F.col(vector_col).cast("array<double>")
    whole = lambda y: F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)  # noqa: E731  larger doubles are whole
    sound = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & c.isNotNull()).where(F.coalesce(sound, F.lit(False)))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(c, lambda x: whole(x * scale)).alias("v")).distinct()


def _pivots(rows: DataFrame, n: int, s: Settings) -> Cells:
    """About sqrt(n) rows, as far as max_pivots and pivot_bytes allow, spread by id hash; equal vectors count once."""
    width = max(1, rows.agg(F.max(F.size("v"))).first()[0])
    most = max(1, min(s.max_pivots, s.pivot_bytes // (8 * width), int(np.ceil(n**0.5))))
    few = rows.orderBy(F.xxhash64("vec_id"), "vec_id", F.xxhash64("v")).limit(most).toPandas()
    few = few.assign(key=[tuple(v) for v in few["v"]]).drop_duplicates("key").drop_duplicates("vec_id")
    return Cells(few["vec_id"].to_numpy(np.int64), as_matrix(few["v"]))


def _longs(values: np.ndarray) -> Column:
    """A constant array, as one literal however many values it has."""
    return F.from_json(F.lit(json.dumps([int(x) for x in values])), "array<long>")


def top_k(rows: DataFrame, is_query: Column, k: int = 5, s: Settings = Settings()) -> DataFrame:
    """``rows`` (vec_id long, v array of whole doubles) -> (query_id, rank from 1, vec_id, score): for each
    row that ``is_query`` picks, its k highest inner products with rows of other ids (all, if
    fewer), ties to the smaller vec_id.

    Vectors of different lengths are compared as if padded with zeros.  If an id has several
    vectors, each is a candidate of its own, and as queries they are answered together: the
    best k over all of them.  Ranks follow exact scores of any size; a score beyond 64 bits is
    returned as the nearest long.  An empty table, or one vector alone, gives no rows."""
    rows = materialize(rows, "vectors")
    n = rows.count()
    schema = "query_id long, rank int, vec_id long, score long"
    if not n:
        return rows.sparkSession.createDataFrame([], schema)
    cells = _pivots(rows, n, s)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cell, gap = cells.nearest(as_matrix(pdf["v"]))
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "v": pdf["v"], "is_query": pdf["is_query"], "cell": cell, "gap": gap})

    placed = materialize(
        rows.select("vec_id", "v", F.coalesce(is_query, F.lit(False)).alias("is_query")).mapInPandas(
            assign, "vec_id long, v array<double>, is_query boolean, cell long, gap double"
        ), "cells",
    )
    summary = placed.groupBy("cell").agg(F.max("gap").alias("r"), F.count("*").alias("n")).collect()  # at most a row per pivot
    for r in summary:
        cells.radius[r.cell] = r.r
    cells.set_blocks({r.cell: r.n for r in summary}, s.rows_per_block)
    n_queries = placed.where("is_query").count()
    groups = max(1, -(-n_queries // s.queries_per_group))
    seeds = np.arange(min(groups, len(cells.ids))) * len(cells.ids) // min(groups, len(cells.ids))
    cells.group = Cells(cells.ids[seeds], cells.vectors[seeds]).nearest(cells.vectors)[0]
    sizes = placed.where("is_query").groupBy("cell").count().collect()  # at most a row per pivot
    per_group = np.bincount(cells.group[[r.cell for r in sizes]], weights=[r["count"] for r in sizes], minlength=len(seeds)) if sizes else np.zeros(len(seeds))
    splits = np.maximum(1, np.ceil(per_group / s.queries_per_group)).astype(np.int64)

    def with_group(df: DataFrame) -> DataFrame:
        g = F.get(_longs(cells.group), F.col("cell").cast("int")).cast("int")
        return df.withColumn("g", g).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.get(_longs(splits), g)).cast("int"))

    queries = with_group(placed.where("is_query")).select("g", "part", "vec_id", "v")

    def bounds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            floor, opened = cells.open_cells(as_matrix(pdf["v"]), pdf["vec_id"].to_numpy(np.int64), k)
            yield pdf.assign(floor=floor, opened=[np.flatnonzero(o) for o in opened])

    # queries meet the blocks of the cells that their own bounds leave open
    opened = materialize(queries.mapInPandas(bounds, "g int, part int, vec_id long, v array<double>, floor double, opened array<long>"), "open-cells")
    firsts, counts = _longs(cells.first_block), _longs(cells.blocks)

    def blocks_of(c: Column) -> Column:
        first = F.get(firsts, c.cast("int"))
        return F.sequence(first, first + F.get(counts, c.cast("int")) - 1)

    asked = opened.select("g", "part", "vec_id", "v", "floor", F.explode(F.array_distinct(F.flatten(F.transform("opened", blocks_of)))).alias("block"))
    # rows of a cell are replicated to the groups in which some query left it open
    needed = opened.select(F.col("g").alias("to_g"), F.col("part").alias("to_part"), F.explode("opened").alias("cell")).distinct()
    cell = F.col("cell").cast("int")
    own_block = F.get(firsts, cell) + F.pmod(F.xxhash64("vec_id", "v"), F.get(counts, cell)).cast("int")
    sent = placed.select("vec_id", "v", "cell", own_block.alias("block")).join(needed, "cell")

    def solve(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(x):
            ids, vectors = x["vec_id"].to_numpy(np.int64), as_matrix(x["v"])
            for at in range(0, len(q), 256):
                part = q.iloc[at : at + 256]
                own = part["vec_id"].to_numpy(np.int64)
                scores = inner(as_matrix(part["v"]), vectors)
                for i, best in enumerate(top(scores, ids, own, k)):
                    best = np.array([j for j in best if scores[i, j] >= part["floor"].iat[i]], np.int64)
                    found = [scores[i, j] for j in best]
                    out.append(pd.DataFrame({"query_id": own[i], "vec_id": ids[best], "score": as_long(found), "beyond": list(map(beyond, found))}))
        found = pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "beyond": []}, dtype=np.int64)
        return found.astype({"beyond": object})

    local = asked.groupBy("g", "part", "block").cogroup(sent.groupBy("to_g", "to_part", "block")).applyInPandas(solve, "query_id long, vec_id long, score long, beyond string")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    return local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

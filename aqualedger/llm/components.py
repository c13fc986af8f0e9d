"""Connected components of a long-to-long link table by alternating stars.

Each round links every node's larger neighbours to its smallest neighbour (large star),
then its smaller ones (small star), until the links are stars.  All steps are grouped
minima with partial aggregates and joins on the node, which AQE can split where a node is
hot; nothing is collected."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import materialize


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node it reaches) over the given links, without the roots."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        # hook both ends' roots to the smaller root, then halve the paths
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def _forest_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per task: links shrink to a spanning forest after every batch, so a task holds at
    most one link per node it has met."""
    u, v = np.empty(0, np.int64), np.empty(0, np.int64)
    for pdf in batches:
        u, v = local_forest(np.concatenate([u, pdf["u"].to_numpy()]), np.concatenate([v, pdf["v"].to_numpy()]))
    if len(u):
        yield pd.DataFrame({"u": u, "v": v})


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (u long, v long; no nulls) -> (node, component): the smallest node reachable,
    one row for every node that is not itself the smallest.  Loops and repeats are harmless;
    no links give no rows."""
    links = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    stars = materialize(links.mapInPandas(_forest_batches, "u long, v long").distinct(), "cc")
    while True:
        both = stars.unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # a second key column keeps the join's exchange apart from the aggregate's, so AQE may split it
        large = (
            both.where("v > u").withColumn("k", F.xxhash64("u"))
            .join(low.withColumn("k", F.xxhash64("u")), ["u", "k"])
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.withColumn("k", F.xxhash64("u")).join(low.withColumn("k", F.xxhash64("u")), ["u", "k"])
        small = (
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        new = materialize(small, "cc")
        old_sum, new_sum = (
            d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first() for d in (stars, new)
        )
        stars = new
        if old_sum == new_sum:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))

"""The place of each row in a global order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written_once

ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number in it below


def _in_order(c: str, descending: Collection[str]) -> Column:
    return F.desc_nulls_last(f"`{c}`") if c in descending else F.asc_nulls_last(f"`{c}`")


def _copies(df: DataFrame, copy: str, at_once: int = 65536) -> DataFrame:
    """Equal rows counted before any shuffle and told apart by a number, in two steps so that
    no array grows with their count."""
    counted = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias(copy))
    step = F.lit(at_once).cast("long")
    starts = counted.withColumn("_from", F.explode(F.sequence(F.lit(1).cast("long"), F.col(copy), step)))
    return starts.withColumn(copy, F.explode(F.sequence("_from", F.least(F.col("_from") + step - 1, F.col(copy))))).drop("_from")


def with_position(df: DataFrame, keys: Sequence[str], name: str = "position", descending: Collection[str] = (), unique: bool = False) -> DataFrame:
    """``df`` with each row's place, from 1, in the order of ``keys`` (ascending but for those in
    ``descending``; NULLs last; ties by the other columns, so only equal rows are interchangeable).

    Rows are dealt to sampled ranges of the whole order, sorted in each and written once; a
    range's first place is the number of rows in the ranges before it.  So no task holds more
    than a range, and only one count per range comes to the driver.  Equal rows are counted
    first and told apart by number, so that a range can end among them; ``unique`` says that
    there are none (the rows are groups of an aggregate, say) and saves that shuffle.
    """
    spark = df.sparkSession
    order = [*keys, *[c for c in df.columns if c not in keys]]
    rows = df if unique else _copies(df, "_copy")
    by = [_in_order(c, descending) for c in order] + ([] if unique else [F.asc("_copy")])
    ranges = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    placed = written_once(ranges.select(*[F.col(f"`{c}`") for c in df.columns], "_at"), "positions")
    part, row = F.shiftright("_at", ROW_BITS), F.col("_at").bitwiseAND((1 << ROW_BITS) - 1)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per range
    before, offsets = 0, []
    for part_no, n in sorted(tuple(r) for r in sizes):
        offsets.append((part_no, before))
        before += n
    starts = spark.createDataFrame(offsets, "_part long, _before long")
    numbered = placed.join(F.broadcast(starts), part == F.col("_part"))
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + row + 1).alias(name))

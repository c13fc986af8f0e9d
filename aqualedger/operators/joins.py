"""Joins whose keys may be hot on either side.

AQE splits a skewed partition on the left of a left outer join, but not on its right, and on
neither side where an aggregate above shares the join's partitioning.  ``split_join`` counts
the rows of each key instead and deals a hot key's rows to seats of bounded size, to each of
which the other side's rows of that key go.  Each input stands once in the executed plan: the
counts and the join read one shuffle of the grouped rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEAT_ROWS = 100_000  # distinct right rows of a key that meet one copy of its left rows


def expand(df: DataFrame, copies: str, at_once: int = 65536) -> DataFrame:
    """Every row as often as its column ``copies`` says, without that column; in two steps, so
    that no array grows with a count."""
    one, step = F.lit(1).cast("long"), F.lit(at_once).cast("long")
    starts = df.withColumn("_from", F.explode(F.sequence(one, F.col(copies), step)))
    ends = F.least(F.col("_from") + step - 1, F.col(copies))
    return starts.withColumn("_one", F.explode(F.sequence("_from", ends))).drop("_from", "_one", copies)


def with_copies(df: DataFrame, name: str) -> DataFrame:
    """The distinct rows of ``df`` with their number; equal rows meet before the shuffle."""
    return df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias(name))


def _eq(on: Sequence[tuple[str, str]]) -> Column:
    cond = None
    for left_col, right_col in on:
        term = F.col(left_col) == F.col(right_col)
        cond = term if cond is None else cond & term
    return cond


def _check_names(left: DataFrame, right: DataFrame) -> None:
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if clash:
        raise ValueError(f"left and right share column names: {sorted(clash)}")


def _hot_keys(rows: DataFrame, key: Column, seats: str, other: str, seat_rows: int) -> DataFrame:
    counts = rows.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > seat_rows)
    return counts.select("_key", F.ceil(F.col("_n") / seat_rows).cast("int").alias(seats), F.lit(1).alias(other))


def split_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "left",
    seat_rows: int | None = None,
    copies: str | None = None,
    deal_left: bool = False,
    seat: str | None = None,
) -> DataFrame:
    """``left [LEFT OUTER | INNER] JOIN right ON left.a = right.b AND ...`` (``on`` = [(a, b), ...]).

    Column names of the two sides must be disjoint.  NULL keys match nothing.  Repeated right
    rows are joined as one row and their number; ``copies`` names a column to keep the number of
    a joined row in (1 without a partner), otherwise the rows are repeated at the end.

    A key with n distinct right rows has ceil(n / seat_rows) seats: its right rows are dealt to
    them by hash and its left rows repeated for each.  ``deal_left`` deals the left rows in the
    same way and repeats the right ones; it suits a left input that is the output of an aggregate
    (its distinct rows spread over their seats, and the count reads the aggregate's shuffle).
    Without it AQE splits a hot left key.  Only keys with two seats or more are looked up, so the
    looked-up (and broadcast) table has at most a row of 24 bytes for every ``seat_rows`` rows.

    ``seat`` names a column to keep a joined row's seat in: it follows from the right row, and the
    result lies by the keys and it, so a distinct over all columns and the seat needs no shuffle."""
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    _check_names(left, right)
    seat_rows = seat_rows or SEAT_ROWS
    types = dict(left.dtypes)
    present = None
    for _, b in on:
        present = F.col(b).isNotNull() if present is None else present & F.col(b).isNotNull()
    rows = with_copies(right.where(present), "_copies")

    # keys meet by hash: a filter on the keys themselves would be pushed into one reading of
    # ``rows`` but not into the other, and they would no longer share a shuffle
    own_key = F.xxhash64(*[F.col(a) for a, _ in on])
    key = F.xxhash64(*[F.col(b).cast(types[a]) for a, b in on])
    hot = _hot_keys(rows, key, "_seats", "_own_seats", seat_rows)
    if deal_left:
        hot = hot.unionByName(_hot_keys(left, own_key, "_own_seats", "_seats", seat_rows))
        hot = hot.groupBy("_key").agg(F.max("_seats").alias("_seats"), F.max("_own_seats").alias("_own_seats"))

    def seated(df: DataFrame, key: Column, columns: Sequence[str], seats: str, own_seat: str, others: str, each: str) -> DataFrame:
        """Every row at its own seat ``own_seat`` of ``seats``, once for each seat of the other side."""
        found = df.withColumn("_key", key).join(F.broadcast(hot), "_key", "left")
        own = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.col(seats)).cast("int")
        guest = F.explode(F.sequence(F.lit(0), F.coalesce(others, F.lit(1)) - 1))
        return found.withColumn(own_seat, F.coalesce(own, F.lit(0))).withColumn(each, guest)

    dealt = seated(rows, key, right.columns, "_seats", "_r_seat", "_own_seats", "_r_guest")
    dealt = dealt.select(*[F.col(f"`{c}`") for c in right.columns], "_copies", "_r_seat", "_r_guest")
    guests = seated(left, own_key, left.columns if deal_left else on[0][:1], "_own_seats", "_l_seat", "_seats", "_l_guest")
    met = _eq(on) & (F.col("_l_guest") == F.col("_r_seat"))
    if deal_left:
        met = met & (F.col("_l_seat") == F.col("_r_guest"))
    joined = guests.join(dealt, met, how)
    if how == "left":  # the left rows of a key with several seats have partners, though perhaps not at each
        joined = joined.where(F.col("_copies").isNotNull() | (F.coalesce("_seats", F.lit(1)) == 1))
    at = [F.col("_l_guest").alias(seat)] if seat else []
    joined = joined.select(*[F.col(f"`{c}`") for c in [*left.columns, *right.columns]], *at, F.coalesce("_copies", F.lit(1).cast("long")).alias("_copies"))
    return joined.withColumnRenamed("_copies", copies) if copies else expand(joined, "_copies")


def split_left_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], seat_rows: int | None = None) -> DataFrame:
    """The left outer ``split_join``."""
    return split_join(left, right, on, "left", seat_rows)

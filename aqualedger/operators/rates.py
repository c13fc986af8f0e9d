"""Rate class (kept out of the default output): rate masters with their latest detail,
item code and step rate, classified into utility type and rate schedule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codes import RATE_APPLICATION, rate_schedule, utility_type
from ..functions.text import nvl


def with_group_max(df: DataFrame, partition_cols: Sequence[str], order_col: str, name: str) -> DataFrame:
    """``max(order_col) OVER (PARTITION BY partition_cols)`` as column ``name``.

    Written as a grouped max joined back instead of a window: the max is partially
    aggregated before its shuffle, and the join back (unique right side) lets AQE split
    a hot partition, so no group has to fit in one task.  NULL partition keys form one
    group, as in a window, hence the null-safe join.
    """
    alias = {c: f"_gm_{c}" for c in partition_cols}
    last = df.groupBy(*partition_cols).agg(F.max(order_col).alias(name))
    last = last.select(*[F.col(c).alias(a) for c, a in alias.items()], name)
    cond = None
    for c, a in alias.items():
        term = F.col(c).eqNullSafe(F.col(a))
        cond = term if cond is None else cond & term
    return df.join(last, cond, "left").drop(*alias.values())


def latest_by(df: DataFrame, partition_cols: Sequence[str], order_col: str) -> DataFrame:
    """Rows carrying the latest ``order_col`` of their group; ties are all kept and a NULL
    ``order_col`` never qualifies (NULL partition keys form one group).

    One scan, ranked with ties: of each group only the latest rows of a scan's task go through
    the shuffle (Spark's window group limit), so older rows of a hot group never meet."""
    latest = Window.partitionBy(*partition_cols).orderBy(F.col(order_col).desc())
    ranked = df.where(F.col(order_col).isNotNull()).withColumn("_rank", F.rank().over(latest))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def latest_effective_date(detail: DataFrame) -> DataFrame:
    return with_group_max(
        detail.select("ratemasterid", "ratedetailid", "effectivedate"), ["ratemasterid"], "effectivedate", "last_date"
    )


def latest_detail_ids(detail: DataFrame) -> DataFrame:
    """Detail ids that are the latest of *some* rate master, each once: the set is not scoped to
    a master, so an id latest for one master qualifies for every master using it."""
    dated = detail.select("ratemasterid", "ratedetailid", "effectivedate")
    return latest_by(dated, ["ratemasterid"], "effectivedate").select("ratedetailid").distinct()


def latest_details(detail: DataFrame) -> DataFrame:
    """Details whose id is in the latest-id set (``IN`` subquery as a semi join)."""
    return detail.join(latest_detail_ids(detail), "ratedetailid", "left_semi")


def latest_rate_detail(ratemaster: DataFrame, detail: DataFrame) -> DataFrame:
    r3 = latest_details(detail).select(
        F.col("ratemasterid").alias("r3_master"), "ratedetailid", "effectivedate", "steprateid"
    )
    j = ratemaster.select("ratemasterid", "rate").join(r3, F.col("ratemasterid") == F.col("r3_master"), "left")
    return j.select("ratemasterid", "rate", "ratedetailid", "effectivedate", "steprateid")


def rate_class(
    ratemaster: DataFrame,
    ratekind: DataFrame,
    detail: DataFrame,
    itemratedetail: DataFrame,
    itemcode: DataFrame,
    steprate: DataFrame,
    sorted: bool = False,
) -> DataFrame:
    """Rate masters of application 3 with kind description, latest details, billing
    descriptions, utility type and rate schedule (one row per match of each join)."""
    r1 = ratemaster.where(F.col("application") == RATE_APPLICATION)
    r2 = ratekind.select(F.col("ratekindid").alias("r2_kind"), F.col("description").alias("rkind_desc"))
    r3 = latest_details(detail).select(
        F.col("ratemasterid").alias("r3_master"),
        F.col("ratedetailid").alias("r3_detail"),
        "billingdescription",
        F.col("steprateid").alias("r3_step"),
    )
    r4 = itemratedetail.select(F.col("ratedetailid").alias("r4_detail"), F.col("itemcode").alias("r4_item"), "comments")
    r5 = itemcode.select(
        F.col("itemcode").alias("r5_item"), F.col("application").alias("r5_app"), F.col("description").alias("r5_desc")
    )
    r9 = steprate.select(
        F.col("application").alias("r9_app"), F.col("steprateid").alias("r9_step"), F.col("description").alias("r9_desc")
    )
    j = (
        r1.join(r2, F.col("ratekindid") == F.col("r2_kind"), "left")
        .join(r3, F.col("ratemasterid") == F.col("r3_master"), "left")
        .join(r4, F.col("r3_detail") == F.col("r4_detail"), "left")
        .join(r5, (F.col("r4_item") == F.col("r5_item")) & (F.col("application") == F.col("r5_app")), "left")
        .join(r9, (F.col("application") == F.col("r9_app")) & (F.col("r3_step") == F.col("r9_step")), "left")
    )
    out = j.select(
        "ratekindid",
        "rkind_desc",
        utility_type("ratekindid", "rate").alias("utl_typ"),
        "rate",
        F.col("description").alias("ratedesc"),
        nvl("billingdescription", "comments").alias("bill_desc"),
        nvl("r5_desc", "r9_desc").alias("bill_desc_short"),
        rate_schedule("ratekindid", "rate").alias("rsch"),
    )
    if sorted:
        out = out.orderBy(F.asc_nulls_last("ratekindid"), F.asc_nulls_last("rate"))
    return out

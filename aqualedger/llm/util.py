"""Helpers shared by the operators: shared scratch tables, row identity, exact counts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LAST_ID = 9223372036854775807  # stands for a null id wherever ids are ordered: last of all


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder (``spark.checkpoint.dir``).  Only a local master
    may go without one; it then gets a fresh temporary folder."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="aqualedger-llm-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage and is
    safe when executors are lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """While it lasts, Spark hands Python functions at most ``rows`` rows at a time (fewer, where
    the session says so): bounds what a task holds of whole texts, in the JVM and in Python.  It
    changes no result; what runs must be complete inside, as a plan takes the size when it starts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows if int(before) <= 0 else min(rows, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def whole_text(c: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(c), F.lit(""))


def order_id(c: str = "doc_id") -> Column:
    """An id that orders rows; null ids come last."""
    return F.coalesce(F.col(c).cast("long"), F.lit(LAST_ID))


def each_copy(rows: DataFrame, n: str, copy: str, at_once: int = 65536) -> DataFrame:
    """Every row ``n`` times, numbered from 0 in ``copy``; in two steps, so that no array grows
    with the number of copies."""
    starts = rows.withColumn(copy, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(at_once).cast("long"))))
    return starts.withColumn(copy, F.explode(F.sequence(F.col(copy), F.least(F.col(copy) + at_once, F.col(n)) - 1)))


def fresh(names: list[str], *wanted: str) -> list[str]:
    """Column names that clash with none of ``names`` (compared without case)."""
    taken = {n.lower() for n in names}
    out = []
    for w in wanted:
        while w.lower() in taken:
            w = "_" + w
        taken.add(w.lower())
        out.append(w)
    return out

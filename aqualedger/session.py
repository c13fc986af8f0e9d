"""Session settings for local runs (tests, bench).  On a cluster, pass your own session:
nothing in the library creates one or sets global state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings this library's plans rely on.  AQE re-plans joins from runtime sizes
# (broadcast only what is measured small, coalesce small partitions, split skewed ones;
# forced, it splits a skewed join also where an aggregate above shares its partitioning, at
# the price of one more shuffle there, and only when a partition is measured to be skewed).
# The runtime bloom filter can prune the block scan to the month's headers before its
# shuffle when Spark's size estimates allow it; month-partitioned landing
# (sinks.land_blocks_by_month) turns that into a partition filter in every case.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None, app: str = "aqualedger") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        # PySpark records the Python call site of every DataFrame/Column call for error
        # messages, several JVM round trips each; plans here are built from many calls.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in PLAN_SETTINGS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir`` (a shared folder); only when it is
    unset, as in local tests, fall back to a fresh temporary folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = configured or tempfile.mkdtemp(prefix="aqualedger-ckpt-")
    sc.setCheckpointDir(path)
    return path


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what follows sees one evaluation of
    it, also when executors are lost."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

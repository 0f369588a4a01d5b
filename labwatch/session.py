"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Values every job needs whatever the cluster: UTC dates, adaptive planning,
# and skew splitting for the key-to-key joins. Partition counts are left to
# AQE, which starts wide and coalesces to ``advisoryPartitionSizeInBytes``.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # wide projections compile to methods above the size the JVM optimises by default
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def build_session(app: str = "labwatch", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that survives executor loss: the one that ``spark.checkpoint.dir`` names.

    Where it is unset, as in tests, a folder below the warehouse, which every
    executor of a session reaches as well.
    """
    return (spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints").rstrip("/")


def materialize(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage once for a frame that many results read."""
    spark = df.sparkSession
    spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    return df.checkpoint(eager=eager)

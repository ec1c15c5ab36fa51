"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when that costs one more exchange afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def tune_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings; static cluster settings stay untouched."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if not context.master.startswith("local") and spark.conf.get(INITIAL_PARTITIONS, None) is None:
        # Shuffles start with a few partitions per core and are merged to size at run time,
        # so that large ones fit in memory and small ones stay cheap.
        configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(INITIAL_PARTITIONS, str(max(configured, 4 * context.defaultParallelism)))
    return spark


def build_session(app_name: str = "ratingloom", master: str | None = None, **settings: str) -> SparkSession:
    """Create (or reuse) a session for scripts and tests."""
    # Fits of a parameter search share the cluster fairly.
    builder = SparkSession.builder.appName(app_name).config("spark.scheduler.mode", "FAIR")
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tune_session(builder.getOrCreate())

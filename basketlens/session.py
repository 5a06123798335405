"""Spark session with the settings the plans are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE does three jobs here: it coalesces small shuffle partitions, turns a
# shuffle join into a broadcast once the real size of a side is known, and
# splits skewed join partitions (also where that costs one more shuffle).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app_name: str = "basketlens",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session carrying RECOMMENDED_CONF, then ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_recommended(spark: SparkSession) -> SparkSession:
    """Give a foreign session the adaptive settings it does not set itself."""
    chosen = spark.conf.getAll
    for key, value in RECOMMENDED_CONF.items():
        if ".adaptive." in key and key not in chosen:
            spark.conf.set(key, value)
    return spark

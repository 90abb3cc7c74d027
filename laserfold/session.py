"""Session settings that suit the operators."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Shuffle partitions start high and are coalesced at run time, so the same setting
# serves a laptop and a cluster; skewed sort-merge joins are split at run time.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not compile methods beyond 8000 bytes; split such stages instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Numeric-looking site ids stay text when partition values are read back.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build(app: str, **settings: str) -> SparkSession:
    """Session with the recommended settings; `settings` use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()

"""Session settings the operators expect. On a cluster, pass these to the job; nothing here is machine-local."""

from __future__ import annotations

from pyspark.sql import SparkSession

OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # A benchmark named "123" must stay a string when it is read back from a partition path.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(app_name: str = "passtrail", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**OPTIONS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

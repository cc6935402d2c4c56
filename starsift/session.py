"""Spark session with the settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Skew handling and partition sizing are left to adaptive execution: the initial
# shuffle width only has to be large enough, AQE merges what turns out small.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


# For tests and benches on small tables, which are still worth all cores where rows
# carry long texts. On a cluster these would make very many small tasks.
SMALL_TABLES = {
    "spark.sql.files.openCostInBytes": "262144",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
}


def build_session(
    app_name: str = "starsift",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session; ``master`` and memory normally come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**ADAPTIVE, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

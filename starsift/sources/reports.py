"""Report files: one CSV or JSON file per report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def one_file(report: DataFrame) -> DataFrame:
    """The report in one partition, behind a shuffle of its finished rows.

    ``coalesce(1)`` would pull the work above it into that one task as well.
    """
    return report.repartition(1)


def write_csv_report(report: DataFrame, path: str) -> None:
    """Small table as a single CSV part with a header; nested columns as JSON text."""
    flat = report.select(
        *[
            F.to_json(c).alias(c) if dtype.startswith(("struct", "array", "map")) else F.col(c)
            for c, dtype in report.dtypes
        ]
    )
    one_file(flat).write.mode("overwrite").option("header", True).csv(path)


def write_json_report(report: DataFrame, path: str) -> None:
    """Small table as a single JSON-lines part; null fields are kept."""
    one_file(report).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_csv_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def preview(report: DataFrame, order: list[str], rows: int = 5) -> DataFrame:
    """First rows of a report in a stated order."""
    return report.orderBy(*order).limit(rows)

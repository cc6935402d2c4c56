"""Review tables: JSON lines in, Parquet out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starsift.schemas import REVIEW_SCHEMA, require_columns


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Raw reviews with the fixed schema; a malformed line is a row of nulls, which cleaning drops."""
    return spark.read.schema(REVIEW_SCHEMA).json(path)


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Overwrite a Parquet table; texts fill most of it, so pages are packed tighter than by default."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def browse(reviews: DataFrame, skip: int = 0, n: int = 100, order: str = "review_id") -> DataFrame:
    """Page of reviews in key order; undecodable rows (no key) do not count."""
    return reviews.where(F.col(order).isNotNull()).orderBy(order).offset(skip).limit(n)


def write_pages(reviews: DataFrame, path: str, order: str = "review_id") -> None:
    """Reviews in ranges of the key, and how many rows come before each range; rows without key are left out.

    ``read_page`` then opens only the ranges that a page crosses, however far it is from
    the start. The index has one row a range.
    """
    ranged = reviews.where(F.col(order).isNotNull()).repartitionByRange(order).sortWithinPartitions(order)
    ranged.withColumn("_range", F.spark_partition_id()).write.mode("overwrite").partitionBy("_range").parquet(f"{path}/rows")
    sizes = reviews.sparkSession.read.parquet(f"{path}/rows").groupBy("_range").agg(F.count(F.lit(1)).alias("n_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    index = sizes.withColumn("n_before", F.coalesce(F.sum("n_rows").over(earlier), F.lit(0)))
    index.write.mode("overwrite").parquet(f"{path}/index")


def read_page(spark: SparkSession, path: str, skip: int = 0, n: int = 100, order: str = "review_id") -> DataFrame:
    """The page that ``browse`` gives, from what ``write_pages`` wrote."""
    index = spark.read.parquet(f"{path}/index")
    crossed = index.where((F.col("n_before") < skip + n) & (F.col("n_before") + F.col("n_rows") > skip)).orderBy("_range").collect()
    rows = spark.read.parquet(f"{path}/rows")
    own = rows.where(F.col("_range").isin([r["_range"] for r in crossed])).drop("_range")
    return own.orderBy(order).offset(skip - crossed[0]["n_before"] if crossed else 0).limit(n)


def validate(reviews: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Per column: type, rows and nulls, from one pass."""
    require_columns(reviews, required or REVIEW_SCHEMA.names)
    rows = F.count(F.lit(1))
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in reviews.columns]
    counts = reviews.agg(rows.alias("_rows"), *nulls).unpivot(["_rows"], reviews.columns, "column_name", "n_null")
    types = reduce(
        lambda chain, f: F.when(F.col("column_name") == f.name, f.dataType.simpleString()).otherwise(chain),
        reviews.schema.fields,
        F.lit(None).cast("string"),
    )
    return counts.select("column_name", types.alias("data_type"), F.col("_rows").alias("n_rows"), "n_null")

"""Kafka source and sink for review JSON. The connector comes with the cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift.schemas import REVIEW_SCHEMA

# What a record gets for fields its sender left out.
RECORD_DEFAULTS = {
    "star_rating": 5,
    "helpful_votes": 0,
    "total_votes": 0,
    "review_headline": "form-submitted review",
}
SUBMITTED_CATEGORY = "User Submitted"


def kafka_source(spark: SparkSession, servers: str, topic: str = "reviews", offsets: str = "latest") -> DataFrame:
    """Unbounded review JSON as a string column ``value``."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    raw = reader.option("subscribe", topic).option("startingOffsets", offsets).load()
    return raw.select(F.col("value").cast("string").alias("value"))


def submitted_record(reviews: DataFrame, submitted_at: Column | None = None) -> DataFrame:
    """Complete a submitted review: missing ids, votes, headline, date and time get defaults.

    ``submitted_at`` is a timestamp, the current time if left out.
    """
    at = F.current_timestamp() if submitted_at is None else submitted_at
    lacking = {f.name: F.lit(None).cast(f.dataType) for f in REVIEW_SCHEMA if f.name not in reviews.columns}
    full = reviews.withColumns(lacking) if lacking else reviews
    hexed = F.upper(F.replace(F.uuid(), F.lit("-"), F.lit("")))

    def filled(name: str, default) -> Column:
        return F.coalesce(F.nullif(F.col(name), F.lit(type(default)())), F.lit(default))

    return full.withColumns(
        {
            "review_id": F.coalesce("review_id", F.uuid()),
            "product_id": F.coalesce(F.nullif("product_id", F.lit("")), F.concat(F.lit("BFORM"), F.substring(hexed, 1, 6))),
            "reviewer_id": F.coalesce(F.nullif("reviewer_id", F.lit("")), F.concat(F.lit("R"), F.substring(hexed, 1, 24))),
            **{name: filled(name, default) for name, default in RECORD_DEFAULTS.items()},
            "verified_purchase": F.coalesce("verified_purchase", F.lit(False)),
            "review_date": F.coalesce("review_date", F.date_format(at, "yyyy-MM-dd")),
            "product_category": F.coalesce("product_category", F.lit(SUBMITTED_CATEGORY)),
            "event_ts": F.coalesce("event_ts", F.unix_seconds(at)),
        }
    ).select(*REVIEW_SCHEMA.names)


def to_messages(reviews: DataFrame) -> DataFrame:
    """(key, value): review id and the row as JSON."""
    return reviews.select(
        F.col("review_id").alias("key"), F.to_json(F.struct(*[F.col(c) for c in REVIEW_SCHEMA.names])).alias("value")
    )


def publish(reviews: DataFrame, servers: str, topic: str = "reviews") -> None:
    """Send every review as one message, from the executors."""
    writer = to_messages(reviews).write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("topic", topic).save()

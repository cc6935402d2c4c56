"""Recent scored reviews and the per-product audit row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.operators.ranking import top_fraud_reviewers

RECENT_BATCHES = 5


def recent_scored(scored: DataFrame, limit: int = 50, batches: int = RECENT_BATCHES) -> DataFrame:
    """The last ``limit`` rows, in arrival order, of the last few batches.

    The ids of the newest batches are read first (``batches`` numbers) and become
    a filter, so of a batch-partitioned table only those folders are scanned.
    ``position`` is the place of a row within its batch; without that column the id stands in.
    """
    newest = scored.select("batch_id").distinct().orderBy(F.desc("batch_id")).limit(batches).collect()
    latest = scored.where(F.col("batch_id").isin([row["batch_id"] for row in newest]))
    order = [c for c in ("batch_id", "position", "review_id") if c in scored.columns]
    return latest.orderBy(*map(F.desc, order)).limit(limit)


def product_reviews(scored: DataFrame, limit: int = 20, pool: int = 200) -> DataFrame:
    """Per product, up to ``limit`` of the last ``pool`` scored rows, as an array in arrival order.

    Only ``pool`` rows reach the grouping, which bounds every array.
    """
    order = [c for c in ("batch_id", "position") if c in scored.columns]
    entry = F.struct(
        *order, "review_id", "reviewer_id", "star_rating", "sentiment", "fraud_proba", "fraud_flag", "review_body"
    )
    grouped = recent_scored(scored, pool).groupBy("product_id").agg(F.array_sort(F.collect_list(entry)).alias("reviews"))
    return grouped.withColumn("reviews", F.slice("reviews", 1, limit))


def product_totals(rollup: DataFrame) -> DataFrame:
    """One row per product over all its categories."""
    n = F.sum("review_count")
    return rollup.groupBy("product_id").agg(
        F.array_sort(F.collect_set("product_category")).alias("categories"),
        n.alias("review_count"),
        (F.sum(F.col("avg_rating") * F.col("review_count")) / n).alias("avg_rating"),
        F.sum("fraud_review_count").alias("fraud_review_count"),
        (F.sum("fraud_review_count") / n).alias("fraud_rate"),
    )


def product_audit(products: DataFrame, reviewers: DataFrame, scored: DataFrame, suspects: int = 5) -> DataFrame:
    """Totals, recent scored reviews and the most suspicious reviewers, one row per product."""
    listed = top_fraud_reviewers(reviewers, suspects).select(
        F.struct("fraud_rate", "review_count", "reviewer_id").alias("suspect")
    )
    suspect_list = listed.agg(F.sort_array(F.collect_list("suspect"), asc=False).alias("suspects"))
    return (
        product_totals(products)
        .join(product_reviews(scored), "product_id", "left")
        .withColumn("recent_reviews", F.coalesce(F.size("reviews"), F.lit(0)))
        .withColumn("suspicious_reviewers", suspect_list.scalar())
    )

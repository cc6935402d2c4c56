"""Read side: top lists over rollups and reports.

Every list is ``orderBy`` + ``limit``: each task keeps its own best rows and
only those meet. A key column breaks ties, so a list is the same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.schemas import require_columns

MAX_LISTED = 50
SORTABLE = {"review_count": "review_count", "fraud_rate": "fraud_rate", "product_avg_rating": "avg_rating"}


def top_products(rollup: DataFrame, limit: int = 25, by: str = "review_count") -> DataFrame:
    """Largest values of ``by``; an unknown column is an error."""
    require_columns(rollup, [by])
    return rollup.orderBy(F.desc_nulls_last(by), "product_id", "product_category").limit(limit)


def top_fraud_reviewers(rollup: DataFrame, limit: int = 25) -> DataFrame:
    return rollup.orderBy(F.desc("fraud_rate"), F.desc("review_count"), "reviewer_id").limit(limit)


def listed_products(rollup: DataFrame, limit: int = 10, sort_by: str = "review_count") -> DataFrame:
    """At most 50 products; an unlisted sort column falls back to review_count."""
    top = top_products(rollup, min(limit, MAX_LISTED), SORTABLE.get(sort_by, "review_count"))
    return top.select(
        "product_id",
        "review_count",
        F.col("avg_rating").alias("product_avg_rating"),
        F.col("pct_5star").alias("product_pct_5star"),
        "fraud_rate",
    )


def listed_reviewers(rollup: DataFrame, limit: int = 10) -> DataFrame:
    """At most 50 reviewers with a strict majority flag."""
    top = top_fraud_reviewers(rollup, min(limit, MAX_LISTED))
    return top.select(
        "reviewer_id",
        "fraud_rate",
        "review_count",
        F.col("avg_rating").alias("reviewer_avg_rating"),
        (F.col("fraud_rate") > 0.5).alias("mostly_fraud"),
    )


def display_products(rollup: DataFrame, top_n: int = 1000) -> DataFrame:
    """Head of the product rollup with rounded, percentage-scaled columns."""
    return top_products(rollup, top_n).select(
        "product_id",
        "product_category",
        F.col("review_count").alias("reviews"),
        F.round("avg_rating", 3).alias("avg_rating"),
        F.round(F.col("pct_5star") * 100, 1).alias("pct_5star"),
        F.col("fraud_review_count").alias("fraud_reviews"),
        F.round(F.col("fraud_rate") * 100, 2).alias("fraud_pct"),
    )


def display_reviewers(rollup: DataFrame, top_n: int = 1000) -> DataFrame:
    return top_fraud_reviewers(rollup, top_n).select(
        "reviewer_id",
        F.col("review_count").alias("reviews"),
        F.round("avg_rating", 3).alias("avg_rating"),
        F.round(F.col("fraud_rate") * 100, 2).alias("fraud_pct"),
        F.round(F.col("verified_share") * 100, 1).alias("verified_pct"),
    )


def audit_targets(rollup: DataFrame, pool: int = 50, limit: int = 8, min_rate: float = 0.5) -> DataFrame:
    """Of the most-reviewed products, the first with at least ``min_rate`` fraud."""
    risky = top_products(rollup, pool).where(F.col("fraud_rate") >= min_rate)
    return risky.orderBy(F.desc("review_count"), "product_id", "product_category").limit(limit)


def riskiest_of_busiest(rollup: DataFrame, pool: int = 50, limit: int = 8) -> DataFrame:
    """Of the most-reviewed products, those with the highest fraud rates."""
    return top_products(rollup, pool).orderBy(F.desc("fraud_rate"), "product_id", "product_category").limit(limit)


def top_shifts(mean_drift: DataFrame, limit: int = 5) -> DataFrame:
    """Features by absolute mean shift."""
    return mean_drift.orderBy(F.desc_nulls_last(F.abs("mean_delta")), "feature").limit(limit)


def _metric(name: str):
    value = F.col(name).try_cast("double")
    return F.when(~F.isnan(value), value)


def _named_reports(report: DataFrame) -> DataFrame:
    return report.withColumns(
        {"task": F.lower(F.trim(F.col("task").cast("string"))), "model_name": F.coalesce(F.col("model_name"), F.lit(""))}
    )


def best_models(report: DataFrame) -> DataFrame:
    """Best row per task: macro F1 for sentiment, F1 for fraud; models without a score are skipped."""
    require_columns(report, ["task", "model_name", "f1_macro", "f1"])
    metric = F.when(F.col("task") == "sentiment", _metric("f1_macro")).when(F.col("task") == "fraud", _metric("f1"))
    scored = _named_reports(report).withColumn("score", metric).where(F.col("score").isNotNull())
    # Tied models: the smallest name wins.
    best = scored.groupBy("task").agg(F.max("score").alias("score"))
    return scored.join(best, ["task", "score"]).groupBy("task", "score").agg(F.min("model_name").alias("model_name"))


def model_series(report: DataFrame) -> DataFrame:
    """(task, model, metric, value) by descending value; rows without a name or number fall out."""
    pairs = F.explode(
        F.when(F.col("task") == "sentiment", F.create_map(F.lit("f1_macro"), _metric("f1_macro"))).when(
            F.col("task") == "fraud",
            F.create_map(F.lit("f1"), _metric("f1"), F.lit("roc_auc"), _metric("roc_auc")),
        )
    ).alias("metric", "value")
    series = _named_reports(report).select("task", F.trim("model_name").alias("model_name"), pairs)
    kept = series.where((F.col("model_name") != "") & F.col("value").isNotNull())
    return kept.orderBy("task", "metric", F.desc("value"), "model_name")


def recent_sources(recent: DataFrame) -> DataFrame:
    """Sources among the recent rows as one text; rows without one came from a file."""
    names = F.array_sort(F.collect_set(F.coalesce(F.nullif("source", F.lit("")), F.lit("file"))))
    joined = F.concat_ws(" + ", names)
    return recent.agg(F.when(joined == "", "file").otherwise(joined).alias("sources"))

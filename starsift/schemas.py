"""Schemas and column lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names and order of the review, feature and score tables.
REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("reviewer_id", T.StringType()),
        T.StructField("star_rating", T.IntegerType()),
        T.StructField("helpful_votes", T.IntegerType()),
        T.StructField("total_votes", T.IntegerType()),
        T.StructField("verified_purchase", T.BooleanType()),
        T.StructField("review_headline", T.StringType()),
        T.StructField("review_body", T.StringType()),
        T.StructField("review_date", T.StringType()),
        T.StructField("product_category", T.StringType()),
        T.StructField("event_ts", T.LongType()),
    ]
)

CORPUS_SCHEMA = T.StructType(
    [
        T.StructField("rating", T.DoubleType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("asin", T.StringType()),
        T.StructField("parent_asin", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("helpful_vote", T.IntegerType()),
        T.StructField("verified_purchase", T.BooleanType()),
    ]
)

REVIEWER_FEATURES = [
    "reviewer_review_count",
    "reviewer_avg_rating",
    "reviewer_pct_5star",
    "reviewer_distinct_products",
    "reviewer_reviews_same_day",
    "reviewer_verified_share",
]
PRODUCT_FEATURES = ["product_review_count", "product_avg_rating", "product_pct_5star"]

# Columns of the feature table, and the numeric ones, in their order.
FEATURE_COLUMNS = [
    "review_id",
    "product_id",
    "reviewer_id",
    "star_rating",
    "verified_purchase",
    "helpful_votes",
    "total_votes",
    "review_headline_clean",
    "review_body_clean",
    "body_len",
    "body_word_count",
    "exclam_count",
    *REVIEWER_FEATURES,
    *PRODUCT_FEATURES,
    "dup_in_product",
    "sentiment_label",
    "fraud_label",
    "review_ts",
    "product_category",
]

NUMERIC_FEATURES = [
    "star_rating",
    "helpful_votes",
    "total_votes",
    "verified_purchase_int",
    "body_len",
    "body_word_count",
    "exclam_count",
    *REVIEWER_FEATURES,
    *PRODUCT_FEATURES,
    "dup_in_product",
]

# Columns from which the weak label is computed; a model may not see them.
LABEL_RULE_FEATURES = [
    "reviewer_review_count",
    "reviewer_pct_5star",
    "reviewer_reviews_same_day",
    "reviewer_verified_share",
    "dup_in_product",
]
MODEL_NUMERIC_FEATURES = [c for c in NUMERIC_FEATURES if c not in LABEL_RULE_FEATURES]

SCORED_COLUMNS = [
    "review_id",
    "product_id",
    "reviewer_id",
    "star_rating",
    "review_body",
    "sentiment_label",
    "sentiment",
    "fraud_proba",
    "fraud_flag",
    "scored_at",
    "batch_id",
    "source",
]

TEXT_COLUMN = "review_body_clean"
SENTIMENT_TARGET = "sentiment_label"
FRAUD_TARGET = "fraud_label"


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``df`` itself, or ValueError naming the columns it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df

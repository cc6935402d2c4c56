"""Features and outputs for reviews without history; batch and stream share them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift.functions import risk, text
from starsift.functions.coerce import NARROW_TYPES, flag, number_or
from starsift.functions.labels import sentiment_name
from starsift.schemas import FRAUD_TARGET, NUMERIC_FEATURES, REVIEW_SCHEMA, SENTIMENT_TARGET, TEXT_COLUMN

THRESHOLD = 0.5


def apply_threshold(score: Column, threshold: float = THRESHOLD) -> Column:
    return (score >= threshold).cast("int")


def serving_features(reviews: DataFrame) -> DataFrame:
    """All model columns from the review alone; behaviour gets neutral values.

    Works on static and streaming frames. Columns the input lacks are null.
    """
    known = {f.name: f.dataType for f in REVIEW_SCHEMA}
    lacking = {c: F.lit(None).cast(t) for c, t in known.items() if c not in reviews.columns}
    full = reviews.withColumns(lacking) if lacking else reviews
    body = F.col("review_body")
    stars = F.col("star_rating")
    five = (stars == 5).cast("double")
    verified = F.col("verified_purchase_int")
    return (
        full.withColumns(
            {
                TEXT_COLUMN: text.clean_text(body),
                "exclam_count": text.exclamation_count(body),
                "verified_purchase_int": flag(F.col("verified_purchase")),
                "star_rating": number_or(stars, 3, "int"),
                "helpful_votes": number_or(F.col("helpful_votes"), 0, "int"),
                "total_votes": number_or(F.col("total_votes"), 0, "int"),
            }
        )
        .withColumns(
            {
                "body_len": F.length(TEXT_COLUMN),
                "body_word_count": text.word_count(F.col(TEXT_COLUMN)),
                "reviewer_review_count": F.lit(1),
                "reviewer_avg_rating": stars.cast("double"),
                "reviewer_pct_5star": five,
                "reviewer_distinct_products": F.lit(1),
                "reviewer_reviews_same_day": F.lit(1),
                "reviewer_verified_share": verified.cast("double"),
                "product_review_count": F.lit(1),
                "product_avg_rating": stars.cast("double"),
                "product_pct_5star": five,
                "dup_in_product": F.lit(1),
            }
        )
    )


def model_input(featured: DataFrame, narrow: bool = False) -> DataFrame:
    """Columns a model reads, without nulls: texts as '', numbers and labels as 0."""
    keys = [c for c in ("review_id",) if c in featured.columns]
    numbers = [
        flag(F.col("verified_purchase")).alias(c) if c == "verified_purchase_int" else number_or(F.col(c), 0).alias(c)
        for c in NUMERIC_FEATURES
        if c in featured.columns or c == "verified_purchase_int"
    ]
    targets = [number_or(F.col(c), 0, "int").alias(c) for c in (SENTIMENT_TARGET, FRAUD_TARGET) if c in featured.columns]
    out = featured.select(*keys, F.coalesce(F.col(TEXT_COLUMN), F.lit("")).alias(TEXT_COLUMN), *numbers, *targets)
    return narrow_types(out) if narrow else out


def narrow_types(df: DataFrame) -> DataFrame:
    """Small integer and float types for the known columns."""
    casts = {c: F.col(c).cast(kind) for kind, columns in NARROW_TYPES.items() for c in columns if c in df.columns}
    return df.withColumns(casts)


def prediction_columns(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Add the sentiment name and the flag to ``sentiment_label`` and ``fraud_proba``."""
    return scored.withColumns(
        {
            "sentiment": sentiment_name(F.col("sentiment_label")),
            "fraud_flag": apply_threshold(F.col("fraud_proba"), threshold),
        }
    )


def explain(scored: DataFrame) -> DataFrame:
    """Add ``fraud_explanation`` (summary, level, signals), verdict, band and sentence.

    Reads ``fraud_proba``, ``fraud_flag``, ``sentiment``, the raw body and the
    serving features.
    """
    proba = number_or(F.col("fraud_proba"), 0)
    flagged = F.coalesce(F.col("fraud_flag"), F.lit(0))
    stars = risk.effective_stars(F.col("star_rating"), F.col("star_rating"))
    verified = risk.effective_verified(F.col("verified_purchase_int"), F.col("verified_purchase"))
    exclams = number_or(F.col("exclam_count"), 0, "int")
    promo = risk.promotional(F.col("review_body"))
    weighed = scored.withColumn("risk_weight", risk.risk_weight(proba, flagged, promo, stars, verified, exclams))
    levelled = weighed.withColumn("risk_level", risk.risk_level(proba, flagged, F.col("risk_weight")))
    signals = F.struct(
        F.round(proba, 6).alias("fraud_proba"),
        flagged.alias("fraud_flag"),
        stars.alias("star_rating"),
        verified.alias("verified_purchase_int"),
        number_or(F.col("body_word_count"), 0, "int").alias("body_word_count"),
        exclams.alias("exclam_count"),
        promo.alias("promotional_wording_heuristic"),
    )
    explanation = F.struct(
        risk.risk_summary(F.col("risk_level")).alias("summary"),
        F.lit(False).alias("llm_generated"),
        F.col("risk_level").alias("risk_level"),
        signals.alias("feature_signals"),
    )
    return levelled.withColumns(
        {
            "fraud_explanation": explanation,
            "verdict": risk.verdict(proba, flagged),
            "rate_band": risk.rate_band(proba),
            "sentence": risk.one_line(F.col("sentiment"), proba, flagged),
        }
    )

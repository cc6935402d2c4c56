"""Rule-based explanation of a fraud score."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from starsift.functions.coerce import number_or

# Promotional phrases, score limits and texts of the explanation.
PROMO_PHRASES = [
    "must buy",
    "best ever",
    "changed my life",
    "highly recommend",
    "amazing product",
    "five star",
    "5 star",
    "love this product",
    "exceeded my expectations",
    "buy now",
    "don't miss",
    "life changing",
]
SUMMARIES = {
    "high": "The model flagged this as suspicious — fraud score is elevated with several corroborating signals.",
    "medium": "Borderline case — fraud probability is in a middling range with mixed signals.",
    "low": "Fraud probability is low given the available text, rating, and trust fields.",
}


def promotional(body: Column) -> Column:
    """True where the raw text holds one of the phrases, in any case."""
    lowered = F.lower(F.coalesce(body, F.lit("")))
    return reduce(lambda a, b: a | b, [lowered.contains(p) for p in PROMO_PHRASES])


def _points(condition: Column, n: int) -> Column:
    return F.when(condition, n).otherwise(0)


def risk_weight(proba: Column, flagged: Column, promo: Column, stars: Column, verified: Column, exclams: Column) -> Column:
    """Points for a high score, a flag, promotion, no purchase and shouting."""
    return (
        F.when(proba >= 0.7, 3).when(proba >= 0.45, 1).otherwise(0)
        + _points(flagged == 1, 2)
        + _points(promo & (stars >= 5), 2)
        + _points(verified == 0, 1)
        + _points(exclams >= 3, 1)
    )


def risk_level(proba: Column, flagged: Column, weight: Column) -> Column:
    return (
        F.when((proba < 0.32) & (flagged != 1) & (weight <= 2), "low")
        .when((proba >= 0.72) | ((flagged == 1) & (proba >= 0.55)) | (weight >= 5), "high")
        .otherwise("medium")
    )


def risk_summary(level: Column) -> Column:
    return F.when(level == "high", SUMMARIES["high"]).when(level == "low", SUMMARIES["low"]).otherwise(SUMMARIES["medium"])


def effective_stars(given: Column, feature: Column) -> Column:
    """The given rating, else the feature, else 3; 0 counts as missing."""
    known = [F.nullif(number_or(c, 0, "int"), F.lit(0)) for c in (given, feature)]
    return F.coalesce(*known, F.lit(3))


def effective_verified(feature: Column, given: Column) -> Column:
    """The 0/1 feature, else the given boolean."""
    return F.coalesce(feature.try_cast("int"), F.when(F.coalesce(given, F.lit(False)), 1).otherwise(0))


def verdict(proba: Column, flagged: Column) -> Column:
    return F.when(flagged == 1, "flagged").when(proba >= 0.3, "borderline").otherwise("clean")


def rate_band(rate: Column) -> Column:
    return F.when(rate >= 0.7, "red").when(rate >= 0.3, "amber").otherwise("green")


def one_line(sentiment: Column, proba: Column, flagged: Column) -> Column:
    """Sentence with sentiment, percentage and outcome."""
    ending = F.when(flagged == 1, "FLAGGED as suspicious.").otherwise("looks clean.")
    # Unlike format_string, this rounds the double itself and not its shortest decimal form.
    percent = F.concat(F.format_number(proba * 100, 1), F.lit("%"))
    return F.concat(F.lit("Review is "), sentiment, F.lit(". Fraud probability is "), percent, F.lit(" — "), ending)

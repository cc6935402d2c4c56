"""Weak fraud label: a rule over behaviour, then seeded label noise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift.functions.chance import uniform
from starsift.schemas import FEATURE_COLUMNS

# Limits of the rule and rates of the noise.
COPIES = 3
SAME_DAY = 5
MIN_REVIEWS = 8
FIVE_STAR_SHARE = 0.95
VERIFIED_SHARE = 0.2
FLIP_TO_CLEAN = 0.034
FLIP_TO_FRAUD = 0.0015


def rule_fraud() -> Column:
    """1 for copies in a product, an unverified five-star serial reviewer or a burst in a day.

    An unknown verified share leaves its branch undecided, which counts as no.
    """
    monoculture = (
        (F.col("reviewer_review_count") >= MIN_REVIEWS)
        & (F.col("reviewer_pct_5star") >= FIVE_STAR_SHARE)
        & (F.col("reviewer_verified_share") <= VERIFIED_SHARE)
    )
    hit = (F.col("dup_in_product") >= COPIES) | (F.col("reviewer_reviews_same_day") >= SAME_DAY) | monoculture
    return F.coalesce(hit, F.lit(False)).cast("int")


def label_fraud(featured: DataFrame, seed: int = 42, key: str = "review_id") -> DataFrame:
    """Add ``rule_fraud`` and the noisy ``fraud_label``."""
    u = uniform(F.col(key), f"label-noise-{seed}")
    rule = F.col("rule_fraud")
    flipped = F.when(rule == 1, u < FLIP_TO_CLEAN).otherwise(u < FLIP_TO_FRAUD)
    return featured.withColumn("rule_fraud", rule_fraud()).withColumn(
        "fraud_label", F.when(flipped, 1 - rule).otherwise(rule)
    )


def feature_table(labelled: DataFrame) -> DataFrame:
    """The 26 published columns."""
    return labelled.select(*FEATURE_COLUMNS)

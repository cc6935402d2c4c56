"""Sentiment ids and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starsift.functions.coerce import number

# Sentiment id -> name.
SENTIMENT_NAMES = {0: "negative", 1: "neutral", 2: "positive"}


def sentiment_label(rating: Column) -> Column:
    """0 up to two stars, 1 at three, 2 above; an unknown rating is neutral."""
    whole = number(rating, "int")
    return F.when(whole.isNull() | (whole == 3), 1).when(whole < 3, 0).otherwise(2)


def sentiment_name(label: Column) -> Column:
    named = F.lit(None).cast("string")
    for key, name in SENTIMENT_NAMES.items():
        named = F.when(label == key, name).otherwise(named)
    return named

"""Train/test and calibration splits, and an exact seeded sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starsift.functions.chance import digest, leading_bits, uniform


def _fraction(value: float, name: str) -> float:
    if not 0 < value < 1:
        raise ValueError(f"{name} must be between 0 and 1 (exclusive)")
    return value


def with_split(df: DataFrame, test_fraction: float = 0.2, seed: int = 42, key: str = "review_id") -> DataFrame:
    """Add ``split`` = train or test, decided by the row key alone."""
    u = uniform(F.col(key), f"split-{seed}")
    return df.withColumn("split", F.when(u < _fraction(test_fraction, "test_fraction"), "test").otherwise("train"))


def train_test(df: DataFrame, test_fraction: float = 0.2, seed: int = 42, key: str = "review_id") -> tuple[DataFrame, DataFrame]:
    tagged = with_split(df, test_fraction, seed, key)
    return tuple(tagged.where(F.col("split") == part).drop("split") for part in ("train", "test"))


def random_train_test(df: DataFrame, test_fraction: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's own seeded split; its result depends on the partition layout."""
    train, test = df.randomSplit([1 - _fraction(test_fraction, "test_fraction"), test_fraction], seed=seed)
    return train, test


def with_calibration_part(holdout: DataFrame, fraction: float = 0.5, seed: int = 42, key: str = "review_id") -> DataFrame:
    """Add ``part`` = calib or eval, independent of the train/test draw."""
    u = uniform(F.col(key), f"calibration-{seed}")
    return holdout.withColumn("part", F.when(u < _fraction(fraction, "fraction"), "calib").otherwise("eval"))


def seeded_sample(df: DataFrame, n: int, seed: int = 42, key: str = "review_id") -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, the same for a seed.

    The sample is the n rows with the smallest digests. A histogram over 65,536
    digest prefixes (bounded, however large the table) tells which prefixes are
    in whole; only the rows of the one prefix that is cut need ordering.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    salt = f"sample-{seed}"
    tagged = df.withColumn("_bucket", leading_bits(F.col(key), salt, 4))
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    histogram = tagged.groupBy("_bucket").count()
    cut = (
        histogram.withColumn("upto", F.sum("count").over(running))
        .where(F.col("upto") >= n)
        .orderBy("_bucket")
        .select("_bucket", (n - F.col("upto") + F.col("count")).alias("wanted"))
        .first()
    )
    if cut is None:
        return df
    whole = tagged.where(F.col("_bucket") < cut["_bucket"]).drop("_bucket")
    partly = tagged.where(F.col("_bucket") == cut["_bucket"]).drop("_bucket")
    return whole.unionByName(partly.orderBy(digest(F.col(key), salt), key).limit(cut["wanted"]))

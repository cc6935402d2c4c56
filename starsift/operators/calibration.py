"""Reliability bins, ECE, Brier score, calibrated scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.operators.isotonic import isotonic_blocks
from starsift.operators.metrics import fraud_evaluation
from starsift.staging import stage

BINS = 10


def reliability_bins(scores: DataFrame, n_bins: int = BINS, by: Sequence[str] = ()) -> DataFrame:
    """Equal bins over [0, 1], left-closed, the last closed on both sides; empty bins stay, with nulls.

    Scores are compared with the bin edges themselves, i * step as doubles:
    floor(score * n) would put a score on edge 3 (0.30000000000000004) elsewhere.
    """
    by = list(by)
    step = 1.0 / n_bins
    edges = [i * step for i in range(n_bins)] + [1.0]
    bin_of = F.lit(0)
    for i in range(1, n_bins):
        bin_of = F.when(F.col("score") >= edges[i], i).otherwise(bin_of)
    counted = (
        scores.where(F.col("score").between(0.0, 1.0))
        .groupBy(*by, bin_of.alias("bin_idx"))
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg("score").alias("mean_pred"),
            F.avg(F.col("label").cast("double")).alias("empirical_pos_rate"),
        )
    )
    stats = F.struct("count", "mean_pred", "empirical_pos_rate")
    packed = counted.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("bin_idx", stats))).alias("bins"))
    grid = F.array(
        *[
            F.struct(F.lit(i).alias("bin_idx"), F.lit(edges[i]).alias("bin_lo"), F.lit(edges[i + 1]).alias("bin_hi"))
            for i in range(n_bins)
        ]
    )
    every = packed.select(*by, "bins", F.inline(grid)).withColumn("hit", F.try_element_at("bins", F.col("bin_idx")))
    return every.select(
        *by,
        "bin_idx",
        "bin_lo",
        "bin_hi",
        F.coalesce("hit.count", F.lit(0)).alias("count"),
        F.col("hit.mean_pred").alias("mean_pred"),
        F.col("hit.empirical_pos_rate").alias("empirical_pos_rate"),
        F.abs(F.col("hit.mean_pred") - F.col("hit.empirical_pos_rate")).alias("abs_gap"),
    )


def expected_calibration_error(bins: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count-weighted mean gap of the non-empty bins; null without rows."""
    total = F.nullif(F.sum("count").cast("double"), F.lit(0.0))
    return bins.groupBy(*by).agg((F.sum(F.col("count") * F.col("abs_gap")) / total).alias("ece"))


def brier_score(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    miss = F.col("score") - F.col("label")
    return scores.groupBy(*by).agg(F.avg(miss * miss).alias("brier"), F.count(F.lit(1)).alias("n_eval"))


def calibration_report(scores: DataFrame, n_calib: int | None = None) -> DataFrame:
    """Per ``method``: metrics at .5, AUC, Brier, ECE and the row counts."""
    by = ["method"]
    ece = expected_calibration_error(reliability_bins(scores, by=by), by)
    report = fraud_evaluation(scores, by).join(brier_score(scores, by), by).join(ece, by)
    return report.select(
        "method",
        "precision",
        "recall",
        "f1",
        "roc_auc",
        "brier",
        "ece",
        "n_eval",
        F.lit(n_calib).cast("bigint").alias("n_calib"),
    )


def best_calibration(report: DataFrame) -> DataFrame:
    """Method with the smallest Brier score, then the smallest ECE; nulls last."""
    return report.orderBy(F.asc_nulls_last("brier"), F.asc_nulls_last("ece"), "method").limit(1)


def platt_model(calib: DataFrame, n_calib: int):
    """Logistic regression on the calibration scores (C = 1)."""
    point = array_to_vector(F.array("score")).alias("features")
    return LogisticRegression(maxIter=100, regParam=1.0 / max(n_calib, 1), standardization=False).fit(
        calib.select(point, F.col("label").cast("double"))
    )


def platt_scores(calib: DataFrame, holdout: DataFrame, n_calib: int) -> DataFrame:
    """Holdout scores through the logistic regression on the calibration scores."""
    fitted = platt_model(calib, n_calib)
    scored = fitted.transform(holdout.withColumn("features", array_to_vector(F.array("score"))))
    kept = [c for c in holdout.columns if c != "score"]
    return scored.select(*kept, F.get(vector_to_array("probability"), 1).alias("score"))


def isotonic_scores(calib: DataFrame, holdout: DataFrame) -> DataFrame:
    """Holdout scores through isotonic regression; outside the fitted range the end values hold.

    The curve is fitted in parts; what Spark's model receives to interpolate from are
    the two ends of each level, which are monotone already.
    """
    level = F.col("total") / F.col("weight")
    ends = isotonic_blocks(calib).select(F.explode(F.array_distinct(F.array("lo", "hi"))).alias("score"), level.alias("label"))
    fitted = IsotonicRegression(featuresCol="score", labelCol="label").fit(stage(ends, "isotonic-curve"))
    kept = [c for c in holdout.columns if c != "score"]
    return fitted.transform(holdout).select(*kept, F.col("prediction").alias("score"))


def calibrated_variants(scores: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(evaluation scores per method, calibration part, its size) from scores with a ``part`` column."""
    calib = scores.where(F.col("part") == "calib").drop("part")
    held = scores.where(F.col("part") == "eval").drop("part")
    n_calib = calib.count()
    methods = {
        "raw": held,
        "sigmoid_platt": platt_scores(calib, held, n_calib),
        "isotonic": isotonic_scores(calib, held),
    }
    return tag_and_union(methods, "method"), calib, n_calib


def tag_and_union(parts: dict[str, DataFrame], tag: str) -> DataFrame:
    """One frame of all parts, each marked with its name."""
    named = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    out = named[0]
    for part in named[1:]:
        out = out.unionByName(part)
    return out

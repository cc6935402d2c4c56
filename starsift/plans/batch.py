"""Batch runs: raw review files -> feature table, rollups, reports.

python -m starsift.plans.batch --input <json lines> --out <folder>
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift.operators import calibration, drift, rollups, thresholds
from starsift.operators.behaviour import behaviour_features, with_group_keys
from starsift.operators.cleaning import clean_reviews
from starsift.operators.splits import with_calibration_part, with_split
from starsift.operators.weak_label import feature_table, label_fraud
from starsift.schemas import FEATURE_COLUMNS
from starsift.session import build_session
from starsift.sources.reports import write_csv_report, write_json_report
from starsift.sources.reviews import read_reviews, write_table
from starsift.staging import release_stages, stage


def build_tables(raw: DataFrame, out: str, test_fraction: float = 0.2, seed: int = 42) -> dict[str, str]:
    """Write the feature table (one folder per split) and both rollups; return their paths.

    The features are computed and written once. The rollups read back the few
    columns they need, so nothing is cached.
    """
    spark = raw.sparkSession
    paths = {name: f"{out.rstrip('/')}/{name}" for name in ("reviews", "product_agg", "reviewer_agg")}
    kept = [c for c in FEATURE_COLUMNS if c in raw.columns]
    keyed = with_group_keys(clean_reviews(raw))
    derived = [c for c in keyed.columns if c not in raw.columns]
    base = stage(keyed.select(*kept, *derived), "clean")
    featured = feature_table(label_fraud(behaviour_features(base), seed))
    write_table(with_split(featured, test_fraction, seed), paths["reviews"], "split")
    labelled = spark.read.parquet(paths["reviews"])
    write_table(rollups.product_rollup(labelled), paths["product_agg"])
    write_table(rollups.reviewer_rollup(labelled), paths["reviewer_agg"])
    paths["train"], paths["test"] = (f"{paths['reviews']}/split={part}" for part in ("train", "test"))
    return paths


def write_threshold_report(scores: DataFrame, out: str, grid: str | None = None, min_precision: float = 0.95) -> None:
    """Sweep as CSV, chosen thresholds as JSON."""
    sweep = stage(thresholds.threshold_sweep(scores, thresholds.parse_grid(grid)), "sweep")
    write_csv_report(sweep.orderBy("grid_pos").select("threshold", "precision", "recall", "f1"), f"{out}/threshold_study")
    write_json_report(thresholds.threshold_choice(sweep, min_precision), f"{out}/thresholds")


def write_calibration_report(scores: DataFrame, out: str, fraction: float = 0.5, seed: int = 42) -> None:
    """Report, bins and best method for raw, sigmoid and isotonic scores."""
    variants, _, n_calib = calibration.calibrated_variants(stage(with_calibration_part(scores, fraction, seed), "parts"))
    variants = stage(variants, "calibrated")
    report = stage(calibration.calibration_report(variants, n_calib), "report")
    write_csv_report(report.orderBy("method"), f"{out}/fraud_calibration_report")
    bins = calibration.reliability_bins(variants, by=["method"])
    write_csv_report(bins.orderBy("method", "bin_idx"), f"{out}/fraud_calibration_bins")
    write_json_report(calibration.best_calibration(report), f"{out}/fraud_calibration_summary")


def write_drift_report(reference: DataFrame, current: DataFrame, out: str) -> None:
    write_json_report(drift.drift_summary(reference, current), f"{out}/drift_report")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--test-fraction", type=float, default=0.2)
    parser.add_argument("--seed", type=int, default=42)
    args = parser.parse_args(argv)
    spark: SparkSession = build_session("starsift-batch")
    paths = build_tables(read_reviews(spark, args.input), args.out, args.test_fraction, args.seed)
    reviews = spark.read.parquet(paths["reviews"])
    rollups.label_summary(reviews).show()
    parts = {part: reviews.where(F.col("split") == part) for part in ("train", "test")}
    write_drift_report(parts["train"], parts["test"], f"{args.out.rstrip('/')}/reports")
    release_stages(spark)


if __name__ == "__main__":
    main()

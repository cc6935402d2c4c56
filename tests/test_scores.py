"""Metrics, thresholds, calibration, drift and text weights against brute force or known values."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from starsift.operators import calibration, drift, metrics, ordering, preparation, text_features, thresholds

SCORES = "label int, score double"


def scores(spark, rows):
    return spark.createDataFrame(rows, SCORES)


def test_auc_matches_brute_force_and_spark(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 1), round(rng.random(), 2)) for _ in range(700)]
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = scores(spark, rows)
    assert metrics.roc_auc(df.repartition(7)).first()[0] == pytest.approx(want)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert evaluator.evaluate(df.withColumn("label", F.col("label").cast("double"))) == pytest.approx(want)


def test_auc_of_one_class_is_null(spark):
    assert metrics.roc_auc(scores(spark, [(1, 0.2), (1, 0.4)])).first()[0] is None


def test_running_before(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("v"), (F.col("id") % 2).alias("g"))
    for r in ordering.running_before(df.repartition(5), "k", "v", ["g"]).collect():
        assert r["before"] == sum(i % 3 for i in range(r["k"]) if i % 2 == r["g"])


def test_confusion_and_report(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (2, 2), (2, 2)], "label int, pred int")
    cells = {(r["label"], r["pred"]): r["n"] for r in metrics.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 1, (0, 2): 1, (2, 0): 0, (2, 2): 2}
    rows = {r["row"]: r for r in metrics.class_report(df).collect()}
    assert rows["0"]["precision"] == 1.0 and rows["0"]["recall"] == 0.5
    assert rows["accuracy"]["f1"] == 0.75 and rows["macro avg"]["support"] == 4
    one = metrics.multiclass_summary(df).first()
    assert one["f1_macro"] == pytest.approx((2 / 3 + 0.8) / 2)


def test_binary_zero_division(spark):
    r = metrics.binary_metrics(spark.createDataFrame([(0, 0)], "label int, pred int")).first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)


def test_sweep_and_choice(spark):
    df = scores(spark, [(1, 0.9), (0, 0.8), (1, 0.5), (0, 0.1)])
    sweep = thresholds.threshold_sweep(df, [0.5, 0.85, 0.2, 0.95])
    rows = sorted(sweep.collect(), key=lambda r: r["grid_pos"])
    assert [r["threshold"] for r in rows] == [0.5, 0.85, 0.2, 0.95]
    assert [round(r["f1"], 4) for r in rows] == [0.8, 0.6667, 0.8, 0.0]
    assert [r["errors"] for r in rows] == [1, 1, 1, 2]
    choice = thresholds.threshold_choice(sweep, 0.95).first()
    assert choice["best_f1_threshold"] == 0.5 and choice["precision_target_threshold"] == 0.85
    assert thresholds.threshold_choice(sweep, 1.1).first()["precision_target_threshold"] is None
    with pytest.raises(Exception, match="cannot be empty"):
        thresholds.best_f1(sweep.limit(0)).collect()
    with pytest.raises(ValueError):
        thresholds.threshold_sweep(df, [])


def test_grids():
    assert thresholds.parse_grid("0.3, 0.5,") == [0.3, 0.5]
    assert thresholds.parse_grid(None) == thresholds.DEFAULT_GRID
    assert len(thresholds.ABLATION_GRID) == 19 and thresholds.ABLATION_GRID[2] == 0.15


def test_sweep_range(spark):
    def ranged(*values):
        df = spark.createDataFrame([(v, v, v) for v in values], "precision double, recall double, f1 double")
        return thresholds.sweep_range(df).first()

    assert ranged(0.5, 0.5)["flat"] and ranged(0.5, 0.5)["y_min"] == pytest.approx(0.455)
    assert ranged(0.5, 0.6)["zoomed"] and not ranged(0.5, 0.6)["flat"]
    assert tuple(ranged(0.1, 0.9)) == (0.0, 1.0, False, False)


def test_ablation_summary(spark):
    schema = "setting string, roc_auc double, best_f1 double, errors bigint, n_test bigint"

    def summary(full, reduced):
        rows = [(thresholds.FULL, *full), (thresholds.REDUCED, *reduced)]
        return thresholds.ablation_summary(spark.createDataFrame(rows, schema)).first()

    assert summary((0.9, 0.8, 50, 200), (0.8, 0.7, 60, 200))["suspicious"]
    assert summary((0.8, 0.7, 10, 200), (0.8, 0.7, 60, 200))["suspicious"]
    mild = summary((0.8, 0.7, 50, 200), (0.8, 0.7, 60, 200))
    assert not mild["suspicious"] and mild["higher_best_f1"] == thresholds.FULL
    assert summary((None, 0.6, 50, 200), (0.8, 0.7, 60, 200))["higher_best_f1"] == thresholds.REDUCED


def test_bins_on_edges(spark):
    df = scores(spark, [(1, 0.0), (0, 0.1), (1, 0.3), (1, 0.1 * 3), (0, 1.0), (1, 0.95)])
    counts = {r["bin_idx"]: r["count"] for r in calibration.reliability_bins(df).collect()}
    # 0.3 lies below edge 3, which is the double 0.30000000000000004.
    assert counts == {0: 1, 1: 1, 2: 1, 3: 1, 4: 0, 5: 0, 6: 0, 7: 0, 8: 0, 9: 2}


def test_ece_of_known_bins(spark):
    bins = spark.createDataFrame([(3, 0.1), (1, 0.5), (0, None)], "count bigint, abs_gap double")
    assert calibration.expected_calibration_error(bins).first()[0] == pytest.approx(0.2)
    assert calibration.expected_calibration_error(bins.limit(0)).first()[0] is None


def test_best_calibration_known_report(spark):
    # Published values: raw, sigmoid, isotonic.
    rows = [("raw", 0.14263, 0.30182), ("sigmoid_platt", 0.02958, 0.00195), ("isotonic", 0.02947, 0.000146), ("none", None, None)]
    report = spark.createDataFrame(rows, "method string, brier double, ece double")
    assert calibration.best_calibration(report).first()["method"] == "isotonic"


def test_calibrated_scores(spark):
    rng = random.Random(1)
    rows = []
    for i in range(4000):
        s = rng.random()
        rows.append((str(i), int(rng.random() < s * s), s, "calib" if i % 2 else "eval"))
    df = spark.createDataFrame(rows, "review_id string, label int, score double, part string")
    variants, _, n = calibration.calibrated_variants(df)
    report = {r["method"]: r for r in calibration.calibration_report(variants, n).collect()}
    assert set(report) == {"raw", "sigmoid_platt", "isotonic"} and report["raw"]["n_calib"] == 2000
    assert report["isotonic"]["brier"] < report["raw"]["brier"]
    assert report["sigmoid_platt"]["ece"] < report["raw"]["ece"]


def test_isotonic_curve_takes_scores_as_they_are(spark):
    from starsift.plans.model_queries import isotonic_points

    rng = np.random.default_rng(8)
    rows = [(0.5 + int(i) * 1e-6, int(rng.random() < i / 300)) for i in rng.integers(0, 300, 500)]
    got = {r["score"]: r["calibrated"] for r in isotonic_points(spark.createDataFrame(rows, "score double, label int")).collect()}
    scores = sorted({s for s, _ in rows})
    w = [sum(s == p for s, _ in rows) for p in scores]
    wy = [sum(y for s, y in rows if s == p) for p in scores]
    cw, cy = np.concatenate([[0], np.cumsum(w)]), np.concatenate([[0], np.cumsum(wy)])
    want = [max(min((cy[e] - cy[b]) / (cw[e] - cw[b]) for e in range(i + 1, len(scores) + 1)) for b in range(i + 1)) for i in range(len(scores))]
    assert len(got) == len(scores) > 101
    assert np.allclose([got[p] for p in scores], want, atol=1e-6)


def test_isotonic_interpolates_and_clips(spark):
    calib = scores(spark, [(0, 0.2), (1, 0.6)])
    held = scores(spark, [(0, 0.0), (0, 0.4), (0, 0.9)])
    got = sorted(r["score"] for r in calibration.isotonic_scores(calib, held).collect())
    assert got == pytest.approx([0.0, 0.5, 1.0])


def test_drift(spark):
    a = spark.createDataFrame([(1.0, "ab"), (None, None)], "body_len double, review_body_clean string")
    b = spark.createDataFrame([(3.0, "abcd")], "body_len double, review_body_clean string")
    means = drift.mean_drift(a, b).collect()
    assert [(r["feature"], r["reference_mean"], r["mean_delta"]) for r in means] == [("body_len", 0.5, 2.5)]
    assert drift.length_drift(a, b).first()["avg_length_delta"] == 3.0
    assert drift.drift_summary(a, b).first()["row_count_reference"] == 2


def test_psi(spark):
    a = spark.range(100).select(F.col("id").cast("double").alias("x"))
    edges = drift.decile_edges(a, "x")
    assert len(edges) == 9
    assert drift.population_stability(a, a, "x", edges).first()["psi"] == 0
    shifted = a.select((F.col("x") + 50).alias("x"))
    assert drift.population_stability(a, shifted, "x", [50.0]).first()["psi"] == pytest.approx(
        (1e-4 - 0.5) * math.log(1e-4 / 0.5) + 0.5 * math.log(2)
    )
    none = a.where("x < 0")
    assert drift.population_stability(a, none, "x", [50.0]).first()["psi"] > 0
    assert drift.population_stability(none, none, "x", [50.0]).first()["psi"] == 0
    assert drift.population_stability(a, a, "x", [3.0, 1000.0]).first()["n_bins"] == 3


def test_tfidf_by_hand(spark):
    docs = spark.createDataFrame([("1", "aa bb aa x"), ("2", "bb cc"), ("3", "bb")], "review_id string, review_body_clean string")
    vocab = text_features.vocabulary(docs, 1, 0.9, None)
    assert {r["gram"]: r["df"] for r in vocab.collect()} == {"aa": 1, "aa bb": 1, "bb aa": 1, "bb cc": 1, "cc": 1}
    idf = math.log(4 / 2) + 1
    got = {r["gram"]: r["weight"] for r in text_features.tfidf(docs, vocab).where("review_id = '1'").collect()}
    raw = {"aa": (1 + math.log(2)) * idf, "aa bb": idf, "bb aa": idf}
    norm = math.sqrt(sum(w * w for w in raw.values()))
    assert got == pytest.approx({g: w / norm for g, w in raw.items()})


def test_weights_majority_scaling(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0), (0, 3.0, 2.0), (1, 5.0, 2.0)], "label int, a double, b double")
    assert {r["label"]: r["weight"] for r in preparation.class_weights(df, "label").collect()} == {0: 0.75, 1: 1.5}
    assert preparation.majority_class(df, "label").first()["label"] == 0
    scaled = preparation.scale_by_deviation(df, ["a", "b"]).orderBy("a").first()
    assert scaled["a"] == pytest.approx(1.0 / math.sqrt(8 / 3)) and scaled["b"] == 2.0

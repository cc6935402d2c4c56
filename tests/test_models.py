"""Trees, isotonic curves and vectors against plain computations."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starsift.operators import certificates, isotonic, trees
from starsift.sources import reviews


def table_of(spark, n=300, seed=1):
    """Rows with sparse values: feature 0 and 3 decide the label, feature 7 is negative at times."""
    rng = random.Random(seed)
    rows, entries = [], []
    for i in range(n):
        x = {f: round(rng.uniform(0.1, 1), 3) for f in range(8) if rng.random() < 0.5}
        if 7 in x and rng.random() < 0.5:
            x[7] = -x[7]
        label = int(x.get(0, 0) > 0.55 or (x.get(3, 0) > 0.5 and x.get(7, 0) >= 0))
        rows.append((str(i), label))
        entries += [(str(i), f, v) for f, v in x.items()]
    return spark.createDataFrame(rows, "review_id string, label int"), spark.createDataFrame(entries, "review_id string, idx int, value double")


@pytest.fixture(scope="module")
def coded(spark):
    rows, entries = table_of(spark)
    edges = trees.bin_edges(entries)
    codes = trees.coded(entries, edges)
    return rows, codes, trees.blocks_of(rows, codes), trees.zero_bins_of(edges)


def dense(rows, codes, zero_bins):
    """(labels, bins as a matrix)."""
    held = {r["review_id"]: r["codes"] for r in codes.collect()}
    labels, matrix = [], []
    for r in rows.collect():
        bins = [zero_bins.get(f, 0) for f in range(8)]
        for c in held.get(r["review_id"], []):
            bins[c // trees.BINS] = c % trees.BINS
        labels.append(r["label"])
        matrix.append(bins)
    return np.array(labels), np.array(matrix)


def test_first_boosted_split_is_the_best_of_all(coded):
    rows, codes, blocks, zero = coded
    y, x = dense(rows, codes, zero)
    models = trees.fit_boosted(blocks, 8, [[], [0]], zero, rounds=2, depth=2)
    residual = y - y.mean()
    for model, skip in zip(models, (set(), {0}), strict=True):
        best = max(
            (len(a) * len(b) / len(y) * (a.mean() - b.mean()) ** 2, -f, -k)
            for f in set(range(8)) - skip for k in range(trees.BINS - 1)
            if len(a := residual[x[:, f] <= k]) and len(b := residual[x[:, f] > k])
        )
        feature, bin_ = model.trees[0][0][1]
        left = residual[x[:, feature] <= bin_]
        right = residual[x[:, feature] > bin_]
        assert len(left) * len(right) / len(y) * (left.mean() - right.mean()) ** 2 == pytest.approx(best[0], rel=1e-5)
        assert feature not in skip and len(model.trees) == 2


def test_boosting_learns_and_scores(coded):
    rows, codes, blocks, zero = coded
    models = trees.fit_boosted(blocks, 8, [[]], zero, rounds=25, depth=3, step=0.3)
    scored = trees.scored_rows(rows, codes, trees.boosted_scores(models, zero), ["score"]).collect()
    assert len(scored) == 300 and sum((r["score"] >= 0.5) == r["label"] for r in scored) >= 290


def test_forest_grows_until_nodes_are_pure(coded):
    rows, codes, blocks, zero = coded
    forest = trees.fit_forest(blocks, 8, zero, trees=15)
    assert (forest.feature >= 0).any() and set(np.unique(forest.value[forest.feature < 0])) <= {0.0, 1.0}
    scored = trees.scored_rows(rows, codes, trees.forest_scores(forest, zero), ["score"]).collect()
    assert sum((r["score"] >= 0.5) == r["label"] for r in scored) >= 285


def test_trees_of_one_class_and_of_no_rows(spark, coded):
    _, codes, _, zero = coded
    one = spark.createDataFrame([("1", 1), ("2", 1)], "review_id string, label int")
    models = trees.fit_boosted(trees.blocks_of(one, codes), 8, [[]], zero, rounds=2)
    assert all(r["score"] > 0.99 for r in trees.scored_rows(one, codes, trees.boosted_scores(models, zero), ["score"]).collect())
    none = one.where("false")
    assert len(trees.fit_boosted(trees.blocks_of(none, codes), 8, [[]], zero, rounds=1)[0].trees) == 1


@pytest.mark.parametrize("stretch", [4, 50, 10_000])
def test_isotonic_blocks_equal_the_max_min_form(spark, stretch):
    rng = random.Random(stretch)
    points = [(round(rng.random(), 2), int(rng.random() < 0.5)) for _ in range(150)]
    rows = spark.createDataFrame(points, "score double, label int")
    blocks = isotonic.isotonic_blocks(rows, stretch)
    found = {}
    for b in blocks.collect():
        found |= {s: b["total"] / b["weight"] for s, _ in points if b["lo"] <= s <= b["hi"]}
    scores = sorted({s for s, _ in points})
    sums = [(sum(y for s, y in points if s == v), sum(s == v for s, _ in points)) for v in scores]
    mean = lambda a, b: sum(y for y, _ in sums[a : b + 1]) / sum(w for _, w in sums[a : b + 1])
    for i, v in enumerate(scores):
        assert found[v] == pytest.approx(max(min(mean(a, b) for b in range(i, len(scores))) for a in range(i + 1)))
    assert tuple(isotonic.certificate(rows, blocks).first())[:3] == (0, 0, 0)
    worse = spark.createDataFrame([(scores[0], scores[-1], float(len(points)), float(sum(y for _, y in points)))], isotonic.BLOCKS)
    assert isotonic.certificate(rows, worse).first()["low_prefixes"] > 0


def test_far_pages_open_the_ranges_they_cross(spark, tmp_path):
    rows = spark.range(2000).select(F.format_string("%05d", "id").alias("review_id"), (F.col("id") % 7).alias("v"))
    reviews.write_pages(rows.unionByName(spark.createDataFrame([(None, 1)], "review_id string, v bigint")), f"{tmp_path}/pages")
    for skip, n in ((0, 3), (1234, 50), (1990, 100), (5000, 10)):
        got = [r["review_id"] for r in reviews.read_page(spark, f"{tmp_path}/pages", skip, n).collect()]
        assert got == [f"{i:05d}" for i in range(skip, min(skip + n, 2000))]
    plan = reviews.read_page(spark, f"{tmp_path}/pages", 1234, 5)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and math.isfinite(len(plan))


def test_gradient_of_the_loss(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(2)
    x, w = rng.normal(size=(60, 3)) * (rng.random((60, 3)) < 0.7), rng.uniform(0.5, 2, 60)
    for classes in (2, 3):
        y = rng.integers(0, classes, 60)
        rows = spark.createDataFrame([(Vectors.sparse(3, {j: v for j, v in enumerate(a) if v}) if i % 2 else Vectors.dense(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x, y, w, strict=True))], ["features", "label", "w"])
        model = LogisticRegression(maxIter=3, regParam=0.1, standardization=False, weightCol="w", family="binomial" if classes == 2 else "multinomial").fit(rows)
        found = {(r["class"], r["idx"]): r for r in certificates.loss_gradient(model, rows, 0.1, "w").collect()}
        coef, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
        z = x @ coef.T + bias
        p = np.column_stack([1 - 1 / (1 + np.exp(-z[:, 0])), 1 / (1 + np.exp(-z[:, 0]))]) if classes == 2 else np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
        for k, c in enumerate([1] if classes == 2 else range(3)):
            miss = w * (p[:, c] - (y == c)) / w.sum()
            want = [*(x.T @ miss + 0.1 * coef[k]), miss.sum()]
            assert np.allclose(want, [found[(c, i)]["gradient"] for i in (0, 1, 2, -1)], atol=1e-8)

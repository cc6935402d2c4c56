"""Classification metrics as tables.

A score frame has one row per review: ``label``, and ``pred`` or ``score``.
``by`` names extra columns (method, setting, model) to report separately. The
first step of every metric is a grouped count with partial aggregation; what
follows works on a handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.functions.ratios import f1_of, ratio
from starsift.operators.ordering import running_before
from starsift.operators.serving import apply_threshold


def confusion_matrix(predicted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts for every pair of classes that occur on either side, zeros included."""
    by = list(by)
    counts = predicted.groupBy(*by, "label", "pred").agg(F.count(F.lit(1)).alias("n"))
    cells = F.map_from_entries(F.collect_list(F.struct(F.struct("label", "pred"), "n")))
    classes = F.array_sort(F.array_union(F.collect_set("label"), F.collect_set("pred")))
    packed = counts.groupBy(*by).agg(cells.alias("cells"), classes.alias("classes"))
    grid = packed.select(*by, "cells", "classes", F.explode("classes").alias("label"))
    grid = grid.select(*by, "cells", "label", F.explode("classes").alias("pred"))
    n = F.coalesce(F.try_element_at("cells", F.struct("label", "pred")), F.lit(0))
    return grid.select(*by, "label", "pred", n.alias("n"))


def per_class(predicted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per class: true positives, predicted, support, precision, recall, F1."""
    by = list(by)
    counts = predicted.groupBy(*by, "label", "pred").agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("label").alias("class"), hit.alias("tp"), zero.alias("predicted"), F.col("n").alias("support")),
        F.struct(F.col("pred").alias("class"), zero.alias("tp"), F.col("n").alias("predicted"), zero.alias("support")),
    )
    sums = (
        counts.select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "predicted", "support")])
    )
    tp, pred, support = F.col("tp"), F.col("predicted"), F.col("support")
    return sums.withColumns(
        {"precision": ratio(tp, pred), "recall": ratio(tp, support), "f1": f1_of(tp, pred, support)}
    )


def multiclass_summary(predicted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Macro and support-weighted F1, accuracy."""
    total = F.sum("support")
    return per_class(predicted, by).groupBy(*by).agg(
        F.avg("f1").alias("f1_macro"),
        ratio(F.sum(F.col("f1") * F.col("support")), total).alias("f1_weighted"),
        ratio(F.sum("tp"), total).alias("accuracy"),
        total.alias("n"),
    )


def class_report(predicted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per class, then accuracy, macro average and weighted average."""
    by = list(by)
    classes = per_class(predicted, by)
    measures = ("precision", "recall", "f1")
    total = F.sum("support")
    row = classes.select(*by, F.col("class").cast("string").alias("row"), *measures, "support")
    macro = classes.groupBy(*by).agg(*[F.avg(m).alias(m) for m in measures], total.alias("support"))
    weighted = classes.groupBy(*by).agg(
        *[ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in measures], total.alias("support")
    )
    accuracy = classes.groupBy(*by).agg(ratio(F.sum("tp"), total).alias("f1"), total.alias("support"))
    out = row
    for name, part in (("accuracy", accuracy), ("macro avg", macro), ("weighted avg", weighted)):
        out = out.unionByName(part.withColumn("row", F.lit(name)), allowMissingColumns=True)
    return out


def binary_metrics(predicted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 of class 1; 0 where undefined."""
    one_l, one_p = F.col("label") == 1, F.col("pred") == 1
    sums = predicted.groupBy(*by).agg(
        F.count_if(one_l & one_p).alias("tp"),
        F.count_if(~one_l & one_p).alias("fp"),
        F.count_if(one_l & ~one_p).alias("fn"),
        F.count_if(~one_l & ~one_p).alias("tn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return sums.withColumns(
        {"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": f1_of(tp, tp + fp, tp + fn)}
    )


def roc_auc(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties averaged; null with one class only.

    Rows shrink to one per distinct score first; the count of negatives below a
    score is a distributed running total.
    """
    by = list(by)
    one = F.col("label") == 1
    levels = scores.groupBy(*by, "score").agg(F.count_if(one).alias("pos"), F.count_if(~one).alias("neg"))
    ordered = running_before(levels, "score", "neg", by, "neg_below")
    # Double arithmetic: the pair count of a large table exceeds 64 bits.
    won = F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / 2)
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return ordered.groupBy(*by).agg((F.sum(won) / F.nullif(pairs, F.lit(0.0))).alias("roc_auc"))


def fraud_evaluation(scores: DataFrame, by: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
    """Binary metrics at ``threshold`` together with the AUC."""
    by = list(by)
    at = binary_metrics(scores.withColumn("pred", apply_threshold(F.col("score"), threshold)), by)
    auc = roc_auc(scores, by)
    if by:
        return at.join(auc, by)
    return at.withColumn("roc_auc", auc.scalar())


def sentiment_errors(predicted: DataFrame, max_rows: int | None = 25, order: str = "review_id") -> DataFrame:
    """Misclassified texts, the first ``max_rows`` by key (None: all of them)."""
    return _errors(predicted, ["review_body_clean", "true_label", "pred_label"], max_rows, order)


def fraud_errors(predicted: DataFrame, max_rows: int | None = 25, order: str = "review_id") -> DataFrame:
    """Misclassified reviews with rating, votes and, where present, the probability."""
    keep = ["review_body_clean", "star_rating", "helpful_votes", "total_votes", "true_label", "pred_label", "fraud_proba"]
    return _errors(predicted, keep, max_rows, order)


def _errors(predicted: DataFrame, keep: list[str], max_rows: int | None, order: str) -> DataFrame:
    wrong = predicted.where(F.col("label") != F.col("pred"))
    named = wrong.withColumnsRenamed({"label": "true_label", "pred": "pred_label"})
    columns = [order] + [c for c in keep if c in named.columns]
    # Rank first on the columns shown; texts of rows that are not listed never leave their task.
    shown = named.select(columns)
    return shown if max_rows is None else shown.orderBy(order).limit(max_rows)

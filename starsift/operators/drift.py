"""Shift between a reference and a current feature table."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.functions.coerce import flag, number_or
from starsift.operators.ordering import running_before
from starsift.schemas import NUMERIC_FEATURES, TEXT_COLUMN
from starsift.staging import stage


def _with_flag(df: DataFrame) -> DataFrame:
    if "verified_purchase" in df.columns and "verified_purchase_int" not in df.columns:
        return df.withColumn("verified_purchase_int", flag(F.col("verified_purchase")))
    return df


def _means(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """(feature, mean): one aggregation row, turned on its side."""
    one_row = df.agg(*[F.avg(number_or(F.col(c), 0)).alias(c) for c in columns])
    return one_row.unpivot([], columns, "feature", name)


def mean_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES) -> DataFrame:
    """Mean per numeric column on both sides; missing values count as 0, columns of one side only are skipped."""
    reference, current = _with_flag(reference), _with_flag(current)
    shared = [c for c in columns if c in reference.columns and c in current.columns]
    both = _means(reference, shared, "reference_mean").join(_means(current, shared, "current_mean"), "feature")
    return both.withColumn("mean_delta", F.col("current_mean") - F.col("reference_mean"))


def length_drift(reference: DataFrame, current: DataFrame, text: str = TEXT_COLUMN) -> DataFrame:
    """Mean text length on both sides, null text counting as empty; both need the column."""
    size = F.avg(F.length(F.coalesce(F.col(text), F.lit(""))))
    here = reference.agg(size.alias("reference_avg_length"))
    there = current.agg(size.alias("current_avg_length"))
    both = here.withColumn("current_avg_length", there.scalar())
    return both.withColumn("avg_length_delta", F.col("current_avg_length") - F.col("reference_avg_length"))


def drift_summary(reference: DataFrame, current: DataFrame) -> DataFrame:
    """One row: row counts, the mean comparison as an array, the length comparison as a struct.

    One aggregation over both sides, grouped by side; the two rows are then put
    side by side.
    """
    reference, current = _with_flag(reference), _with_flag(current)
    shared = [c for c in NUMERIC_FEATURES if c in reference.columns and c in current.columns]
    columns = [*[number_or(F.col(c), 0).alias(c) for c in shared], F.length(F.coalesce(F.col(TEXT_COLUMN), F.lit(""))).alias("_length")]
    sides = reference.select(F.lit(0).alias("_side"), *columns).unionByName(current.select(F.lit(1).alias("_side"), *columns))
    mean = lambda c, side: F.avg(F.when(F.col("_side") == side, F.col(c)))
    rows = lambda side: F.count_if(F.col("_side") == side)
    one = sides.agg(
        rows(0).alias("row_count_reference"), rows(1).alias("row_count_current"),
        *[mean(c, side).alias(f"{c}_{side}") for c in [*shared, "_length"] for side in (0, 1)],
    )
    pair = lambda c: (F.col(f"{c}_0"), F.col(f"{c}_1"), F.col(f"{c}_1") - F.col(f"{c}_0"))
    names = ("reference_mean", "current_mean", "mean_delta")
    compared = [F.struct(F.lit(c).alias("feature"), *[x.alias(n) for x, n in zip(pair(c), names, strict=True)]) for c in shared]
    lengths = [x.alias(n) for x, n in zip(pair("_length"), ("reference_avg_length", "current_avg_length", "avg_length_delta"), strict=True)]
    return one.select(
        "row_count_reference", "row_count_current", F.array_sort(F.array(*compared)).alias("numeric_mean_comparison"),
        F.struct(*lengths).alias("text_length_summary"),
    )


def decile_edges(reference: DataFrame, column: str, bins: int = 10) -> list[float]:
    """Inner quantile edges of the reference, from a mergeable sketch (bins - 1 numbers)."""
    quantiles = [i / bins for i in range(1, bins)]
    found = reference.agg(F.percentile_approx(column, quantiles, 100_000).alias("q")).first()["q"]
    return sorted(set(float(q) for q in found or []))


def exact_quantiles(df: DataFrame, column: str, quantiles: Sequence[float]) -> list[float]:
    """For each quantile the smallest value that so large a share of the rows does not exceed; nulls left out.

    Rows shrink to one a value, and running totals over ranges of the values give their
    ranks, so no task sorts the whole column.
    """
    levels = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranked = stage(running_before(levels, "value", "n"), "ranks")
    total = ranked.agg(F.sum("n")).first()[0]
    if not total:
        return []
    reached = F.col("before") + F.col("n")
    found = ranked.agg(*[F.min(F.when(reached >= math.ceil(q * total - 1e-9), F.col("value"))).alias(f"q{i}") for i, q in enumerate(quantiles)]).first()
    return [float(v) for v in found]


def population_stability(
    reference: DataFrame, current: DataFrame, column: str, edges: Sequence[float], epsilon: float = 1e-4
) -> DataFrame:
    """Population stability index over the bins that ``edges`` cut.

    Sum of (c - r) * ln(c / r) over the bins' row shares, each at least ``epsilon``.
    Every bin between the edges counts, empty or not; a side without rows has the
    share ``epsilon`` everywhere.
    """
    bin_of = F.lit(0)
    for edge in edges:
        bin_of = bin_of + F.when(F.col(column) >= float(edge), 1).otherwise(0)
    side = lambda df, r, c: df.where(F.col(column).isNotNull()).select(bin_of.alias("bin"), F.lit(r).alias("r"), F.lit(c).alias("c"))
    every = reference.sparkSession.range(len(edges) + 1).select(F.col("id").cast("int").alias("bin"), F.lit(0).alias("r"), F.lit(0).alias("c"))
    both = side(reference, 1, 0).unionByName(side(current, 0, 1)).unionByName(every)
    bins = both.groupBy("bin").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    sums = bins.agg(F.sum("r").alias("r_all"), F.sum("c").alias("c_all"), F.collect_list(F.struct("r", "c")).alias("bins"))
    each = sums.select("r_all", "c_all", F.size("bins").alias("n_bins"), F.inline("bins"))
    floor = F.lit(epsilon)
    share = lambda n, total: F.greatest(F.coalesce(F.try_divide(F.col(n), F.col(total)), F.lit(0.0)), floor)
    r, c = share("r", "r_all"), share("c", "c_all")
    return each.agg(F.sum((c - r) * F.log(c / r)).alias("psi"), F.first("n_bins").alias("n_bins"))

"""Isotonic regression by pooling adjacent violators, without gathering the points.

Points shrink to one row a score. Stretches of consecutive rows are pooled in tasks of
their own; pooling may be done in any order, so the stretches are laid anew, shifted by
half of one, over the blocks that are left, until neither way of laying them pools
anything. Then no two neighbours fall anywhere.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.operators.ordering import running_before
from starsift.staging import stage

#: Consecutive blocks that one task pools.
STRETCH = 50_000
BLOCKS = "lo double, hi double, weight double, total double"


def pooled(lo: list[float], hi: list[float], weight: list[float], total: list[float]) -> list[tuple[float, float, float, float]]:
    """Neighbours merged while the mean of the left one is not below that of the right one."""
    out: list[tuple[float, float, float, float]] = []
    for block in zip(lo, hi, weight, total, strict=True):
        while out and out[-1][3] * block[2] >= block[3] * out[-1][2]:
            left = out.pop()
            block = (left[0], block[1], left[2] + block[2], left[3] + block[3])
        out.append(block)
    return out


def isotonic_blocks(rows: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """(lo, hi, weight, total) of the fitted curve of (score, label) rows: one row for each level, which is total / weight."""
    levels = rows.where(F.col("score").isNotNull() & F.col("label").isNotNull()).groupBy("score").agg(
        F.count(F.lit(1)).cast("double").alias("weight"), F.sum(F.col("label").cast("double")).alias("total")
    )
    blocks = stage(levels.select(F.col("score").alias("lo"), F.col("score").alias("hi"), "weight", "total"), "isotonic")

    def pool(table: pa.Table) -> pa.Table:
        table = table.sort_by("lo")
        found = pooled(*(table.column(c).to_pylist() for c in ("lo", "hi", "weight", "total")))
        return pa.table({n: pa.array(c, pa.float64()) for n, c in zip(("lo", "hi", "weight", "total"), zip(*found, strict=True), strict=True)})

    n, still, shift = blocks.count(), 0, 0
    while True:
        placed = running_before(blocks.withColumn("_one", F.lit(1)), "lo", "_one", out="_nth")
        dealt = placed.select("lo", "hi", "weight", "total", F.floor((F.col("_nth") + shift) / stretch).cast("bigint").alias("part"))
        blocks = stage(dealt.groupBy("part").applyInArrow(lambda table: pool(table), BLOCKS), "isotonic")
        left = blocks.count()
        still = still + 1 if left == n else 0
        if still == 2 or (n <= stretch and shift == 0):
            return blocks
        n, shift = left, 0 if left <= stretch else stretch // 2 - shift


def certificate(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """One row that shows whether the blocks are the least-squares monotone curve of (score, label) rows.

    ``falls``: blocks not above the one before; ``off_mean``: blocks whose level is not
    the mean of their labels; ``low_prefixes``: scores up to which the mean of a block is
    below its level, which would be split there; all are 0 for the optimum, and for it
    only. ``scores`` and ``total`` are the points and the sum of labels they account for.
    """
    levels = rows.groupBy("score").agg(F.count(F.lit(1)).cast("double").alias("w"), F.sum(F.col("label").cast("double")).alias("y"))
    marks = blocks.select(F.col("lo").alias("score"), F.lit(0.0).alias("w"), F.lit(0.0).alias("y"), F.lit(1).alias("first"), F.col("weight").alias("bw"), F.col("total").alias("by"))
    points = levels.select("score", "w", "y", F.lit(0).alias("first"), F.lit(0.0).alias("bw"), F.lit(0.0).alias("by"))
    merged = points.unionByName(marks).groupBy("score").agg(*[F.sum(c).alias(c) for c in ("w", "y", "first", "bw", "by")])
    merged = stage(merged, "isotonic-points")
    numbered = running_before(merged, "score", "first", out="earlier").withColumn("block", F.col("earlier") + F.col("first"))
    inside = running_before(stage(numbered, "isotonic-points"), "score", "w", by=["block"], out="w_before")
    inside = running_before(stage(inside, "isotonic-points"), "score", "y", by=["block"], out="y_before")
    sums = numbered.groupBy("block").agg(F.sum("w").alias("w_all"), F.sum("y").alias("y_all"), F.sum("bw").alias("bw_all"), F.sum("by").alias("by_all"))
    sums = stage(sums, "isotonic-blocks")
    held = inside.join(sums, "block")
    low = (F.col("y_before") + F.col("y")) * F.col("w_all") < F.col("y_all") * (F.col("w_before") + F.col("w")) * (1 - 1e-12)
    checked = held.agg(F.count_if(low).alias("low_prefixes"), F.count_if(F.col("w") > 0).alias("scores"), F.sum("y").alias("total"))
    before = sums.select((F.col("block") + 1).alias("block"), (F.col("by_all") / F.col("bw_all")).alias("before"))
    falls = sums.join(before, "block", "left").agg(
        F.count_if(F.col("by_all") / F.col("bw_all") <= F.col("before")).alias("falls"),
        F.count_if((F.abs(F.col("w_all") - F.col("bw_all")) > 1e-6) | (F.abs(F.col("y_all") - F.col("by_all")) > 1e-6)).alias("off_mean"),
    )
    one = checked.withColumn("f", falls.select(F.struct("falls", "off_mean")).scalar())
    return one.select("f.falls", "f.off_mean", "low_prefixes", "scores", "total")

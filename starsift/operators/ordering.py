"""Running totals over a global order without a global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starsift.staging import stage


def running_before(df: DataFrame, order: str, value: str, by: Sequence[str] = (), out: str = "before") -> DataFrame:
    """Add the sum of ``value`` over all rows that precede in ``order`` (within ``by``).

    ``order`` must be unique within ``by``. The rows are range-partitioned by
    (by, order) and staged with their partition number, so the number stays what
    it was when the rows were written. Totals per partition are a table of at
    most (partitions x groups) rows, whose own running sum gives each partition
    its offset; inside a partition a window does the rest. No task ever sees more
    than one range partition.
    """
    by = list(by)
    ranged = df.repartitionByRange(*by, order).withColumn("_part", F.spark_partition_id())
    parts = stage(ranged, "ranged")
    earlier_parts = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy(*by, "_part").agg(F.sum(value).alias("_total"))
    offsets = totals.select(*by, "_part", F.coalesce(F.sum("_total").over(earlier_parts), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*by, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = parts.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = local.join(offsets, [*by, "_part"])
    return joined.withColumn(out, F.col("_offset") + F.col("_local")).drop("_part", "_offset", "_local")

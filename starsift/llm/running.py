"""Running totals along a sort order, whatever the size of a group.

Rows are dealt out in ranges of the order, so a group with a third of all rows is
spread over as many partitions as its share; each partition adds up its own runs and
the totals of earlier partitions are added to the few groups that cross a border.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from starsift.llm.common import small_batches
from starsift.staging import stage


def run_starts(columns: list[pa.Array], last: tuple | None) -> np.ndarray:
    """Which rows begin a new run of equal values; ``last`` are the values of the row before the first one."""
    n = len(columns[0])
    starts = np.zeros(n, bool)
    for c in columns:
        null = pc.is_null(c).to_numpy(zero_copy_only=False)
        starts[1:] |= null[1:] != null[:-1]
        equal = pc.equal(c.slice(1), c.slice(0, n - 1))
        starts[1:] |= ~pc.fill_null(equal, True).to_numpy(zero_copy_only=False)
    starts[0] = last is None or tuple(c[0].as_py() for c in columns) != last
    return starts


def running_totals(df: DataFrame, by: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``df`` with ``<value>_total`` (bigint): the sum of a value up to and including the row, within ``by``, along ``order``.

    Nulls come first in the order and are a group of their own in ``by``; rows that
    are equal in ``order`` follow each other in no stated order. The values must not
    be null. The table is written with its range partitions, so a repeated task finds
    the same ranges. The totals that cross a border are at most one row a partition,
    which is what makes their broadcast safe.
    """
    by, order, values = list(by), list(order), list(values)
    small_batches(df.sparkSession)
    part = "_part"
    sums = [f"{v}_total" for v in values]
    schema = StructType([*df.schema.fields, *(StructField(s, LongType()) for s in sums), StructField(part, IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        last, carry = None, np.zeros(len(values), np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = [batch.column(c) for c in by]
            starts = run_starts(keys, last)
            at = np.maximum.accumulate(np.where(starts, np.arange(n), -1))  # -1: the run of the batch before
            added = []
            for i, v in enumerate(values):
                own = np.cumsum(batch.column(v).to_numpy(zero_copy_only=False).astype(np.int64))
                before = np.where(at > 0, own[np.maximum(at, 1) - 1], 0)
                total = own - before + np.where(at < 0, carry[i], 0)
                carry[i] = total[-1]
                added.append(pa.array(total, pa.int64()))
            last = tuple(c[n - 1].as_py() for c in keys)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added, pa.array(np.full(n, number, np.int32))], [*batch.schema.names, *sums, part]
            )

    ranged = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    local = stage(ranged.mapInArrow(run, schema), "running")
    earlier = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = local.groupBy(*by, part).agg(*[F.sum(v).alias(v) for v in values])
    shifts = totals.select(
        *[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)], F.col(part).alias("_at"),
        *[F.sum(v).over(earlier).alias(f"_shift_{i}") for i, v in enumerate(values)],
    ).where(F.col("_shift_0").isNotNull())
    same = F.col(part) == F.col("_at")
    for i, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"_by_{i}"))
    joined = local.join(F.broadcast(shifts), same, "left")
    moved = [(F.col(s) + F.coalesce(f"_shift_{i}", F.lit(0))).alias(s) for i, s in enumerate(sums)]
    return joined.select(*df.columns, *moved)

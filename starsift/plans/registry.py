"""Registry of queries: a Spark callable and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift.plans.inputs import INPUT_SQL

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None, own: bool = False) -> Callable[[Run], Run]:
    """Register the function under its name. ``sql`` follows the input tables' CTEs unless ``own``."""

    def add(run: Run) -> Run:
        # A leading comma continues the CTE list.
        text = sql if sql is None or own else f"WITH {INPUT_SQL}\n{sql}"
        QUERIES[run.__name__] = Query(run.__name__, covers, run, text)
        return run

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that sums in another order compare equal."""
    doubles = {c: F.round(c, digits) for c, kind in df.dtypes if kind == "double"}
    return df.withColumns(doubles) if doubles else df

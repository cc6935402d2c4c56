"""Reviewer and product behaviour, attached to every review.

Each feature belongs to a group of reviews (a reviewer, a reviewer's day, a
product, the copies of a text within a product). A window function would pull a
whole group into one task, and one product or one copied text may hold a third
of all rows. So every group is aggregated first (partial sums before the
shuffle), the small result is staged, and then joined back. Staged, both sides
of that join are scans below an exchange, so adaptive execution broadcasts a
group table that turns out small and splits the partition of a hot key.

With several group tables to attach, they first meet in a table of the distinct
(reviewer, day, product, text digest) combinations, which holds no text; the
wide reviews are shuffled once, for the last join.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.staging import stage

DAY = "_day"
BODY = "_body_md5"
#: The day of reviews without a date.
NO_DAY = -(2**31)


def with_group_keys(cleaned: DataFrame) -> DataFrame:
    """Add the day and text-digest keys; reviews without a date share one day.

    Every row carries both through all shuffles, so the day is a number and the digest
    its 16 bytes, half of what they take as text.
    """
    day = F.coalesce(F.unix_date(F.to_date("review_ts")), F.lit(NO_DAY))
    return cleaned.withColumns({DAY: day, BODY: F.unhex(F.md5(F.col("review_body_clean").cast("binary")))})


def reviewer_groups(keyed: DataFrame) -> DataFrame:
    """Per reviewer: reviews, rating shape, distinct products, verified share.

    Grouping by (reviewer, product) first makes the distinct count a plain
    count of groups, without a set in memory.
    """
    five = (F.col("star_rating") == 5).cast("int")
    verified = F.col("verified_purchase").cast("int")
    per_product = keyed.groupBy("reviewer_id", "product_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("star_rating").alias("stars"),
        F.sum(five).alias("fives"),
        F.sum(verified).alias("verified"),
        F.count(verified).alias("known"),
    )
    total = F.sum("n")
    return per_product.groupBy("reviewer_id").agg(
        total.alias("reviewer_review_count"),
        (F.sum("stars") / total).alias("reviewer_avg_rating"),
        (F.sum("fives") / total).alias("reviewer_pct_5star"),
        F.count(F.lit(1)).cast("int").alias("reviewer_distinct_products"),
        F.try_divide(F.sum("verified"), F.sum("known")).alias("reviewer_verified_share"),
    )


def reviewer_day_groups(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("reviewer_id", DAY).agg(F.count(F.lit(1)).alias("reviewer_reviews_same_day"))


def product_groups(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("product_review_count"),
        F.avg("star_rating").alias("product_avg_rating"),
        F.avg((F.col("star_rating") == 5).cast("double")).alias("product_pct_5star"),
    )


def duplicate_groups(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("product_id", BODY).agg(F.count(F.lit(1)).alias("dup_in_product"))


# group table -> its keys
GROUPS = {
    "reviewer": (reviewer_groups, ["reviewer_id"]),
    "reviewer_day": (reviewer_day_groups, ["reviewer_id", DAY]),
    "product": (product_groups, ["product_id"]),
    "duplicate": (duplicate_groups, ["product_id", BODY]),
}


def group_tables(keyed: DataFrame, *names: str) -> dict[str, DataFrame]:
    """The named group tables over all rows, staged."""
    return {name: stage(GROUPS[name][0](keyed), name) for name in names}


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], label: str = "groups") -> DataFrame:
    """Attach one row of ``groups`` per key to every row, whatever its skew."""
    return rows.join(stage(groups, label), keys)


def join_tables(keyed: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Attach the staged group tables; narrow ones meet the cells first, which then shuffle fewer columns."""
    cell_keys = list(dict.fromkeys(k for name in tables for k in GROUPS[name][1]))
    if all(GROUPS[name][1] == cell_keys for name in tables):
        cells = keyed
    else:
        cells = keyed.select(cell_keys).distinct()
    for name in sorted(tables, key=lambda name: len(tables[name].columns)):
        cells = cells.join(tables[name], GROUPS[name][1])
    added = [c for name, table in tables.items() for c in table.columns if c not in GROUPS[name][1]]
    joined = cells if len(tables) == 1 else keyed.join(cells, cell_keys)
    return joined.select(*[c for c in joined.columns if c not in added], *added)


def attach(keyed: DataFrame, *names: str) -> DataFrame:
    """Attach the named group tables. ``keyed`` should be a staged table."""
    return join_tables(keyed, group_tables(keyed, *names))


def attach_by_slices(keyed: DataFrame, n: int, *names: str) -> Iterator[DataFrame]:
    """As ``attach``, in ``n`` parts by reviewer that together are all rows.

    Joins shuffle every row with all its columns. Where each part is written before the
    next is asked for, only the shuffle files of one part are there at a time.
    """
    tables = group_tables(keyed, *names)
    own = F.pmod(F.xxhash64("reviewer_id"), F.lit(n))
    for i in range(n):
        part = {name: t.where(own == i) if "reviewer_id" in t.columns else t for name, t in tables.items()}
        yield join_tables(keyed.where(own == i), part)


def reviewer_features(keyed: DataFrame) -> DataFrame:
    return attach(keyed, "reviewer", "reviewer_day")


def product_features(keyed: DataFrame) -> DataFrame:
    return attach(keyed, "product")


def duplicate_counts(keyed: DataFrame) -> DataFrame:
    return attach(keyed, "duplicate")


def behaviour_features(keyed: DataFrame) -> DataFrame:
    """All ten behaviour columns."""
    return attach(keyed, "reviewer", "reviewer_day", "product", "duplicate")

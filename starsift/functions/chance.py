"""Repeatable randomness: a hash of the row key and a salt.

Unlike ``rand`` it does not depend on how rows are laid out over partitions, so
a re-run task, a retried stage and a different cluster all draw the same value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(key: Column, salt: str) -> Column:
    return F.md5(F.concat(F.lit(salt + ":"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))


def leading_bits(key: Column, salt: str, hex_digits: int) -> Column:
    """The first hex digits of the digest as a number."""
    return F.conv(F.substring(digest(key, salt), 1, hex_digits), 16, 10).cast("bigint")


def uniform(key: Column, salt: str) -> Column:
    """Value in [0, 1) drawn from the key."""
    return leading_bits(key, salt, 8) / F.lit(float(2**32))

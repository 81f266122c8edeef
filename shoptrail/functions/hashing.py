"""Seeded hash order of users: the repeatable substitute for random draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_order(key: Column | str, seed: int, salt: str) -> Column:
    """32 hex digits that order users at random but repeatably, whatever the partitioning."""
    column = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:{salt}:"), column.cast("string")))


def fold_number(key: Column | str, folds: int, seed: int) -> Column:
    """Fold of a user, 0 .. folds-1: all rows of a user share it."""
    head = F.substring(hash_order(key, seed, "fold"), 1, 8)
    return (F.conv(head, 16, 10).cast("bigint") % folds).cast("int")

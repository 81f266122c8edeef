"""Exact, repeatable samples and splits of users.

Users are ordered by a seeded hash. "The first n users" is then a threshold on that hash, so a
sample of exactly n is a filter expression with literals in it: no sort, no window, no join, and
any table that carries ``user_id`` can be split with it.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.config import USER_KEY
from shoptrail.functions.hashing import hash_order

# Hex digits examined per step: 16**3 = 4,096 counters come back to the driver each time.
STEP = 3
HASH_DIGITS = 32


@dataclass(frozen=True)
class HashCut:
    """Users whose hash starts with a prefix up to ``prefix`` belong to the sample."""

    seed: int
    salt: str
    prefix: str

    def member(self, key: Column | str = USER_KEY) -> Column:
        head = F.substring(hash_order(key, self.seed, self.salt), 1, max(len(self.prefix), 1))
        return F.coalesce(head <= F.lit(self.prefix), F.lit(False)) if self.prefix else F.lit(False)


def exact_cut(users: DataFrame, n: int, seed: int, salt: str) -> HashCut:
    """The threshold below which exactly ``n`` of the distinct ``users`` lie (all, if fewer).

    Counts users per three-digit prefix, walks to the prefix in which the n-th user falls, then
    looks inside that prefix only, until a prefix ends exactly at n. Each step shrinks the users
    looked at by 4,096; a billion users take three. Run it on a materialized table. A null user is no
    member and is not counted.
    """
    if n <= 0:
        return HashCut(seed, salt, "")
    hashed = users.filter(F.col(USER_KEY).isNotNull()).select(hash_order(USER_KEY, seed, salt).alias("h"))
    found, wanted = "", n
    for width in range(STEP, HASH_DIGITS + STEP, STEP):
        width = min(width, HASH_DIGITS)
        inside = hashed.filter(F.col("h").startswith(found)) if found else hashed
        counts = inside.groupBy(F.substring("h", 1, width).alias("head")).agg(F.count("*").alias("n"))
        rows = sorted((r["head"], r["n"]) for r in counts.collect())  # at most 4,096
        before = 0
        for (head, size), total in zip(rows, accumulate(size for _, size in rows)):
            if total >= wanted:
                found = head
                break
            before = total
        else:
            return HashCut(seed, salt, "g")  # fewer than n users: above every hex digit
        if total == wanted:
            return HashCut(seed, salt, found)
        wanted -= before
    return HashCut(seed, salt, found)


def exact_sample(users: DataFrame, n: int, seed: int, salt: str) -> DataFrame:
    return users.filter(exact_cut(users, n, seed, salt).member())


def split_share(users: DataFrame, share: float, seed: int, salt: str) -> HashCut:
    """Threshold for the first floor(share * number of users)."""
    return exact_cut(users, int(users.count() * share), seed, salt)

"""Who is scored: label pairs, user pool, splits and the user x category scaffold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.config import CATEGORY, PAIR_KEY, USER_KEY, Settings
from shoptrail.functions.columns import in_period, is_kind, percent
from shoptrail.functions.hashing import fold_number
from shoptrail.operators.sampling import HashCut, exact_cut, split_share
from shoptrail.session import materialize

# A large vocabulary is joined in this many user blocks times this many category blocks.
SCAFFOLD_BLOCKS = 32


def label_pairs(events: DataFrame, cfg: Settings) -> DataFrame:
    """(user, category) pairs with a purchase in the label window."""
    in_window = is_kind("purchase") & in_period(cfg.cutoff, cfg.target_end)
    return events.filter(in_window).select(*PAIR_KEY).distinct()


def user_flags(events: DataFrame, cfg: Settings) -> DataFrame:
    """One row per user of the log: bought in the label window, active before the cutoff.

    One aggregation answers what distinct sets and anti-joins between them would. A missing type or time
    counts as neither.
    """
    bought = is_kind("purchase") & in_period(cfg.cutoff, cfg.target_end)
    return events.groupBy(USER_KEY).agg(
        F.coalesce(F.max(bought), F.lit(False)).alias("purchaser"),
        F.coalesce(F.max(in_period(end=cfg.cutoff)), F.lit(False)).alias("active_before"),
    )


def non_purchasers(events: DataFrame, pairs: DataFrame) -> DataFrame:
    """Users of the log without a label pair, as an anti-join of distinct user sets."""
    everyone = events.select(USER_KEY).distinct()
    return everyone.join(pairs.select(USER_KEY).distinct(), USER_KEY, "left_anti")


def pool_cut(flags: DataFrame, cfg: Settings) -> HashCut:
    """Threshold that takes ``ratio`` non-purchasers per purchaser, or all there are."""
    tally = flags.agg(
        F.count_if("purchaser").alias("buyers"), F.count_if(~F.col("purchaser")).alias("others")
    ).first()
    wanted = min(tally["buyers"] * cfg.non_purchaser_ratio, tally["others"])
    return exact_cut(flags.filter(~F.col("purchaser")), wanted, cfg.seed, "pool")


def user_pool(flags: DataFrame, cfg: Settings) -> DataFrame:
    """Purchasers and the sampled non-purchasers. ``flags`` should be materialized."""
    return flags.filter(F.col("purchaser") | pool_cut(flags, cfg).member())


def sampled_cold_share(pool: DataFrame) -> DataFrame:
    """How many sampled non-purchasers have no event before the cutoff."""
    cold = F.count_if(~F.col("active_before"))
    return (
        pool.filter(~F.col("purchaser"))
        .agg(F.count("*").alias("sampled"), cold.alias("cold_sampled"))
        .withColumn("cold_pct", percent(F.col("cold_sampled"), F.col("sampled"), 1))
    )


def train_test_cut(pool: DataFrame, cfg: Settings) -> HashCut:
    return split_share(pool, cfg.train_share, cfg.seed, "train")


def assign_splits(pool: DataFrame, cfg: Settings) -> DataFrame:
    """Adds ``split`` (train / test). Disjoint and exhaustive, as both sides use one threshold."""
    is_train = train_test_cut(pool, cfg).member()
    return pool.withColumn("split", F.when(is_train, F.lit("train")).otherwise(F.lit("test")))


def split_users(pool: DataFrame, cfg: Settings) -> tuple[DataFrame, DataFrame]:
    assigned = assign_splits(pool, cfg)
    train = assigned.filter(F.col("split") == "train").drop("split")
    return train, assigned.filter(F.col("split") == "test").drop("split")


def overlapping_users(left: DataFrame, right: DataFrame) -> DataFrame:
    """Users on both sides; a correct split has none."""
    return left.select(USER_KEY).join(right.select(USER_KEY), USER_KEY, "left_semi")


def validation_cut(train_users: DataFrame, cfg: Settings) -> HashCut:
    return split_share(train_users, cfg.validation_share, cfg.seed, "validation")


def calibration_cut(validation_users: DataFrame, cfg: Settings) -> HashCut:
    return split_share(validation_users, cfg.calibration_share, cfg.seed, "calibration")


def with_fold(rows: DataFrame, cfg: Settings) -> DataFrame:
    """Adds ``fold``, the same for all rows of a user."""
    return rows.withColumn("fold", fold_number(USER_KEY, cfg.folds, cfg.seed))


def scaffold(users: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Every user with every configured category: a fixed number of output rows per user."""
    return users.withColumn(CATEGORY, F.explode(F.array(*[F.lit(c) for c in categories])))


def full_scaffold(users: DataFrame, events: DataFrame, most: int = 10_000) -> DataFrame:
    """Every user with every category found in the log.

    A checked, small vocabulary becomes an array literal. A larger one is joined: both sides are
    cut into blocks, and each pair of blocks meets once, so the work is spread evenly and every
    pair appears exactly once.
    """
    names = events.select(CATEGORY).filter(F.col(CATEGORY).isNotNull()).distinct()
    found = names.limit(most + 1).collect()
    if len(found) <= most:
        return scaffold(users, sorted(row[CATEGORY] for row in found))

    def block(key: str):
        return F.pmod(F.xxhash64(key), F.lit(SCAFFOLD_BLOCKS))

    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SCAFFOLD_BLOCKS - 1).cast("bigint")))
    left = users.withColumn("user_block", block(USER_KEY)).withColumn("category_block", every)
    right = names.withColumn("category_block", block(CATEGORY)).withColumn("user_block", every)
    return left.join(right, ["user_block", "category_block"]).select(*users.columns, CATEGORY)


def attach_labels(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """``label`` 1 where the pair was purchased, else 0. Both sides have unique pairs."""
    positive = pairs.select(*PAIR_KEY, F.lit(1).alias("label"))
    return rows.join(positive, list(PAIR_KEY), "left").fillna(0, ["label"])


def labelled_scaffold(users: DataFrame, pairs: DataFrame, categories: Sequence[str]) -> DataFrame:
    return attach_labels(scaffold(users, categories), pairs)


def positive_rate(labelled: DataFrame) -> DataFrame:
    return labelled.agg(
        F.count("*").alias("rows"),
        F.sum("label").alias("positives"),
        F.round(F.avg("label") * 100, 2).alias("positive_rate_pct"),
    )


def positive_rate_by_category(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy(CATEGORY).agg(
        F.count("*").alias("scaffold_rows"),
        F.sum("label").alias("positives"),
        F.round(F.avg("label") * 100, 2).alias("positive_rate_pct"),
    )


def category_support(labelled: DataFrame, min_positives: int) -> DataFrame:
    """Categories with enough positives to learn from."""
    return positive_rate_by_category(labelled).filter(F.col("positives") >= min_positives)


def support_of_users(users: DataFrame, pairs: DataFrame, names: DataFrame, min_positives: int) -> DataFrame:
    """``category_support`` of every user with every category, without making these rows.

    A category has as many rows as there are users, and as many positives as these users have label pairs in it.
    """
    people = materialize(users.select(USER_KEY).distinct(), "support-users")
    positives = pairs.join(people, USER_KEY, "left_semi").groupBy(CATEGORY).agg(F.count("*").alias("found"))
    rows = F.lit(people.count()).cast("bigint")
    counted = names.select(CATEGORY).filter(F.col(CATEGORY).isNotNull()).distinct().join(positives, CATEGORY, "left").select(
        CATEGORY, rows.alias("scaffold_rows"), F.coalesce("found", F.lit(0)).alias("positives"))
    rate = F.round(F.try_divide(F.col("positives"), F.col("scaffold_rows")) * 100, 2)
    return counted.withColumn("positive_rate_pct", rate).filter(F.col("positives") >= min_positives)


def split_summary(rows: DataFrame, split: str = "split") -> DataFrame:
    """Rows, users and positive rate per split."""
    return rows.groupBy(split).agg(
        F.count_distinct(USER_KEY).alias("users"),
        F.count("*").alias("rows"),
        F.round(F.avg("label"), 6).alias("positive_rate"),
    )


def positive_users_rows(rows: DataFrame) -> DataFrame:
    """Case-control subset: all rows of users with at least one positive row."""
    buyers = rows.filter(F.col("label") == 1).select(USER_KEY).distinct()
    return rows.join(buyers, USER_KEY, "left_semi")


def build_population(events: DataFrame, cfg: Settings) -> DataFrame:
    """The pool with ``split``, from two passes over a small materialized user table."""
    flags = materialize(user_flags(events, cfg), "user-flags")
    pool = materialize(user_pool(flags, cfg), "user-pool")
    return assign_splits(pool, cfg)

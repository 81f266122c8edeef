"""Labels, user pool, samples, splits and scaffold."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoptrail.checks.base import ACT, CFG, activity, check, clean, stored_clean
from shoptrail.config import CATEGORY, USER_KEY
from shoptrail.operators import population as P
from shoptrail.operators.sampling import exact_sample
from shoptrail.session import materialize


def _pool_of(events):
    flags = materialize(P.user_flags(events, CFG), "user-flags")
    return materialize(P.user_pool(flags, CFG), "user-pool")


def _pool(spark, folder):
    return _pool_of(clean(spark, folder))


def _labelled(spark, folder):
    """Both splits of the pool, labelled, as one frame with ``split``."""
    events = stored_clean(spark, folder)
    pool = P.assign_splits(_pool_of(events), CFG).select(USER_KEY, "split")
    return P.labelled_scaffold(pool, P.label_pairs(events, CFG), CFG.categories)


def labelled_parts(spark, folder):
    """The labelled pool with ``part``: pool, validation or test."""
    labelled = materialize(_labelled(spark, folder), "labelled")
    users = labelled.filter(F.col("split") == "train").select(USER_KEY).distinct()
    held_out = P.validation_cut(materialize(users, "train-users"), CFG).member()
    part = F.when(F.col("split") == "test", "test").when(held_out, "validation").otherwise("pool")
    return labelled.withColumn("part", part)


@check("c2_label_pairs", "SELECT * FROM pairs", "pairs")
def c2(spark, folder):
    return P.label_pairs(clean(spark, folder), CFG)


@check(
    "c2_activity_label_pairs",
    f"""
SELECT DISTINCT user_id, category_l1 FROM act WHERE event_type = 'purchase'
 AND event_time >= TIMESTAMP '{ACT.cutoff}' AND event_time < TIMESTAMP '{ACT.target_end}'""",
    "act",
)
def c2_activity(spark, folder):
    return P.label_pairs(activity(spark, folder), ACT)


@check(
    "j2_non_purchasers_anti",
    "SELECT DISTINCT user_id FROM clean WHERE user_id NOT IN (SELECT user_id FROM pairs)",
    "pairs",
)
def j2(spark, folder):
    events = clean(spark, folder)
    return P.non_purchasers(events, P.label_pairs(events, CFG))


@check("a11_user_flags", "SELECT * FROM flags", "flags")
def a11(spark, folder):
    return P.user_flags(clean(spark, folder), CFG)


@check("x1_exact_sample", "SELECT user_id FROM pool WHERE NOT purchaser", "pool")
def x1(spark, folder):
    return _pool(spark, folder).filter(~F.col("purchaser")).select(USER_KEY)


@check(
    "o4_hash_ordered_sample",
    """
SELECT user_id FROM (SELECT DISTINCT user_id FROM clean)
ORDER BY md5('7:audit:' || user_id), user_id LIMIT 1000""",
    "clean",
)
def o4(spark, folder):
    users = materialize(clean(spark, folder).select(USER_KEY).distinct(), "users")
    return exact_sample(users, 1000, 7, "audit")


@check("c3_user_pool", "SELECT * FROM pool", "pool")
def c3(spark, folder):
    return _pool(spark, folder)


@check("u1_pool_union", "SELECT user_id FROM pool", "pool")
def u1(spark, folder):
    flags = materialize(P.user_flags(clean(spark, folder), CFG), "user-flags")
    sampled = flags.filter(~F.col("purchaser") & P.pool_cut(flags, CFG).member())
    return flags.filter("purchaser").select(USER_KEY).unionByName(sampled.select(USER_KEY))


@check(
    "c3_sampled_cold_share",
    """
SELECT count(*) AS sampled, CAST(count(*) FILTER (NOT active_before) AS BIGINT) AS cold_sampled,
 round(count(*) FILTER (NOT active_before) / CAST(count(*) AS DOUBLE) * 100, 1) AS cold_pct
FROM pool WHERE NOT purchaser""",
    "pool",
)
def c3_cold(spark, folder):
    return P.sampled_cold_share(_pool(spark, folder))


@check("x2_train_users", "SELECT user_id FROM splits WHERE split = 'train'", "splits")
def x2(spark, folder):
    return P.split_users(_pool(spark, folder), CFG)[0].select(USER_KEY)


@check("u2_test_users", "SELECT user_id FROM splits WHERE split = 'test'", "splits")
def u2(spark, folder):
    return P.split_users(_pool(spark, folder), CFG)[1].select(USER_KEY)


@check("c4_split_users", "SELECT * FROM splits", "splits")
def c4(spark, folder):
    return P.assign_splits(_pool(spark, folder), CFG).select(USER_KEY, "split")


@check(
    "u3_split_overlap",
    """
SELECT user_id FROM splits WHERE split = 'train' AND user_id IN (SELECT user_id FROM splits WHERE split = 'test')""",
    "splits",
)
def u3(spark, folder):
    return P.overlapping_users(*P.split_users(_pool(spark, folder), CFG))


@check("x3_validation_users", "SELECT DISTINCT user_id FROM parts WHERE part = 'validation'", "parts")
def x3(spark, folder):
    return labelled_parts(spark, folder).filter(F.col("part") == "validation").select(USER_KEY).distinct()


@check("p11_pool_rows", "SELECT user_id, category_l1, label FROM parts WHERE part = 'pool'", "parts")
def p11(spark, folder):
    return labelled_parts(spark, folder).filter(F.col("part") == "pool").select(USER_KEY, CATEGORY, "label")


@check(
    "x4_user_folds",
    """
SELECT user_id, category_l1, CAST(CAST('0x' || substr(md5('42:fold:' || user_id), 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold
FROM labelled""",
    "labelled",
)
def x4(spark, folder):
    return P.with_fold(_labelled(spark, folder), CFG).select(USER_KEY, CATEGORY, "fold")


@check(
    "x5_calibration_half",
    """
SELECT user_id FROM (SELECT user_id, row_number() OVER (ORDER BY md5('42:calibration:' || user_id), user_id) AS turn,
 count(*) OVER () AS n FROM (SELECT DISTINCT user_id FROM parts WHERE part = 'validation'))
WHERE turn <= floor(n * CAST(0.5 AS DOUBLE))""",
    "parts",
)
def x5(spark, folder):
    rows = labelled_parts(spark, folder).filter(F.col("part") == "validation")
    users = materialize(rows.select(USER_KEY).distinct(), "validation-users")
    return users.filter(P.calibration_cut(users, CFG).member())


@check(
    "x6_positive_user_rows",
    "SELECT user_id, category_l1, label FROM labelled WHERE user_id IN (SELECT user_id FROM labelled WHERE label = 1)",
    "labelled",
)
def x6(spark, folder):
    rows = materialize(_labelled(spark, folder), "labelled")
    return P.positive_users_rows(rows).select(USER_KEY, CATEGORY, "label")


@check("j5_scaffold", "SELECT user_id, category_l1 FROM labelled", "labelled")
def j5(spark, folder):
    return P.scaffold(_pool(spark, folder).select(USER_KEY), CFG.categories)


@check(
    "j5_full_scaffold",
    """
SELECT user_id, category_l1 FROM (SELECT user_id FROM pool)
CROSS JOIN (SELECT DISTINCT category_l1 FROM clean)""",
    "pool",
)
def j5_full(spark, folder):
    events = stored_clean(spark, folder)
    return P.full_scaffold(_pool_of(events).select(USER_KEY), events)


@check("c5_labelled_scaffold", "SELECT user_id, split, category_l1, label FROM labelled", "labelled")
def c5(spark, folder):
    return _labelled(spark, folder)


@check("j3_attach_labels", "SELECT user_id, category_l1, label FROM labelled WHERE split = 'train'", "labelled")
def j3(spark, folder):
    events = stored_clean(spark, folder)
    train, _ = P.split_users(_pool_of(events), CFG)
    rows = P.scaffold(train.select(USER_KEY), CFG.categories)
    return P.attach_labels(rows, P.label_pairs(events, CFG))


@check(
    "p22_literal_label",
    "SELECT user_id, category_l1, CAST(1 AS INTEGER) AS label FROM pairs",
    "pairs",
)
def p22(spark, folder):
    return P.label_pairs(clean(spark, folder), CFG).withColumn("label", F.lit(1))


_RATE = """count(*) AS {rows}, CAST(sum(label) AS BIGINT) AS positives,
 round(sum(label) / CAST(count(*) AS DOUBLE) * 100, 2) AS positive_rate_pct"""


@check("a18_positive_rate", f"SELECT {_RATE.format(rows='rows')} FROM labelled WHERE split = 'train'", "labelled")
def a18(spark, folder):
    return P.positive_rate(_labelled(spark, folder).filter(F.col("split") == "train"))


@check(
    "a18_positive_rate_by_category",
    f"SELECT category_l1, {_RATE.format(rows='scaffold_rows')} FROM labelled GROUP BY category_l1",
    "labelled",
)
def a18_category(spark, folder):
    return P.positive_rate_by_category(_labelled(spark, folder))


@check(
    "a28_split_summary",
    """
SELECT part, count(DISTINCT user_id) AS users, count(*) AS rows, round(avg(label), 6) AS positive_rate
FROM parts GROUP BY part""",
    "parts",
)
def a28(spark, folder):
    return P.split_summary(labelled_parts(spark, folder), "part")


@check(
    "c9_select_categories",
    f"""
SELECT category_l1, {_RATE.format(rows='scaffold_rows')} FROM (
 SELECT s.category_l1, CAST(p.user_id IS NOT NULL AS INTEGER) AS label
 FROM (SELECT user_id, category_l1 FROM (SELECT user_id FROM splits WHERE split = 'train')
  CROSS JOIN (SELECT DISTINCT category_l1 FROM clean)) s
 LEFT JOIN pairs p ON p.user_id = s.user_id AND p.category_l1 = s.category_l1)
GROUP BY category_l1 HAVING sum(label) >= 45""",
    "splits pairs",
)
def c9(spark, folder):
    events = stored_clean(spark, folder)
    train, _ = P.split_users(_pool_of(events), CFG)
    return P.support_of_users(train, P.label_pairs(events, CFG), events, 45)

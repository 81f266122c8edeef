from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from helpers import day, random_events
from shoptrail.config import Settings
from shoptrail.operators import population as P
from shoptrail.operators.sampling import exact_cut, exact_sample
from shoptrail.session import materialize

CFG = Settings(categories=("a", "b"))


def _users(spark, n):
    return spark.range(1, n + 1).withColumnRenamed("id", "user_id")


def _brute(n_users, n, seed, salt):
    ordered = sorted(range(1, n_users + 1), key=lambda u: hashlib.md5(f"{seed}:{salt}:{u}".encode()).hexdigest())
    return set(ordered[:n])


@pytest.mark.parametrize("n", [0, 1, 7, 500, 4999, 5000, 9000])
def test_exact_sample_is_the_first_n_by_hash(spark, n):
    users = _users(spark, 5000)
    got = {r.user_id for r in exact_sample(users, n, 42, "t").collect()}
    assert got == _brute(5000, n, 42, "t")


def test_cut_walks_down_to_longer_prefixes(spark):
    cut = exact_cut(_users(spark, 20000), 777, 1, "deep")
    assert len(cut.prefix) > 3


def _ten_users(spark):
    rows = [(day("2019-10-10"), "view", u, "a") for u in range(1, 11)]
    rows += [(day("2019-11-02"), "purchase", 1, "a"), (day("2019-11-03"), "purchase", 2, "c")]
    return spark.createDataFrame(rows, "event_time timestamp_ntz, event_type string, user_id int, category_l1 string")


@pytest.mark.parametrize("ratio,size", [(3, 8), (5, 10)])
def test_pool_size_and_split(spark, ratio, size):
    events = _ten_users(spark)
    cfg = Settings(categories=("a", "b"), non_purchaser_ratio=ratio)
    flags = materialize(P.user_flags(events, cfg), "flags")
    pool = materialize(P.user_pool(flags, cfg), "pool")
    assert pool.count() == size
    assert {1, 2} <= {r.user_id for r in pool.collect()}
    train, test = P.split_users(pool, cfg)
    assert (train.count(), test.count()) == (int(0.8 * size), size - int(0.8 * size))
    assert P.overlapping_users(train, test).count() == 0


def test_scaffold_labels_only_bought_pairs(spark):
    events = _ten_users(spark)
    rows = P.labelled_scaffold(_users(spark, 10), P.label_pairs(events, CFG), CFG.categories)
    assert rows.count() == 20
    positive = rows.filter("label = 1").collect()
    assert [(r.user_id, r.category_l1) for r in positive] == [(1, "a")]  # "c" is not predicted
    assert P.positive_users_rows(rows).count() == 2
    assert P.positive_rate(rows).first().positive_rate_pct == 5.0
    assert [r.category_l1 for r in P.category_support(rows, 1).collect()] == ["a"]


def test_flags_agree_with_set_operations(spark):
    events = materialize(random_events(spark, 1000, 3), "events")
    cfg = Settings()
    flags = P.user_flags(events, cfg)
    left = {r.user_id for r in flags.filter("not purchaser").collect()}
    right = {r.user_id for r in P.non_purchasers(events, P.label_pairs(events, cfg)).collect()}
    assert left == right


def test_folds_keep_users_together(spark):
    rows = P.with_fold(P.scaffold(_users(spark, 200), CFG.categories), CFG)
    assert rows.groupBy("user_id").agg(F.count_distinct("fold").alias("n")).filter("n > 1").count() == 0
    assert rows.select("fold").distinct().count() == 5


@pytest.mark.parametrize("most", [10, 1], ids=["literal", "joined"])
def test_full_scaffold_has_every_pair_once(spark, most):
    rows = P.full_scaffold(_users(spark, 50), _ten_users(spark), most).collect()
    assert sorted((r.user_id, r.category_l1) for r in rows) == [(u, c) for u in range(1, 51) for c in "ac"]


def test_cold_share_of_sampled(spark):
    rows = [(day("2019-10-10"), "view", 1, "a"), (day("2019-11-02"), "purchase", 1, "a")]
    rows += [(day("2019-11-20"), "view", u, "a") for u in (2, 3)] + [(day("2019-10-20"), "view", 4, "a")]
    events = spark.createDataFrame(rows, "event_time timestamp_ntz, event_type string, user_id int, category_l1 string")
    pool = P.user_pool(materialize(P.user_flags(events, CFG), "flags"), CFG)
    row = P.sampled_cold_share(pool).first()
    assert (row.sampled, row.cold_sampled, row.cold_pct) == (3, 2, 66.7)

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import by_key, day, random_events, three_users
from shoptrail.config import Settings
from shoptrail.operators import behaviour as B
from shoptrail.operators import population as P
from shoptrail.plans.prepare import build_matrix
from shoptrail.session import materialize, tune

CFG = Settings()
PAIR = ("user_id", "category_l1")


def _groups(past):
    return (
        B.pair_window_counts(past, CFG),
        B.pair_recency(past, CFG),
        B.user_engagement(past, CFG),
        B.pair_brands(past, CFG),
        B.pair_prices(past, CFG),
    )


def test_full_history_counts(spark):
    past = B.history(three_users(spark), CFG)
    row = by_key(B.pair_counts(past, "30d"), *PAIR)[(1, "electronics")]
    assert (row["views_30d"], row["carts_30d"], row["purchases_30d"]) == (3, 0, 1)


def test_short_windows_leave_out_earlier_events(spark):
    past = B.history(three_users(spark), CFG)
    for suffix, start in CFG.windows[1:]:
        assert B.pair_counts(past, suffix, start).filter("user_id = 2").count() == 0


def test_window_start_is_inclusive_and_cutoff_exclusive(spark):
    rows = [(day("2019-10-25"), "view", 9, "kids", None, 1.0, "s"), (day("2019-11-01"), "view", 9, "kids", None, 1.0, "s")]
    events = spark.createDataFrame(rows, three_users(spark).schema)
    got = B.pair_counts(B.history(events, CFG), *CFG.windows[2]).collect()
    assert [r.views_7d for r in got] == [1]


def test_recency_counts_back_from_cutoff(spark):
    past = B.history(three_users(spark), CFG)
    row = by_key(B.pair_recency(past, CFG), *PAIR)[(1, "electronics")]
    assert (row["days_since_view"], row["days_since_cart"], row["days_since_purchase"]) == (2, None, 2)


def _labelled(spark, rows):
    return spark.createDataFrame(rows, "user_id int, category_l1 string, label int")


def test_cold_user_has_zero_counts_and_null_everything_else(spark):
    past = B.history(three_users(spark), CFG)
    row = B.assemble(_labelled(spark, [(3, "kids", 0)]), *_groups(past), CFG).first().asDict()
    assert all(row[c] == 0 for c in CFG.count_columns)
    assert all(row[c] is None for c in CFG.stored_features if c not in CFG.count_columns)


@pytest.mark.parametrize("fused", [False, True])
def test_expected_rows(spark, fused):
    events = three_users(spark)
    cfg = Settings(categories=("electronics", "apparel", "kids"))
    if fused:
        users = materialize(spark.createDataFrame([(1,), (2,)], "user_id int"), "users")
        matrix = B.feature_matrix(users, events, P.label_pairs(events, cfg), cfg)
    else:
        rows = _labelled(spark, [(1, "electronics", 0), (2, "apparel", 0), (1, "kids", 0)])
        matrix = B.assemble(rows, *_groups(B.history(events, cfg)), cfg)
    got = by_key(matrix, *PAIR)
    one, two, kids = got[(1, "electronics")], got[(2, "apparel")], got[(1, "kids")]
    totals = [f"total_{k}s_30d" for k in ("view", "cart", "purchase")]
    wide = [*totals, "active_days_30d", "category_breadth_30d", "session_count_30d"]
    assert [one[c] for c in wide] == [3, 0, 1, 3, 1, 2]
    assert (one["brand_count_30d"], one["avg_price_viewed_30d"], one["avg_price_carted_30d"]) == (1, 100.0, None)
    assert (one["cart_view_ratio_30d"], one["cart_view_ratio_7d"]) == (0.0, 0.0)
    assert (two["views_30d"], two["views_14d"], two["views_7d"], two["days_since_view"]) == (1, 0, 0, 27)
    assert (two["cart_view_ratio_30d"], two["cart_view_ratio_7d"]) == (0.0, None)
    assert [kids[c] for c in CFG.count_columns] == [0] * 9
    assert [kids[c] for c in wide] == [3, 0, 1, 3, 1, 2]
    assert kids["brand_count_30d"] is None and kids["cart_view_ratio_30d"] is None


@pytest.mark.parametrize("seed,hot", [(1, False), (2, True), (3, True)])
def test_fused_matrix_equals_single_groups(spark, seed, hot):
    """Also with one user holding a third of all events, and with the pool too big to broadcast."""
    events = materialize(random_events(spark, 1500, seed, hot), "events")
    pairs = P.label_pairs(events, CFG)
    users = materialize(events.select("user_id").distinct(), "users")
    labelled = P.labelled_scaffold(users, pairs, CFG.categories)
    single = B.assemble(labelled, *_groups(B.history(events, CFG)), CFG)
    want = sorted(map(str, single.collect()))
    for limit in (CFG.broadcast_rows, 0):
        fused = B.feature_matrix(users, events, pairs, Settings(broadcast_rows=limit))
        assert fused.columns == single.columns
        assert sorted(map(str, fused.collect())) == want


def test_later_events_do_not_leak(spark):
    events = materialize(random_events(spark, 1200, 5), "events")
    users = materialize(events.select("user_id").distinct(), "users")
    pairs = P.label_pairs(events, CFG)
    features = ["user_id", "category_l1", *CFG.stored_features]
    whole = B.feature_matrix(users, events, pairs, CFG).select(*features)
    early = B.feature_matrix(users, B.history(events, CFG), pairs, CFG).select(*features)
    assert sorted(map(str, whole.collect())) == sorted(map(str, early.collect()))


def test_matrix_has_one_row_per_user_and_category(spark):
    matrix = materialize(build_matrix(materialize(random_events(spark, 1500, 8), "events"), CFG), "matrix")
    n, keys = matrix.count(), matrix.select("user_id", "category_l1").distinct().count()
    assert n == keys == matrix.select("user_id").distinct().count() * len(CFG.categories)
    assert set(CFG.stored_features) <= set(matrix.columns) and len(CFG.numeric_features) == 24
    assert matrix.filter(F.col("label").isNull()).count() == 0


def test_tasks_after_a_shuffle_stay_small(spark):
    """Some 25 MB of shuffled rows are not merged into one task, whose memory would be a multiple of them."""
    own = tune(spark.newSession())
    own.conf.set("spark.sql.shuffle.partitions", "16")
    own.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    rows = own.range(300_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    assert rows.repartition("id").rdd.getNumPartitions() > 1

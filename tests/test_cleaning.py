from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shoptrail.config import Settings
from shoptrail.operators import cleaning, profiling
from shoptrail.plans.prepare import clean_events, clean_log
from shoptrail.session import fresh_path
from shoptrail.sources.events import read_csv_log, read_log, write_log

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"


def _line(second, kind, product, code, brand, price, user, session):
    at = datetime(2019, 10, 1) + timedelta(seconds=second)
    return f"{at:%Y-%m-%d %H:%M:%S} UTC,{kind},{product},7,{code},{brand},{price},{user},{session}"


LINES = [
    _line(1, "view", 10, "a.b.c", "acme", 5.0, 1, "s1"),
    _line(1, "view", 10, "a.b.c", "acme", 4.0, 1, "s1"),
    _line(3, "cart", 11, "", "acme", 6.0, 1, "s1"),
    _line(4, "purchase", 10, "a.b.c", "acme", 5.0, 1, ""),
    _line(5, "purchase", 12, "a.b", "", 7.0, 2, "s2"),
    _line(6, "view", 13, "", "beta", 8.0, 3, "s3"),
    _line(7, "purchase", 14, "x", "beta", 9.0, 3, "s3"),
]


def _csv(spark, tmp_path, name, lines):
    path = tmp_path / name
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


@pytest.fixture()
def raw(spark, tmp_path):
    files = [_csv(spark, tmp_path, "a.csv", LINES[:3]), _csv(spark, tmp_path, "b.csv", LINES[3:])]
    return read_csv_log(spark, files)


def test_csv_scan_types_and_empty_strings(raw):
    assert dict(raw.dtypes)["event_time"] == "timestamp_ntz"
    assert dict(raw.dtypes)["price"] == "float"
    assert raw.count() == 7
    assert raw.filter(F.col("brand").isNull()).count() == 1
    assert raw.filter(F.col("user_session").isNull()).count() == 1


def test_malformed_rows_and_headers_fail(spark, tmp_path):
    broken = _csv(spark, tmp_path, "c.csv", [LINES[0].replace("2019-10-01 00:00:01", "first of October")])
    with pytest.raises(Exception):
        read_csv_log(spark, broken).collect()
    wrong_number = _csv(spark, tmp_path, "d.csv", [LINES[0].replace(",10,", ",ten,")])
    with pytest.raises(Exception):
        read_csv_log(spark, wrong_number).collect()


@pytest.mark.parametrize("limit", [2_000_000, 0], ids=["broadcast", "shuffled"])
def test_cleaning_rules(raw, limit):
    got = clean_events(raw, Settings(broadcast_rows=limit)).orderBy("user_id").collect()
    assert [(r.user_id, r.price, r.category_l1) for r in got] == [(1, 4.0, "a"), (3, 9.0, "x")]
    levels = cleaning.add_category_levels(raw).filter("user_id = 3 and product_id = 14").first()
    assert levels.category_l2 is None


def test_lazy_and_staged_cleaning_agree(raw):
    lazy = clean_log(raw)
    staged = clean_events(raw, Settings())
    assert lazy.schema == staged.schema
    assert sorted(map(str, lazy.collect())) == sorted(map(str, staged.collect()))


def test_one_row_copied_many_times(spark, raw):
    copies = raw.filter("user_id = 3").crossJoin(spark.range(5000)).drop("id")
    kept = cleaning.drop_duplicates(copies.unionByName(raw)).filter("user_id = 3").count()
    assert kept == 2


def test_viewless_and_view_users_are_complements(raw):
    view = {r.user_id for r in cleaning.view_users(raw).collect()}
    viewless = {r.user_id for r in cleaning.viewless_users(raw).collect()}
    assert view == {1, 3} and viewless == {2}


def test_recovery_by_category_id(raw):
    first = cleaning.first_known_code(raw, "category_id").collect()
    assert [(r.category_id, r.category_code) for r in first] == [(7, "a.b.c")]
    filled = cleaning.backfill_category(raw, "category_id")
    assert filled.count() == 7 and filled.filter(F.col("category_code").isNull()).count() == 0
    report = cleaning.recovery_report(raw.withColumn("category_code", F.expr("nullif(category_code, 'x')")), "product_id")
    row = report.first()
    assert (row.total_null, row.recoverable, row.unrecoverable) == (1, 0, 1)


def test_parquet_round_trip(spark, raw):
    path = fresh_path(spark, "log")
    write_log(raw, path)
    again = read_log(spark, path)
    assert again.schema == raw.schema
    assert sorted(map(str, again.collect())) == sorted(map(str, raw.collect()))


def test_profile_counts_null_as_a_value(raw):
    row = profiling.distinct_counts(raw, {"brands": "brand", "users": "user_id"}).first()
    assert (row.brands, row.users) == (3, 3)
    report = profiling.profile_report(raw).first()
    assert (report.total_rows, report.null_category_code, report.duplicates) == (7, 2, 1)


def test_funnel_and_daily(raw):
    funnel = {r.event_type: r for r in profiling.conversion_funnel(raw).collect()}
    assert funnel["view"].pct_of_view_events == 100.0
    assert funnel["purchase"].pct_of_view_users == 150.0
    daily = profiling.daily_counts(raw).collect()
    assert [(r["view"], r["cart"], r["purchase"]) for r in daily] == [(3, 1, 3)]
    assert [r.user_id for r in profiling.purchase_only_users(raw).collect()] == [2]


def test_missing_types_are_no_views(spark):
    """A user whose types are all missing has no view; the lazy and the staged form agree."""
    from datetime import datetime

    from shoptrail.operators.population import user_flags
    from shoptrail.operators.profiling import purchase_only_users
    from shoptrail.operators.sampling import exact_cut
    from shoptrail.plans.prepare import clean_log

    at = datetime(2019, 10, 2)
    columns = ("event_time timestamp_ntz, event_type string, product_id bigint, category_id bigint, category_code string, "
               "brand string, price double, user_id bigint, user_session string")
    rows = [(at, "view", 1, 1, "a.b", "x", 1.0, 1, "s"), (at, None, 1, 1, "a.b", "x", 1.0, 2, "s"),
            (at, "view", 1, 1, "a.b", "x", 1.0, None, "s"), (at, "purchase", 1, 1, "a.b", "x", 1.0, 3, "s")]
    log = spark.createDataFrame(rows, columns)
    for form in (clean_log(log), clean_events(log, Settings())):
        assert [r.user_id for r in form.collect() if r.user_id is not None] == [1]
    flags = {r.user_id: r.purchaser for r in user_flags(log, Settings()).collect()}
    assert flags[2] is False
    assert [r.user_id for r in purchase_only_users(log).collect()] == [3]
    users = log.select("user_id").distinct()
    assert users.filter(exact_cut(users, 2, 1, "t").member()).count() == 2

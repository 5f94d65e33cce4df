"""Stored sets of users against the events."""

from datetime import date, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import DAY, plan_of, rows
from tidemark.functions.scalars import during_days
from tidemark.operators import user_sets
from tidemark.sources.user_set_tables import read_days, store_days

FIRST, LAST = date(2024, 1, 22), date(2024, 1, 29)


def exact(events, *by):
    return rows(during_days(events, FIRST, LAST).groupBy(*by).agg(
        F.count_distinct("user_id").alias("users")), *by)


def test_bitmaps_count_exactly_over_days_and_segments(feed):
    bitmaps = user_sets.daily_bitmaps(feed)
    for by in ((), ("os",), ("os", "source", "country")):
        assert rows(user_sets.bitmap_users(bitmaps, FIRST, LAST, by), *by) == exact(feed, *by)


def test_ids_of_many_buckets(make_feed):
    ids = [0, 1, 32767, 32768, 32769, 10 ** 12, 10 ** 12 + 1, 2 ** 62]
    feed = make_feed([dict(user_id=i, time=DAY - timedelta(days=d)) for i in ids for d in range(3)])
    bitmaps = user_sets.daily_bitmaps(feed, ())
    assert rows(user_sets.bitmap_users(bitmaps, date(2024, 1, 1), LAST)) == [dict(users=len(ids))]
    with pytest.raises(PySparkException, match="negative user id"):
        user_sets.daily_bitmaps(make_feed([dict(user_id=-1)])).collect()


def test_no_rows_mean_no_users(make_feed):
    bitmaps = user_sets.daily_bitmaps(make_feed([dict(user_id=None)]))
    assert rows(user_sets.bitmap_users(bitmaps, FIRST, LAST)) == [dict(users=0)]
    theta = user_sets.daily_theta(make_feed([dict(user_id=4)]))
    later = date(2024, 3, 1)
    found = rows(user_sets.sketched_overlap(theta, theta, later, later))[0]
    assert found["all_unique_users"] == found["both_func_users"] == 0


def test_rolling_windows(make_feed):
    feed = make_feed([dict(user_id=u, time=DAY + timedelta(days=d, hours=1))
                      for u, d in ((1, 0), (1, 1), (2, 1), (3, 4), (1, 9))])
    found = rows(user_sets.rolling_users(user_sets.daily_bitmaps(feed, ()), 3), "date")
    day = DAY.date()
    wanted = {0: 1, 1: 2, 2: 2, 3: 2, 4: 1, 5: 1, 6: 1, 9: 1}
    assert {(r["date"] - day).days: r["users"] for r in found} == wanted


def test_sketches_err_within_their_bound(spark):
    """100,000 users, half of them on both days."""
    feed = spark.range(150_000).selectExpr(
        "id % 100000 as user_id", "timestamp '2024-01-22' + make_interval(0, 0, 0, id div 100000) as time",
        "if(id % 4 = 0, 'iOS', 'Android') as os")
    sketches = user_sets.daily_sketches(feed, ("os",))
    found = {r["os"]: r["users"] for r in user_sets.sketched_users(
        sketches, FIRST, LAST, ("os",)).collect()}
    bound = 4 * user_sets.sketch_error()
    assert found["iOS"] == pytest.approx(25_000, rel=bound)
    assert found["Android"] == pytest.approx(75_000, rel=bound)
    both = user_sets.sketched_users(sketches, FIRST, LAST).first()[0]
    assert both == pytest.approx(100_000, rel=bound) and abs(bound - 0.052) < 0.001


def test_overlap_of_sketches(spark, feed, messages):
    sides = [user_sets.daily_theta(events) for events in (feed, messages)]
    found = rows(user_sets.sketched_overlap(*sides, FIRST, LAST))[0]
    f, m = [{r[0] for r in during_days(e, FIRST, LAST).select("user_id").distinct().collect()}
            for e in (feed, messages)]
    assert [found[c] for c in ("purely_feed_users", "purely_messenger_users", "both_func_users",
                               "all_unique_users")] == [len(f - m), len(m - f), len(f & m), len(f | m)]
    large = [spark.range(a, b).selectExpr("id as user_id", "timestamp '2024-01-22' as time")
             for a, b in ((0, 60_000), (40_000, 120_000))]
    found = rows(user_sets.sketched_overlap(*map(user_sets.daily_theta, large), FIRST, LAST))[0]
    slack = 4 * 120_000 / 2 ** (user_sets.LG_ENTRIES / 2)
    for name, wanted in (("purely_feed_users", 40_000), ("both_func_users", 20_000),
                         ("purely_messenger_users", 60_000), ("all_unique_users", 120_000)):
        assert abs(found[name] - wanted) < slack


def test_stored_days_are_replaced_alone(spark, make_feed, tmp_path):
    path = str(tmp_path / "sets")
    feed = make_feed([dict(user_id=u, time=DAY + timedelta(days=d)) for u in range(5) for d in range(3)])
    store_days(user_sets.daily_bitmaps(feed), path)
    store_days(user_sets.daily_bitmaps(make_feed([dict(user_id=9)])), path)
    days = {r["date"]: r["users"] for r in user_sets.rolling_users(read_days(spark, path), 1).collect()}
    assert days == {DAY.date(): 1, (DAY + timedelta(days=1)).date(): 5, (DAY + timedelta(days=2)).date(): 5}
    some = read_days(spark, path, DAY.date(), DAY.date())
    assert "PartitionFilters: [isnotnull(date" in plan_of(some)
    assert user_sets.unite([some, some]).count() == 2


def test_tasks_send_sets_not_events(feed):
    for sets in (user_sets.daily_bitmaps(feed), user_sets.daily_sketches(feed),
                 user_sets.daily_theta(feed)):
        lines = plan_of(sets).splitlines()
        at = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
        assert any("partial_" in line for line in lines[at + 1:at + 4])

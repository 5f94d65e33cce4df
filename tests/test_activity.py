import pandas as pd

from conftest import plan_of, rows
from tidemark.functions.clock import AsOf
from tidemark.operators import activity
from tidemark.plans.daily_cube import daily_cube

KEYS = ["user_id", "os", "gender", "age"]


def test_received_counts_distinct_senders(make_messages):
    messages = make_messages([dict(user_id=1, reciever_id=9), dict(user_id=1, reciever_id=9),
                              dict(user_id=2, reciever_id=9)])
    assert rows(activity.received_per_user(messages)) == [
        dict(user_id=9, messages_received=3, users_received=2)]


def test_message_stats_keep_users_of_one_side(make_messages):
    messages = make_messages([dict(user_id=1, reciever_id=9)])
    sender, recipient = rows(activity.user_message_stats(messages), "user_id")
    assert (sender["messages_sent"], sender["messages_received"]) == (1, 0)
    assert (recipient["messages_sent"], recipient["messages_received"]) == (0, 1)
    assert recipient["os"] is None


def test_activity_equals_the_four_key_join(feed, messages):
    direct = activity.user_activity(feed, messages)
    joined = activity.user_feed_stats(feed).join(activity.user_message_stats(messages), KEYS)
    assert rows(direct, *KEYS) == rows(joined.select(*direct.columns), *KEYS)


def test_recipients_who_never_send_and_changed_demographics_drop_out(make_feed, make_messages):
    feed = make_feed([dict(user_id=1), dict(user_id=2), dict(user_id=3, os="Android")])
    messages = make_messages([dict(user_id=1, reciever_id=2), dict(user_id=3, reciever_id=1)])
    found = rows(activity.user_activity(feed, messages))
    assert [(r["user_id"], r["messages_received"]) for r in found] == [(1, 1)]


def test_roll_up_equals_pandas(feed, messages):
    users = activity.user_activity(feed, messages)
    expected = []
    frame = users.toPandas()
    for dimension in activity.DEMOGRAPHICS:
        sums = frame.groupby(dimension)[list(activity.MEASURES)].sum().reset_index()
        sums.insert(0, "dimension", dimension)
        expected.append(sums.rename(columns={dimension: "dimension_value"}))
    expected = pd.concat(expected)
    ours = activity.roll_up(users).toPandas()
    key = ["dimension", "dimension_value"]
    pd.testing.assert_frame_equal(ours.sort_values(key).reset_index(drop=True),
                                  expected.sort_values(key).reset_index(drop=True),
                                  check_dtype=False)


def test_cube_totals_agree_between_dimensions(feed, messages):
    totals = daily_cube(feed, messages, "2024-01-30 23:07:00").toPandas().groupby(
        "dimension")[list(activity.MEASURES)].sum()
    assert len(totals) == 3 and (totals.nunique() == 1).all()


def test_roll_up_leaves_out_unknown_values(make_feed, make_messages):
    feed = make_feed([dict(user_id=1)])
    users = activity.user_activity(feed, make_messages([dict(user_id=1, reciever_id=1)]))
    unknown = users.selectExpr("user_id", "cast(null as string) os", "gender", "age",
                               *activity.MEASURES)
    found = rows(activity.roll_up(users.unionByName(unknown)), "dimension")
    assert [(r["dimension"], r["views"]) for r in found] == [
        ("age", 2), ("gender", 2), ("os", 1)]


def test_cube_day_scope_reads_one_day(make_feed, make_messages):
    old = dict(time=AsOf.of("2024-01-20 10:00:00").moment)
    feed = make_feed([dict(user_id=1), dict(user_id=1, **old)])
    messages = make_messages([dict(user_id=1, reciever_id=1)])
    by_scope = {scope: rows(daily_cube(feed, messages, "2024-01-30", scope), "dimension")[0]
                for scope in ("all", "day")}
    assert (by_scope["all"]["views"], by_scope["day"]["views"]) == (2, 1)


def test_sketched_counts_are_close(feed, messages):
    exact = rows(activity.user_activity(feed, messages), "user_id")
    sketched = rows(activity.user_activity(feed, messages, exact=False), "user_id")
    for name in ("users_received", "users_sent"):
        assert all(abs(e[name] - s[name]) <= 1 for e, s in zip(exact, sketched))
    assert [e["messages_sent"] for e in exact] == [s["messages_sent"] for s in sketched]


def test_cube_join_reuses_the_partitioning_of_its_sides(spark, feed, messages):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, -1)
    try:
        plan = plan_of(activity.user_activity(feed, messages))
    finally:
        spark.conf.set(limit, before)
    # feed 1, sent 2, received 2, and the per-user rows once for the second join.
    assert plan.count("Exchange hashpartitioning") == 6

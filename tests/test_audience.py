from datetime import date, datetime

from conftest import plan_of, rows
from tidemark.operators import audience, segments
from tidemark.plans.audience_report import audience_report
from tidemark.plans.feed_report import feed_daily, feed_latest_message, feed_week_head

DAY = date(2024, 1, 29)


def test_overlap_equals_the_three_joins(feed, messages):
    overlap = rows(audience.user_overlap(feed, messages, DAY))[0]
    for operator, name in zip((audience.feed_only_users, audience.messenger_only_users,
                               audience.both_users), audience.CLASSES):
        assert rows(operator(feed, messages, DAY)) == [{"date": DAY, name: overlap[name]}]
    seen = {r.user_id for t in (feed, messages)
            for r in audience.active_users(t, DAY).collect()}
    assert overlap["all_unique_users"] == len(seen)


def test_empty_class_counts_zero(make_feed, make_messages):
    overlap = rows(audience.user_overlap(
        make_feed([dict(user_id=1)]), make_messages([dict(user_id=1, reciever_id=2)]), DAY))
    assert [overlap[0][c] for c in audience.CLASSES] == [0, 0, 1]


def test_days_are_half_open(make_feed):
    feed = make_feed([dict(user_id=1, time=datetime(2024, 1, 29)),
                      dict(user_id=2, time=datetime(2024, 1, 30)),
                      dict(user_id=3, time=datetime(2024, 1, 29, 23, 59, 59, 999999))])
    assert {r.user_id for r in audience.active_users(feed, DAY).collect()} == {1, 3}


def test_age_bands(make_feed):
    ages = {17: "<18", 18: "18-30", 30: "18-30", 31: "30-45", 45: "30-45", 46: "45+", None: "45+"}
    feed = make_feed([dict(user_id=i, age=a, country=f"c{i}") for i, a in enumerate(ages)])
    found = segments.feed_segments(feed, DAY, DAY).collect()
    assert {r.country: r.age_groups for r in found} == {
        f"c{i}": band for i, band in enumerate(ages.values())}


def test_means_are_unweighted(make_feed, make_messages):
    feed = make_feed([dict(user_id=1, country="a")] * 4 + [dict(user_id=2, country="b")] * 2
                     + [dict(user_id=3, country="b")])
    messages = make_messages([dict(user_id=i, reciever_id=9, country=c)
                              for i, c in ((1, "a"), (2, "b"))])
    means = rows(segments.per_user_daily_means(
        segments.segment_daily(feed, messages, DAY, DAY)))
    assert means[0]["views_per_user"] == (4 + 1.5) / 2


def test_segments_of_one_product(make_feed, make_messages):
    feed = make_feed([dict(user_id=1, country="a")])
    messages = make_messages([dict(user_id=1, reciever_id=9, country="b")])
    assert segments.segment_daily(feed, messages, DAY, DAY).count() == 0
    both = rows(segments.segment_daily(feed, messages, DAY, DAY, how="full"), "country")
    assert [(r["country"], r["messages"], r["views"]) for r in both] == [
        ("a", 0, 1), ("b", 1, 0)]


def test_pivots_equal_pandas(feed):
    users = segments.source_os_users(feed, DAY)
    frame = users.toPandas()
    for column, values in (("source", ("ads", "organic")), ("os", ("iOS", "Android"))):
        expected = frame.pivot_table(index="date", columns=column, values="users",
                                     aggfunc="sum").iloc[0].to_dict()
        found = rows(segments.pivot_users(users, column, values))[0]
        assert {v: found[v] for v in values} == expected
        assert found["other"] == 0 and found["total"] == sum(expected.values())


def test_pivots_lose_no_value(make_feed, messages):
    days = [dict(user_id=u, source=s, time=datetime(2024, 1, 29, 3)) for u, s in
            enumerate(["ads"] * 10 + ["organic"] * 10 + ["referral"] * 70 + [None] * 10)]
    feed = make_feed(days)
    found = rows(segments.pivot_users(segments.source_os_users(feed, DAY), "source",
                                      ("ads", "organic")))[0]
    assert {k: found[k] for k in ("ads", "organic", "other", "total")} == {
        "ads": 10, "organic": 10, "other": 80, "total": 100}
    text = rows(audience_report(feed, messages, "2024-01-30 11:00:00").summary)[0]["message"]
    assert "    Organic: 10.0%\n    Ads: 10.0%" in text


def test_report_text_matches_its_frames(feed, messages):
    report = audience_report(feed, messages, "2024-01-30 23:07:00")
    overlap, text = rows(report.overlap)[0], rows(report.summary)[0]["message"].splitlines()
    assert text[2] == f"Unique users: {overlap['all_unique_users']}"
    assert text[3].startswith(f"    Feed-only: {overlap['purely_feed_users']} / ")
    last = rows(report.totals, "date")[-1]
    assert text[6] == f"Messages: {last['messages']}"


def test_latest_message_looks_like_a_printed_row(feed):
    daily = feed_daily(feed, "2024-01-30 23:07:00")
    frame = daily.toPandas().sort_values("Date")
    frame["Date"] = frame["Date"].astype("datetime64[ns]")
    assert rows(feed_latest_message(daily))[0]["message"] == frame.iloc[-1].to_string()
    assert [r.Date.day for r in feed_week_head(daily).collect()] == list(range(22, 29))


def test_zero_views_have_no_ctr(make_feed):
    daily = feed_daily(make_feed([dict(user_id=1, action="like")]), "2024-01-30")
    assert rows(daily)[0]["CTR"] is None
    assert rows(feed_latest_message(daily))[0]["message"].endswith("NaN")


def test_anti_joins_are_plain_equi_joins(feed, messages):
    for operator in (audience.feed_only_users, audience.messenger_only_users):
        plan = plan_of(operator(feed, messages, DAY))
        assert "LeftAnti" in plan
        assert "NestedLoop" not in plan and "isnull" not in plan.lower().replace("isnotnull", "")


def test_day_filters_reach_both_scans(feed, messages):
    plan = plan_of(segments.segment_daily(feed, messages, date(2024, 1, 22), DAY))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    assert all("2024-01-22" in s and "2024-01-30" in s for s in scans)

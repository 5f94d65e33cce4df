import time
from datetime import datetime, timedelta

import pytest

from conftest import DATA, plan_of, rows
from tidemark.operators.intervals import interval_metrics
from tidemark.plans.alerts import DAY_SERIES, banded_metrics, with_message
from tidemark.sources.derived_events import feed_from_events, messages_from_events
from tidemark.sources.shared_folder import new_path
from tidemark.streaming.intervals import (dropped_rows, interval_stream, read_alerts,
                                          read_intervals, repair_day, start_alerts,
                                          write_intervals)

AS_OF = "2024-01-30 23:07:00"
DAY = datetime(2024, 1, 30).date()


@pytest.fixture
def event_stream(spark, events):
    """The events in several files, one per two hours of data, oldest first."""
    def build(hours=None, **options):
        if hours is None:
            source, pattern = DATA, "events.parquet"
        else:
            source, pattern = new_path(spark, "events"), "*.parquet"
            times = [r.ts for r in events.select("ts").orderBy("ts").collect()]
            step = timedelta(hours=hours)
            start = datetime(2024, 1, 28)
            while start <= times[-1]:
                (events.where(events.ts.between(start, start + step - timedelta(microseconds=1)))
                 .coalesce(1).write.mode("append").parquet(source))
                start += step
        stream = (spark.readStream.schema(events.schema).option("pathGlobFilter", pattern)
                  .options(**options).parquet(source))
        return feed_from_events(stream), messages_from_events(stream)
    return build


def run(spark, stream):
    target = new_path(spark, "intervals")
    write_intervals(stream, target, new_path(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


def test_stream_equals_batch(spark, event_stream, feed, messages):
    streamed = run(spark, interval_stream(*event_stream()))
    until = streamed.where(f"date = '{DAY}' AND time < '2024-01-30 23:00:00'")
    assert rows(until, "time") == rows(interval_metrics(feed, messages, AS_OF), "time")


def test_batches_give_the_same_intervals(spark, event_stream):
    whole = run(spark, interval_stream(*event_stream())).where("date > '2024-01-28'")
    parts = run(spark, interval_stream(*event_stream(hours=6, maxFilesPerTrigger=1))
                ).where("date > '2024-01-28'")
    assert rows(parts, "time") == rows(whole, "time")


def test_sketched_users_are_close(spark, event_stream):
    exact = rows(run(spark, interval_stream(*event_stream())), "time")
    sketched = rows(run(spark, interval_stream(*event_stream(), exact=False)), "time")
    assert [r["time"] for r in exact] == [r["time"] for r in sketched]
    for name in ("feed_users", "messenger_users"):
        off = [abs(e[name] - s[name]) for e, s in zip(exact, sketched)]
        assert max(off) <= 1 and sum(off) <= 0.02 * sum(e[name] for e in exact)


def test_same_plan_runs_in_batch(feed, messages):
    late = rows(interval_stream(feed, messages).where(f"date = '{DAY}'"), "time")
    assert late[:53] == rows(interval_metrics(feed, messages, AS_OF), "time")


def test_alerts_follow_the_batch_band(spark, event_stream):
    intervals, alerts = new_path(spark, "intervals"), new_path(spark, "alerts")
    stream = interval_stream(*event_stream(hours=12, maxFilesPerTrigger=1))
    start_alerts(stream, intervals, alerts, new_path(spark, "checkpoint")).awaitTermination()
    metrics = read_intervals(spark, intervals, stream.schema)
    expected = banded_metrics(metrics, key=DAY_SERIES).where("is_alert")
    found = read_alerts(spark, alerts)
    key = ("metric", "date", "interval")
    assert found.count() > 0
    assert (sorted(map(str, found.select(*key).collect()))
            == sorted(map(str, expected.select(*key).collect())))


def alert_rows(df):
    return sorted(map(str, df.select("metric", "date", "interval", "message").collect()))


def test_new_checkpoint_leaves_no_double_points(spark, event_stream):
    intervals, alerts = new_path(spark, "intervals"), new_path(spark, "alerts")
    found = []
    for hours in (12, 6):
        stream = interval_stream(*event_stream(hours=hours, maxFilesPerTrigger=1))
        start_alerts(stream, intervals, alerts, new_path(spark, "checkpoint")).awaitTermination()
        table = read_intervals(spark, intervals, stream.schema)
        assert table.count() == table.select("time").distinct().count()
        found.append((table.count(), alert_rows(read_alerts(spark, alerts))))
    assert found[0] == found[1] and found[0][1]


def test_late_days_are_reported_and_repaired(spark, event_stream, feed, messages, events):
    """Files newest first: the watermark drops the older days."""
    source = new_path(spark, "events")
    for day in (30, 29, 28):
        (events.where(f"to_date(ts) = '2024-01-{day}'").coalesce(1)
         .write.mode("append").parquet(source))
        time.sleep(0.05)  # files are taken by age
    stream = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
              .parquet(source))
    metrics = interval_stream(feed_from_events(stream), messages_from_events(stream))
    intervals, alerts = new_path(spark, "intervals"), new_path(spark, "alerts")
    query = start_alerts(metrics, intervals, alerts, new_path(spark, "checkpoint"))
    query.awaitTermination()
    assert dropped_rows(query) > 0
    days = [datetime(2024, 1, d).date() for d in (28, 29, 30)]
    for _ in range(2):
        for day in days:
            repair_day(feed, messages, day, intervals, alerts)
        batch = interval_stream(feed, messages).where("date >= '2024-01-28'")
        repaired = read_intervals(spark, intervals, metrics.schema)
        assert rows(repaired, "time") == rows(batch, "time")
        expected = with_message(banded_metrics(batch)).where("is_alert")
        assert alert_rows(read_alerts(spark, alerts)) == alert_rows(expected)


def test_no_stream_join(feed, messages):
    assert "Join" not in plan_of(interval_stream(feed, messages))

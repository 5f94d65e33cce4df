"""Late rows of a stream: which are diverted, and that their days end as in a batch run."""

import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.plans.alerts import banded_metrics, with_message
from tidemark.sources.derived_events import feed_from_events, messages_from_events
from tidemark.sources.shared_folder import new_path
from tidemark.streaming.intervals import interval_stream, read_alerts, read_intervals
from tidemark.streaming.late_rows import (SOURCE_OPTIONS, divert_late, late_rows, repair_late,
                                          run_in_any_order)


@pytest.fixture
def files(spark, events):
    """A folder of event files in a given order, and streams over it."""
    class Files:
        source = new_path(spark, "events")

        def add(self, *conditions):
            for condition in conditions:
                events.where(condition).coalesce(1).write.mode("append").parquet(self.source)
                time.sleep(0.05)  # files are taken by age

        def streams(self):
            stream = spark.readStream.schema(events.schema).options(**SOURCE_OPTIONS).parquet(self.source)
            return feed_from_events(stream), messages_from_events(stream)

        def tables(self):
            table = spark.read.schema(events.schema).parquet(self.source)
            return feed_from_events(table), messages_from_events(table)
    return Files()


def on(day, hours="true"):
    return f"to_date(ts) = '2024-01-{day}' and {hours}"


def alerts_of(df):
    return sorted(map(str, df.select("metric", "date", "interval", "message").collect()))


def end_as_batch(spark, files, target, until):
    feed, messages = files.tables()
    batch = interval_stream(feed, messages).where(f"date <= '{until}'")
    table = read_intervals(spark, f"{target}/intervals", batch.schema).where(f"date <= '{until}'")
    assert rows(table, "time") == rows(batch, "time")
    expected = with_message(banded_metrics(batch)).where("is_alert")
    found = read_alerts(spark, f"{target}/alerts").where(f"date <= '{until}'")
    assert alerts_of(found) == alerts_of(expected)


def test_rows_behind_the_watermark_are_diverted_whole(spark, files, events):
    files.add(on(29, "hour(ts) < 12"), on(28), on(29, "hour(ts) >= 12"))
    path = new_path(spark, "late")
    divert_late(*files.streams(), path, new_path(spark, "checkpoint")).awaitTermination()
    late = late_rows(spark, path)
    assert late.count() == events.where(on(28)).count()
    assert {r[0] for r in late.select(F.to_date("time").cast("string")).collect()} == {"2024-01-28"}
    assert late.where("time + interval 15 minutes > late_behind + interval 15 minutes").isEmpty()


def test_ordered_files_name_no_day(spark, files):
    files.add(on(28), on(29), on(30))
    target = new_path(spark, "ordered")
    assert run_in_any_order(files.streams(), files.tables(), target) == []
    end_as_batch(spark, files, target, "2024-01-29")


def test_disordered_files_end_as_a_batch_run(spark, files):
    files.add(on(28, "hour(ts) < 6"), on(29, "minute(ts) < 40"), on(28, "hour(ts) >= 6"),
              on(30), on(29, "minute(ts) >= 40"))
    target = new_path(spark, "disordered")
    days = run_in_any_order(files.streams(), files.tables(), target)
    assert [d.day for d in days] == [28, 29]
    end_as_batch(spark, files, target, "2024-01-29")
    # Nothing is left to repair, and later files go on from here.
    feed, messages = files.tables()
    late, intervals, alerts = (f"{target}/{n}" for n in ("late", "intervals", "alerts"))
    assert repair_late(feed, messages, late, intervals, alerts) == []
    files.add(on(27))
    assert [d.day for d in run_in_any_order(files.streams(), files.tables(), target)] == [27]
    end_as_batch(spark, files, target, "2024-01-29")

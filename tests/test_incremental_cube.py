"""The cube from stored parts: what is read, and that it equals the cube of the whole tables."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import DAY, rows
from tidemark.plans import incremental_cube
from tidemark.plans.daily_cube import daily_cube
from tidemark.plans.incremental_cube import (cube_from_parts, refresh_cube_parts,
                                             run_incremental_cube)
from tidemark.sources import day_folders
from tidemark.sources.event_tables import feed_actions, message_actions, write_by_day
from tidemark.sources.fact_table import read_daily_activity
from tidemark.sources.shared_folder import new_path

AS_OF = "2024-01-30 23:07:00"
DIMENSIONS = ("dimension", "dimension_value")


@pytest.fixture
def paths(spark):
    return [new_path(spark, name) for name in ("feed", "messages", "parts")]


def cubes(spark, paths):
    whole = daily_cube(feed_actions(spark, path=paths[0]), message_actions(spark, path=paths[1]), AS_OF)
    return (rows(cube_from_parts(spark, paths[2], AS_OF), *DIMENSIONS), rows(whole, *DIMENSIONS))


def days(first, last):
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def test_runs_read_new_and_changed_days_only(spark, feed, messages, paths, monkeypatch):
    day = F.to_date("time")
    first, late, last = date(2024, 1, 1), date(2024, 1, 4), date(2024, 1, 6)
    for events, path in ((feed, paths[0]), (messages, paths[1])):
        write_by_day(events.where((day <= F.lit(last)) & ((day != F.lit(late)) | (F.hour("time") < 9))),
                     path)
    seen = refresh_cube_parts(spark, *paths)
    assert seen == {"feed": days(first, last), "messages": days(first, last)}
    ours, whole = cubes(spark, paths)
    assert ours == whole and ours

    assert refresh_cube_parts(spark, *paths) == {"feed": [], "messages": []}

    write_by_day(feed.where(day == F.lit(late)), paths[0], "days")
    write_by_day(feed.where(day.between(F.lit(date(2024, 1, 7)), F.lit(date(2024, 1, 8)))),
                 paths[0], "append")
    write_by_day(messages.where((day == F.lit(first)) & (F.hour("time") == 3)), paths[1], "append")
    read = []
    monkeypatch.setattr(incremental_cube, "feed_parts", lambda events: read.extend(
        r[0] for r in events.select("event_date").distinct().collect()) or reduce_feed(events))
    reduce_feed = _feed_parts
    seen = refresh_cube_parts(spark, *paths)
    assert seen == {"feed": [late, date(2024, 1, 7), date(2024, 1, 8)], "messages": [first]}
    assert sorted(read) == seen["feed"]
    ours, whole = cubes(spark, paths)
    assert ours == whole


_feed_parts = incremental_cube.feed_parts


def test_days_that_are_gone_leave_the_cube(spark, make_feed, make_messages, tmp_path):
    feed_path, messages_path, parts = (str(tmp_path / n) for n in ("feed", "messages", "parts"))
    second = DAY - timedelta(days=1)
    feed = make_feed([dict(user_id=1, action="like"), dict(user_id=1, time=second)])
    messages = make_messages([dict(user_id=1, reciever_id=2), dict(user_id=1, reciever_id=2, time=second),
                              dict(user_id=2, reciever_id=1), dict(user_id=1, reciever_id=None)])
    write_by_day(feed, feed_path)
    write_by_day(messages, messages_path)
    refresh_cube_parts(spark, feed_path, messages_path, parts)
    paths = [feed_path, messages_path, parts]
    ours, whole = cubes(spark, paths)
    assert ours == whole and ours[0]["views"] == ours[0]["likes"] == 1
    write_by_day(feed.where("action = 'like'"), feed_path)  # one day only
    assert refresh_cube_parts(spark, *paths)["feed"] == [DAY.date()]
    ours, whole = cubes(spark, paths)
    assert ours == whole and ours[0]["views"] == 0


def test_a_run_cut_short_is_repaired_by_the_next(spark, make_feed, make_messages, tmp_path, monkeypatch):
    paths = [str(tmp_path / n) for n in ("feed", "messages", "parts")]
    write_by_day(make_feed([dict(user_id=1)]), paths[0])
    write_by_day(make_messages([dict(user_id=1, reciever_id=1)]), paths[1])

    def lost(*_):
        raise RuntimeError("lost")
    monkeypatch.setattr(incremental_cube, "remember_files", lost)
    with pytest.raises(RuntimeError):
        refresh_cube_parts(spark, *paths)
    monkeypatch.undo()
    assert refresh_cube_parts(spark, *paths) == {"feed": [DAY.date()], "messages": [DAY.date()]}
    ours, whole = cubes(spark, paths)
    assert ours == whole and ours[0]["views"] == 1


def test_the_run_loads_the_fact_table(spark, make_feed, make_messages, tmp_path):
    paths = [str(tmp_path / n) for n in ("feed", "messages", "parts")]
    write_by_day(make_feed([dict(user_id=1)]), paths[0])
    write_by_day(make_messages([dict(user_id=1, reciever_id=1)]), paths[1])
    for _ in range(2):
        run_incremental_cube(spark, *paths, AS_OF, "cube_of_parts", str(tmp_path / "facts"))
    assert read_daily_activity(spark, "cube_of_parts").count() == 3


def test_tables_must_be_laid_out_by_day(spark, make_feed, tmp_path):
    make_feed([dict(user_id=1)]).write.parquet(str(tmp_path / "flat"))
    with pytest.raises(ValueError):
        day_folders.day_files(spark, str(tmp_path / "flat"), incremental_cube.FEED_ACTIONS)


def test_only_the_folders_of_changed_days_are_opened(spark, feed, tmp_path):
    path = str(tmp_path / "feed")
    write_by_day(feed, path)
    events = feed_actions(spark, path=path).where(F.col("event_date").isin([date(2024, 1, 3)]))
    plan = incremental_cube.feed_parts(events)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-03" in plan

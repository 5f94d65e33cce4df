"""Tables laid out by user: what is shuffled and which row groups are read."""

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from tidemark.operators import activity
from tidemark.sources.clustered_tables import (CO_PARTITION, user_rows, write_bucketed,
                                               write_clustered)


def test_activity_of_bucketed_tables_moves_no_events(spark, feed, messages):
    names = [f"bucketed_{uuid.uuid4().hex}" for _ in range(3)]
    for events, column, name in zip((feed, messages, messages), ("user_id", "user_id", "reciever_id"),
                                    names):
        write_bucketed(events, name, column, 4)
    tables = [spark.table(n) for n in names]
    spark.conf.set(CO_PARTITION, "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = activity.user_activity(tables[0], tables[1], received_from=tables[2])
        plan = plan_of(found)
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
        assert "Bucketed: true" in plan
        key = ("user_id", "os")
        assert rows(found, *key) == rows(activity.user_activity(feed, messages), *key)
    finally:
        spark.conf.unset(CO_PARTITION)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def read_by_scan(df):
    """Rows that left the scan: those of the row groups that were opened."""
    execution = df._jdf.queryExecution()
    df._jdf.sparkSession().sharedState()
    execution.executedPlan().executeCollect()
    leaves = execution.executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture(scope="module")
def laid_out(spark, tmp_path_factory):
    """200,000 events of 2,000 users in two days, in row groups of some thousand rows."""
    path = str(tmp_path_factory.mktemp("clustered") / "feed")
    events = spark.range(200_000).selectExpr(
        "pmod(xxhash64(id), 2000) as user_id", "timestamp_seconds(1704067200 + cast(id * 0.8 as int)) as time",
        "if(id % 3 = 0, 'like', 'view') as action", "sha2(string(id), 256) as padding")
    write_clustered(events, path, 4, row_group_bytes=256 * 1024, users_per_group=1000)
    return events, path


def test_a_user_is_read_from_a_small_share(spark, laid_out):
    events, path = laid_out
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = user_rows(spark.read.parquet(path), 77, 4)
        assert found.count() == events.where("user_id = 77").count() > 0
        assert read_by_scan(found) <= 0.26 * 200_000
        nobody = user_rows(spark.read.parquet(path), 10 ** 9, 4)
        assert read_by_scan(nobody) == 0  # bloom filters: ids above and inside the range
        assert read_by_scan(spark.read.parquet(path).where("user_id = 1999999")) == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_minutes_are_read_from_a_small_share(spark, laid_out):
    events, path = laid_out
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        start, end = datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 10, 5)
        found = spark.read.parquet(path).where(F.col("time").between(start, end))
        assert found.count() == events.where(F.col("time").between(start, end)).count() > 0
        assert 0 < read_by_scan(found) < 0.15 * 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_days_are_replaced_alone(spark, laid_out, tmp_path):
    events, _ = laid_out
    path = str(tmp_path / "again")
    write_clustered(events, path, 2)
    day = events.where("to_date(time) = '2024-01-01' and user_id < 5")
    write_clustered(day, path, 2, mode="days")
    found = spark.read.parquet(path).groupBy("event_date").count().orderBy("event_date").collect()
    assert found[0]["count"] == day.count()
    assert found[1]["count"] == events.where("to_date(time) = '2024-01-02'").count()

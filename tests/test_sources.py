from datetime import date, datetime

import pytest
from pyspark.sql import types as T

from conftest import plan_of, rows
from tidemark.functions.scalars import during_days
from tidemark.operators.audience import active_users
from tidemark.operators.experiment import experiment_users
from tidemark.operators.intervals import live_events
from tidemark.operators.segments import feed_segments
from tidemark.plans.daily_cube import daily_cube, run_daily_cube
from tidemark.plans.feed_report import feed_daily
from tidemark.sources.tab_separated import read_tsv, write_tsv
from tidemark.sources import event_tables, fact_table
from tidemark.sources.schemas import DAILY_ACTIVITY, FEED_ACTIONS
from tidemark.sources.shared_folder import new_path, shared_folder

AS_OF = "2024-01-30 23:07:00"


def test_tables_by_path_and_by_database(spark, feed):
    path = new_path(spark, "feed")
    feed.write.parquet(path)
    assert event_tables.feed_actions(spark, path).schema == FEED_ACTIONS
    spark.sql("CREATE DATABASE IF NOT EXISTS product")
    spark.sql(f"CREATE TABLE IF NOT EXISTS product.feed_actions USING parquet LOCATION '{path}'")
    by_name = event_tables.feed_actions(spark, database="product")
    assert rows(feed_daily(by_name, AS_OF), "Date") == rows(feed_daily(feed, AS_OF), "Date")
    with pytest.raises(ValueError):
        event_tables.feed_actions(spark)


def test_unzoned_times_still_reach_the_scan(feed):
    plan = plan_of(during_days(feed, date(2024, 1, 22), date(2024, 1, 22)))
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(ts,2024-01-22T00:00)" in pushed


def test_tables_laid_out_by_day_open_only_their_days(spark, feed):
    path = new_path(spark, "feed-by-day")
    event_tables.write_by_day(feed, path)
    by_day = event_tables.feed_actions(spark, path)
    report = feed_daily(by_day, AS_OF)
    assert rows(report, "Date") == rows(feed_daily(feed, AS_OF), "Date")
    scan = next(line for line in plan_of(report).splitlines() if "FileScan" in line)
    assert "event_date" in scan[scan.index("PartitionFilters"):scan.index("PushedFilters")]
    start = datetime(2024, 1, 8)
    for job in (live_events(by_day, AS_OF), active_users(by_day, date(2024, 1, 29)),
                feed_segments(by_day, date(2024, 1, 22), date(2024, 1, 29)),
                experiment_users(by_day, start, datetime(2024, 1, 14), (1, 2)),
                daily_cube(by_day, by_day.withColumn("reciever_id", by_day.user_id), AS_OF,
                           date_scope="day")):
        for scan in (line for line in plan_of(job).splitlines() if "FileScan" in line):
            assert "event_date" in scan[scan.index("PartitionFilters"):
                                        scan.index("PushedFilters")]


def test_tsv_keeps_nulls_and_types(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()),
                           T.StructField("c", T.DoubleType())])
    df = spark.createDataFrame([(1, "x", 0.5), (None, None, None), (3, "two words", 1e-9)], schema)
    path = new_path(spark, "tsv")
    write_tsv(df, path)
    back = read_tsv(spark, path, schema)
    assert back.schema == schema and rows(back, "a") == rows(df, "a")


def test_tsv_with_other_columns_is_refused(spark):
    path = new_path(spark, "tsv")
    write_tsv(spark.range(3), path)
    wrong = T.StructType([T.StructField("other", T.LongType())])
    with pytest.raises(Exception, match="the header is"):
        read_tsv(spark, path, wrong).collect()


def test_jdbc_options():
    one_task = event_tables.jdbc_options("jdbc:x", "SELECT 1", properties={"user": "u"})
    assert one_task["query"] == "SELECT 1" and one_task["user"] == "u"
    split = event_tables.jdbc_options("jdbc:x", "SELECT * FROM t", partition_column="day",
                                      lower="2024-01-01", upper="2024-02-01", partitions=31)
    assert split["dbtable"] == "(SELECT * FROM t) source" and split["numPartitions"] == "31"


def test_jdbc_names_are_no_queries():
    for name in ("selected_users", "with_demo"):
        assert event_tables.jdbc_options("jdbc:x", name)["dbtable"] == name
        split = event_tables.jdbc_options("jdbc:x", name, partition_column="day", lower=1,
                                          upper=9, partitions=2)
        assert split["dbtable"] == name
    with pytest.raises(ValueError):
        event_tables.jdbc_options("jdbc:x", "t", partition_column="day", lower=1)


def test_jdbc_common_tables_go_ahead():
    query = "WITH a AS (SELECT 'select ' AS x FROM t), b AS (SELECT 2)\nSELECT * FROM a, b"
    options = event_tables.jdbc_options("jdbc:x", query)
    assert options["prepareQuery"].endswith("b AS (SELECT 2)")
    assert options["query"] == "SELECT * FROM a, b"
    with pytest.raises(ValueError):
        event_tables.jdbc_options("jdbc:x", query, partition_column="x", lower=1, upper=2,
                                  partitions=2)


def test_loading_again_replaces_only_its_date(spark, feed, messages):
    table = "daily_activity_test"
    for as_of in ("2024-01-29", "2024-01-30", "2024-01-30"):
        run_daily_cube(spark, feed, messages, as_of, table, new_path(spark, "cube")
                       if as_of == "2024-01-29" else None, date_scope="day")
    loaded = fact_table.read_daily_activity(spark, table)
    assert loaded.schema == DAILY_ACTIVITY
    expected = daily_cube(feed, messages, "2024-01-29", "day").unionByName(
        daily_cube(feed, messages, "2024-01-30", "day"))
    key = ("event_date", "dimension", "dimension_value")
    assert rows(loaded, *key) == rows(expected, *key)


def test_append_adds_rows(spark, feed, messages):
    table = "daily_activity_appended"
    for _ in range(2):
        run_daily_cube(spark, feed, messages, AS_OF, table, append=True)
    cube = daily_cube(feed, messages, AS_OF)
    assert fact_table.read_daily_activity(spark, table).count() == 2 * cube.count()


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")

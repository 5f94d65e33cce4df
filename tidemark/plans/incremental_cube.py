"""The daily cube from stored partial aggregates, one set per day.

The cube sums over all days, but most days do not change between two runs. So every day's
events are reduced once to parts that merge by addition: likes and views per user, and messages per
pair of sender and recipient (pairs, because distinct senders and recipients of several
days do not add up). A run compares the files of every day folder with those it
has seen, reads the folders that are new or changed, replaces their parts, and builds the
cube from the parts of all days. What is replaced is replaced as a whole, so a run
that was cut short is repaired by the next one.
"""

from pyspark.sql import functions as F

from tidemark.functions.clock import AsOf
from tidemark.operators.activity import DEMOGRAPHICS, activity_of, feed_counts_per_user
from tidemark.plans.daily_cube import cube_of
from tidemark.sources.day_folders import changed_days, day_files, known_files, remember_files
from tidemark.sources.fact_table import create_daily_activity, load_daily_activity
from tidemark.sources.schemas import FEED_ACTIONS, MESSAGE_ACTIONS, conform

USER = ["user_id", *DEMOGRAPHICS]
FEED_PARTS = ("event_date date, user_id bigint, os string, gender bigint, age bigint, "
              "likes bigint, views bigint")
MESSAGE_PARTS = ("event_date date, user_id bigint, os string, gender bigint, age bigint, "
                 "reciever_id bigint, messages bigint")


def feed_parts(feed):
    """Likes and views per day and user."""
    return feed_counts_per_user(feed, "event_date")


def message_parts(messages):
    """Messages per day, sender and recipient."""
    return messages.groupBy("event_date", *USER, "reciever_id").agg(
        F.count("user_id").alias("messages"))


def activity_of_parts(feed, messages):
    """Activity per user over all days of the parts; the counts are exact."""
    feed_counts = feed.groupBy(*USER).agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"))
    sent = (messages.groupBy(*USER, "reciever_id").agg(F.sum("messages").alias("messages"))
            .groupBy(*USER).agg(F.sum("messages").alias("messages_sent"),
                                F.count("reciever_id").alias("users_sent")))
    received = (messages.where("reciever_id is not null")
                .groupBy("reciever_id", "user_id").agg(F.sum("messages").alias("messages"))
                .groupBy(F.col("reciever_id").alias("recipient"))
                .agg(F.sum("messages").alias("messages_received"),
                     F.count("user_id").alias("users_received"))
                .withColumnRenamed("recipient", "user_id"))
    return activity_of(feed_counts, sent, received)


def refresh_parts(spark, events_path, parts_path, schema, reduce):
    """Bring the parts of one event table, laid out by day, up to date; the days that were read."""
    files = day_files(spark, events_path, schema)
    days = changed_days(files, known_files(spark, parts_path))
    if days:
        events = conform(spark.read.parquet(events_path), schema)
        (reduce(events.where(F.col("event_date").isin(days)))
         .hint("rebalance", "event_date")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("event_date").parquet(f"{parts_path}/days"))
    remember_files(spark, files, parts_path, days)
    return days


def read_parts(spark, parts_path, columns):
    """The parts of the days that the event table holds now."""
    held = list(known_files(spark, parts_path))
    parts = spark.read.schema(columns).parquet(f"{parts_path}/days")
    return parts.where(F.col("event_date").isin(held))


def refresh_cube_parts(spark, feed_path, messages_path, parts_path):
    """Both tables' parts; the days that were read, by table."""
    return {
        "feed": refresh_parts(spark, feed_path, f"{parts_path}/feed", FEED_ACTIONS, feed_parts),
        "messages": refresh_parts(spark, messages_path, f"{parts_path}/messages", MESSAGE_ACTIONS,
                                  message_parts)}


def cube_from_parts(spark, parts_path, as_of):
    """The cube of all days, as `daily_cube` of the whole tables; nothing but parts is read."""
    feed = read_parts(spark, f"{parts_path}/feed", FEED_PARTS)
    messages = read_parts(spark, f"{parts_path}/messages", MESSAGE_PARTS)
    return cube_of(activity_of_parts(feed, messages), AsOf.of(as_of).yesterday)


def run_incremental_cube(spark, feed_path, messages_path, parts_path, as_of, table, location=None):
    """Refresh the parts and load the cube of one run; the days that were read."""
    days = refresh_cube_parts(spark, feed_path, messages_path, parts_path)
    create_daily_activity(spark, table, location)
    load_daily_activity(cube_from_parts(spark, parts_path, as_of), table, AsOf.of(as_of).yesterday)
    return days

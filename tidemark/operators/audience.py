"""Audience overlap of the two products.

Column names of the results are fixed values of the report.
"""

from functools import reduce

from pyspark.sql import functions as F

from tidemark.functions.scalars import during_days, percent

CLASSES = ("purely_feed_users", "purely_messenger_users", "both_func_users")


def active_users(events, day):
    """Distinct (date, user) of one day."""
    return (during_days(events, day, day)
            .select(F.to_date("time").alias("date"), "user_id").distinct())


def feed_only_users(feed, messages, day):
    return _count(active_users(feed, day), active_users(messages, day), "left_anti", CLASSES[0])


def messenger_only_users(feed, messages, day):
    return _count(active_users(messages, day), active_users(feed, day), "left_anti", CLASSES[1])


def both_users(feed, messages, day):
    return _count(active_users(messages, day), active_users(feed, day), "left_semi", CLASSES[2])


def _count(users, others, how, name):
    """Both sides hold one row per user and share a partitioning: no key is hot."""
    return (users.join(others, ["date", "user_id"], how)
            .groupBy("date").agg(F.count("user_id").alias(name)))


def user_overlap(feed, messages, day):
    """All three classes and their total, reading each table once.

    A class without users counts 0; joining three separate counts would lose
    the whole row instead.
    """
    def seen(events, in_feed, in_messenger):
        return during_days(events, day, day).select(
            F.to_date("time").alias("date"), "user_id",
            F.lit(in_feed).alias("in_feed"), F.lit(in_messenger).alias("in_messenger"))

    users = (seen(feed, True, False).unionByName(seen(messages, False, True))
             .groupBy("date", "user_id")
             .agg(F.bool_or("in_feed").alias("in_feed"),
                  F.bool_or("in_messenger").alias("in_messenger")))
    in_feed, in_messenger = F.col("in_feed"), F.col("in_messenger")
    classes = zip(CLASSES, (in_feed & ~in_messenger, in_messenger & ~in_feed,
                            in_feed & in_messenger))
    return (users.groupBy("date")
            .agg(*[F.count_if(condition).alias(name) for name, condition in classes])
            .withColumn("all_unique_users", reduce(lambda a, b: a + b, map(F.col, CLASSES))))


def overlap_shares(overlap):
    """Each class as a percentage of all users."""
    return overlap.select("date", *[percent(c, "all_unique_users").alias(c) for c in CLASSES])

"""Daily metrics per segment (age band, country, os, source) and their summaries."""

from pyspark.sql import functions as F

from tidemark.functions.scalars import (age_band, count_action, distinct_users, during_days,
                                        ratio)

OTHER = "other"
SEGMENT = ("date", "age_groups", "country", "os", "source")


def _segmented(events, first, last):
    return during_days(events, first, last).withColumns(
        {"date": F.to_date("time"), "age_groups": age_band("age")}).groupBy(*SEGMENT)


def message_segments(messages, first, last, exact=True):
    return (_segmented(messages, first, last)
            .agg(F.count("reciever_id").alias("messages"),
                 distinct_users("user_id", exact).alias("messenger_users"))
            .withColumn("messages_per_user", ratio("messages", "messenger_users")))


def feed_segments(feed, first, last, exact=True):
    return (_segmented(feed, first, last)
            .agg(count_action("like").alias("likes"), count_action("view").alias("views"),
                 distinct_users("user_id", exact).alias("feed_users"))
            .withColumns({"likes_per_user": ratio("likes", "feed_users"),
                          "views_per_user": ratio("views", "feed_users")}))


def segment_daily(feed, messages, first, last, how="inner", exact=True):
    """Both products side by side per segment and day.

    The days are cut on *both* inputs before aggregating: a filter after the
    join would leave one side reading its whole history. The inner join drops
    segments seen in one product only; `how="full"` keeps them, counting 0 for
    the other product.
    """
    def count(name):
        return F.coalesce(name, F.lit(0)).alias(name)

    return (message_segments(messages, first, last, exact)
            .join(feed_segments(feed, first, last, exact), list(SEGMENT), how)
            .select(*SEGMENT, count("messages"), "messages_per_user", count("messenger_users"),
                    count("likes"), count("views"), "likes_per_user", "views_per_user",
                    count("feed_users")))


def per_user_daily_means(segments):
    """Unweighted mean over the segments of a day (not a ratio of sums)."""
    return segments.groupBy("date").agg(
        *[F.avg(c).alias(c) for c in ("likes_per_user", "views_per_user")])


def daily_totals(segments):
    return segments.groupBy("date").agg(
        *[F.sum(c).alias(c) for c in ("messages", "likes", "views")])


def source_os_users(feed, day, exact=True):
    """Distinct feed users of a day per (os, source)."""
    return (during_days(feed, day, day)
            .groupBy(F.to_date("time").alias("date"), "os", "source")
            .agg(distinct_users("user_id", exact).alias("users")))


def pivot_users(users, column, values):
    """One column of summed users per named value, `other` and `total`, per date.

    A user in two cells counts in both. The names are given, so that no extra job
    runs to discover them; every other value, or none, counts as `other`, and nothing
    is lost from `total`.
    """
    name = F.when(F.col(column).isin(*values), F.col(column)).otherwise(OTHER)
    columns = [*sorted(values), OTHER]
    found = users.groupBy("date").agg(
        *[F.coalesce(F.sum(F.when(name == c, F.col("users"))), F.lit(0)).alias(c) for c in columns])
    return found.withColumn("total", sum((F.col(c) for c in columns), F.lit(0)))

"""Metrics per 15-minute interval of the current day."""

from pyspark.sql import functions as F

from tidemark.functions.clock import AsOf, timestamp_literal
from tidemark.functions.scalars import (count_action, distinct_users, during_days,
                                        interval_label, interval_start, percent)

FEED_METRICS = ("feed_users", "likes", "views", "ctr")
MESSENGER_METRICS = ("messenger_users", "messages_sent")


def live_events(events, as_of):
    """Events of the current day up to, not including, the still open interval."""
    as_of = AsOf.of(as_of)
    kept = events.where((F.col("time") >= timestamp_literal(as_of.live_start))
                        & (F.col("time") < timestamp_literal(as_of.open_interval)))
    if "event_date" in events.columns:
        kept = kept.where(F.col("event_date").between(F.lit(as_of.live_start.date()),
                                                      F.lit(as_of.today)))
    return kept


def _per_interval(events, *aggregates):
    return (events.groupBy(interval_start().alias("time")).agg(*aggregates)
            .withColumns({"date": F.to_date("time"), "interval": interval_label("time")}))


def _feed_measures(feed, exact):
    return (_per_interval(feed,
                          distinct_users("user_id", exact).alias("feed_users"),
                          count_action("like").alias("likes"),
                          count_action("view").alias("views"))
            .withColumn("ctr", percent("likes", "views"))
            .select("date", "time", "interval", *FEED_METRICS))


def _message_measures(messages, exact):
    return (_per_interval(messages,
                          distinct_users("user_id", exact).alias("messenger_users"),
                          F.count("user_id").alias("messages_sent"))
            .select("date", "time", "interval", *MESSENGER_METRICS))


def feed_intervals(feed, as_of, exact=True):
    return _feed_measures(live_events(feed, as_of), exact)


def message_intervals(messages, as_of, exact=True):
    return _message_measures(live_events(messages, as_of), exact)


def interval_metrics(feed, messages, as_of, on="time", exact=True):
    """Intervals in which both products saw events.

    `on="interval"` joins on the HH:MM text instead of the interval start; the
    two agree as long as a single day is in view.
    """
    left, right = feed_intervals(feed, as_of, exact), message_intervals(messages, as_of, exact)
    if on == "interval":
        return left.join(right.withColumnsRenamed({"date": "messenger_date",
                                                   "time": "messenger_time"}), "interval")
    return left.join(right.drop("date", "interval"), "time").select(*left.columns,
                                                                     *MESSENGER_METRICS)


def history_metrics(feed, messages, first, last, exact=True):
    """As `interval_metrics`, for all intervals of the days `first`..`last`."""
    left = _feed_measures(during_days(feed, first, last), exact)
    right = _message_measures(during_days(messages, first, last), exact)
    return left.join(right.drop("date", "interval"), "time").select(*left.columns,
                                                                     *MESSENGER_METRICS)


def as_series(metrics, names):
    """Long form (metric, date, time, interval, value): the metric is the series key."""
    values = metrics.select("date", "time", "interval",
                            *[F.col(n).cast("double").alias(n) for n in names])
    return (values.unpivot(["date", "time", "interval"], list(names), "metric", "value")
            .select("metric", "date", "time", "interval", "value"))

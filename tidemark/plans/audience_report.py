"""Audience report of the day before `as_of`: overlap, totals, shares, text."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import AsOf
from tidemark.functions.scalars import age_band, during_days, half_even, percent, ratio
from tidemark.operators import audience, segments

# The traffic sources and systems that the report names, and its text.
SOURCES = ("ads", "organic")
SYSTEMS = ("Android", "iOS")
SUMMARY = """Date: %s

Unique users: %s
    Feed-only: %s / %s%%
    Messenger-only: %s / %s%%
    Both functions: %s / %s%%
Messages: %s
Likes: %s
Views: %s
CTR: %s

Sources:
    Organic: %s%%
    Ads: %s%%

OS:
    iOS: %s%%
    Android: %s%%"""


@dataclass(frozen=True)
class AudienceReport:
    """The frames of one report. All are lazy."""

    overlap: DataFrame
    shares: DataFrame
    segments: DataFrame
    per_user_means: DataFrame
    totals: DataFrame
    by_source: DataFrame
    by_os: DataFrame
    summary: DataFrame


def audience_report(feed, messages, as_of, exact=True):
    clock = AsOf.of(as_of)
    overlap = audience.user_overlap(feed, messages, clock.yesterday)
    segment_rows = segments.segment_daily(feed, messages, *clock.report_week, exact=exact)
    users = segments.source_os_users(feed, clock.yesterday, exact)
    by_source = segments.pivot_users(users, "source", SOURCES)
    by_os = segments.pivot_users(users, "os", SYSTEMS)
    return AudienceReport(
        overlap=overlap, shares=audience.overlap_shares(overlap), segments=segment_rows,
        per_user_means=segments.per_user_daily_means(segment_rows),
        totals=segments.daily_totals(segment_rows), by_source=by_source, by_os=by_os,
        summary=audience_summary(feed, messages, clock.yesterday))


def day_numbers(feed, messages, day):
    """One row with all numbers of the report text, reading each table once.

    Events become one row per user and segment, with the counts of both products. Three
    groupings of these rows in one pass then give the users (overlap), the segments
    (totals of those seen in both products) and the feed users per source and system.
    """
    def rows(events, likes, views, sent, in_feed):
        return during_days(events, day, day).select(
            "user_id", age_band("age").alias("age_groups"), "country", "os", "source",
            likes.cast("bigint").alias("likes"), views.cast("bigint").alias("views"),
            sent.cast("bigint").alias("messages"), F.lit(in_feed).alias("in_feed"))

    zero, action = F.lit(0), F.col("action")
    both = rows(feed, action == "like", action == "view", zero, True).unionByName(
        rows(messages, zero, zero, F.col("reciever_id").isNotNull(), False))
    measures = ("likes", "views", "messages")
    seen = [F.bool_or("in_feed").alias("in_feed"), F.bool_or(~F.col("in_feed")).alias("in_messenger")]
    segment = ["age_groups", "country", "os", "source"]
    users = both.groupBy("user_id", *segment).agg(
        *seen, *[F.coalesce(F.sum(m), zero).alias(m) for m in measures])
    keys = ["user_id", *segment]
    grouped = users.groupingSets([["user_id"], segment, ["user_id", "os", "source"]], *keys).agg(
        F.grouping_id(*keys).alias("set_id"), F.bool_or("in_feed").alias("in_feed"),
        F.bool_or("in_messenger").alias("in_messenger"), *[F.sum(m).alias(m) for m in measures])
    # A one for every key, in their order, that is not grouped by.
    user, segments_of, cell = (F.col("set_id") == i for i in (0b01111, 0b10000, 0b01100))
    in_feed, in_messenger = F.col("in_feed"), F.col("in_messenger")
    classes = (in_feed & ~in_messenger, in_messenger & ~in_feed, in_feed & in_messenger)
    fed = cell & in_feed
    return grouped.agg(
        F.count_if(user).alias("all_unique_users"),
        *[F.count_if(user & c).alias(n) for n, c in zip(audience.CLASSES, classes)],
        *[F.sum(F.when(segments_of & in_feed & in_messenger, F.col(m))).alias(m)
          for m in measures],
        F.count_if(fed).alias("total"),
        *[F.count_if(fed & (F.col("source") == n)).alias(n) for n in SOURCES],
        *[F.count_if(fed & (F.col("os") == n)).alias(n) for n in SYSTEMS]).where(
            "all_unique_users > 0")


def audience_summary(feed, messages, day):
    """The report text of a day; no row if nobody was active.

    Shares are of the users of all sources and systems, named in the text or not.
    A day without a segment seen in both products leaves the metrics out.
    """
    def rounded(column):
        return half_even(column).cast("string")

    classes = [c for name in audience.CLASSES
               for c in (F.col(name), rounded(percent(name, "all_unique_users")))]
    shares = [rounded(percent(name, "total")) for name in ("organic", "ads", "iOS", "Android")]
    date = F.lit(day).cast("date")
    return day_numbers(feed, messages, day).select(date.alias("date"), F.format_string(
        SUMMARY, date.cast("string"), "all_unique_users", *classes,
        "messages", "likes", "views", rounded(ratio("likes", "views")), *shares).alias("message"))

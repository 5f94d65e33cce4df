"""Per-user activity in the feed and in the messenger, and its roll-up.

All aggregates combine on the map side first, so a user or a recipient with a
large share of the events costs a few partial rows, not a hot task. The exact
distinct counts dedupe on (key, other user) before they count per key.
"""

from functools import reduce

from pyspark.sql import functions as F

from tidemark.functions.scalars import count_action, distinct_users

DEMOGRAPHICS = ("os", "gender", "age")
FEED_MEASURES = ("likes", "views")
MEASURES = ("views", "likes", "messages_received", "messages_sent",
            "users_received", "users_sent")


def user_feed_stats(feed):
    """Likes and views per (user, os, gender, age)."""
    return _as_dimensions(feed_counts_per_user(feed))


def received_per_user(messages, exact=True):
    """Messages and distinct senders per recipient.

    The recipient is renamed to `user_id`. Distinct *senders* are counted; a
    dialect in which the new alias shadows the source column would count the
    recipient itself and always give 1.
    """
    return (messages.groupBy(F.col("reciever_id").alias("user_id_received"))
            .agg(F.count("reciever_id").alias("messages_received"),
                 distinct_users("user_id", exact).alias("users_received"))
            .withColumnRenamed("user_id_received", "user_id"))


def sent_per_user(messages, exact=True):
    """Messages and distinct recipients per (user, os, gender, age)."""
    return _as_dimensions(_sent_counts(messages, exact))


def user_message_stats(messages, exact=True):
    """Received side FULL OUTER sent side by user; a missing side counts 0."""
    sides = received_per_user(messages, exact).join(
        sent_per_user(messages, exact), "user_id", "full")
    return sides.select(
        "user_id", *DEMOGRAPHICS,
        *[_or_zero(c) for c in ("messages_received", "users_received",
                                "messages_sent", "users_sent")])


def user_activity(feed, messages, exact=True, received_from=None):
    """Users seen in the feed and as senders with the same demographics.

    Same rows as the feed stats inner-joined with `user_message_stats` on the
    four keys: that join discards recipients who never send, so the outer join
    shrinks to a left join. Doing the four-key join first reuses the
    partitioning both aggregates already have, as long as the keys keep their
    source types until after it; only per-user rows move again.

    `received_from`: the messages once more, laid out by recipient. With tables from
    `write_bucketed` of equal numbers of buckets nothing moves at all.
    """
    return activity_of(feed_counts_per_user(feed), _sent_counts(messages, exact),
                       received_per_user(messages if received_from is None else received_from, exact))


def activity_of(feed_counts, sent_counts, received):
    """`user_activity` of counts per user that are there already."""
    both = feed_counts.join(sent_counts, ["user_id", *DEMOGRAPHICS], "inner")
    return _as_dimensions(
        both.join(received, "user_id", "left")
        .select("user_id", *DEMOGRAPHICS, *[_or_zero(c) for c in MEASURES]))


def roll_up(activity, dimensions=DEMOGRAPHICS, measures=MEASURES):
    """Sums per value of each dimension, stacked in long form, in one pass.

    Rows with an unknown dimension value belong to no group of that dimension.
    """
    grouped = (activity.groupingSets([[d] for d in dimensions], *dimensions)
               .agg(F.grouping_id(*dimensions).alias("set_id"),
                    *[F.sum(m).alias(m) for m in measures]))
    # grouping_id has a 1 for every dimension that is *not* grouped by.
    everything = 2 ** len(dimensions) - 1
    ids = [(everything - 2 ** (len(dimensions) - 1 - i), d) for i, d in enumerate(dimensions)]
    name = reduce(lambda case, pair: case.when(F.col("set_id") == pair[0], pair[1]),
                  ids[1:], F.when(F.col("set_id") == ids[0][0], ids[0][1]))
    return (grouped.select(name.alias("dimension"),
                           F.coalesce(*dimensions).alias("dimension_value"), *measures)
            .where(F.col("dimension_value").isNotNull()))


def feed_counts_per_user(feed, *more):
    """Likes and views per user, and per value of `more` columns."""
    return feed.groupBy(*more, "user_id", *DEMOGRAPHICS).agg(
        count_action("like").alias("likes"), count_action("view").alias("views"))


def _sent_counts(messages, exact):
    return messages.groupBy("user_id", *DEMOGRAPHICS).agg(
        F.count("user_id").alias("messages_sent"),
        distinct_users("reciever_id", exact).alias("users_sent"))


def _as_dimensions(stats):
    """Gender and age become text where they turn into dimension values."""
    return stats.withColumns({c: F.col(c).cast("string") for c in ("gender", "age")})


def _or_zero(column):
    return F.coalesce(column, F.lit(0)).alias(column)

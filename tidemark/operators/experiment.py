"""Per-user experiment data and the ratio metrics derived from it."""

from pyspark.sql import functions as F

from tidemark.functions.scalars import between_times, count_action, hash_bucket, ratio

GROUP = "exp_group"


def experiment_users(feed, start, end, groups):
    """Likes, views and CTR per user of the given groups; `end` itself is included."""
    # The null check is spelled out: joins on the group would derive it, and a scan
    # that differs by it is not shared with the other uses of this aggregate.
    kept = feed.where(between_times(start, end) & F.col(GROUP).isNotNull()
                      & F.col(GROUP).isin(*groups))
    if "event_date" in feed.columns:
        kept = kept.where(F.col("event_date").between(F.lit(start.date()), F.lit(end.date())))
    return (kept.groupBy("user_id", GROUP)
            .agg(count_action("like").alias("likes"), count_action("view").alias("views"))
            .withColumn("ctr", ratio("likes", "views")))


def daily_experiment_users(feed, start, end, groups):
    """As `experiment_users`, per day: `date`, group, user, likes and views."""
    kept = feed.where(between_times(start, end) & F.col(GROUP).isin(*groups))
    return kept.groupBy(F.to_date("time").alias("date"), "user_id", GROUP).agg(
        count_action("like").alias("likes"), count_action("view").alias("views"))


def group_ctr(users, groups):
    """Ratio of sums per group: at most one row for each of the named groups."""
    return (users.where(F.col(GROUP).isin(*groups)).groupBy(GROUP)
            .agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"))
            .withColumn("global_ctr", ratio("likes", "views")))


def smoothed_ctr(users, groups, strength=5):
    """Pull each user's CTR towards the CTR of the user's group.

    The group totals have one row per *named* group, so broadcasting them is
    bounded by the parameter, whatever the data. They are summed from the same
    per-user aggregate, whose shuffle Spark reuses.
    """
    totals = group_ctr(users, groups).select(GROUP, "global_ctr")
    return users.join(F.broadcast(totals), GROUP).withColumn(
        "smoothed_ctr", ratio(F.col("likes") + strength * F.col("global_ctr"),
                              strength + F.col("views")))


def linearized(users, control, name="lin_likes"):
    """Likes minus the views valued at the control group's CTR.

    The control CTR is one number: a scalar subquery over the same per-user
    aggregate. Conditional sums instead of a filter keep that aggregate
    identical to the outer one, so that its shuffle is reused.
    """
    in_control = F.col(GROUP) == control
    control_ctr = users.agg(ratio(F.sum(F.when(in_control, F.col("likes"))),
                                  F.sum(F.when(in_control, F.col("views"))))).scalar()
    return users.withColumn(name, F.col("likes") - control_ctr * F.col("views"))


def bucketed(users, salt="bucket", n_buckets=50):
    """Likes, views and their ratio per (group, hash bucket of the user)."""
    return (users.groupBy(GROUP, hash_bucket("user_id", salt, n_buckets).alias("buckets"))
            .agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"))
            .withColumn("bucket_ctr", ratio("likes", "views")))

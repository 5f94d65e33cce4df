"""Distinct users over any days and segments from small stored rows, without the events.

A day's users are kept once per segment in a form that merges: as a sketch of fixed size
(HyperLogLog for counts, theta for counts of intersections and differences as well), or as
a bitmap, which is exact. The counts of any set of days, and of any union of segments, then come
from these rows alone; a user who is there on several days counts once.

Sketches: the relative standard error of a count is about 0.83 / sqrt(2 ** lg_k) (HyperLogLog) or
1 / sqrt(2 ** lg_entries) (theta); results of theta set operations err by that share of the
*union*. Up to about 2 ** lg_entries users theta sketches are exact.

Bitmaps: a row holds one bit for each of 32768 neighbouring ids, 4 kB, so they suit ids that are
dense. Ids must not be negative.
"""

from functools import reduce

from pyspark.sql import functions as F

LG_K = 12
LG_ENTRIES = 12
SEGMENTS = ("os", "source", "country")


def _days(rows, first, last):
    return rows.where(F.col("date").between(F.lit(first), F.lit(last)))


def daily_sketches(events, segments=SEGMENTS, lg_k=LG_K):
    """A HyperLogLog sketch of the users per day and segment: `date`, segments, `users`.

    Tasks send one sketch per day and segment, of at most 2 ** lg_k bytes, however many
    events a day has.
    """
    return events.groupBy(F.to_date("time").alias("date"), *segments).agg(
        F.hll_sketch_agg("user_id", F.lit(lg_k)).alias("users"))


def sketched_users(sketches, first, last, by=()):
    """Estimated distinct users of the days `first`..`last`, per value of `by`."""
    return (_days(sketches, first, last).groupBy(*by)
            .agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users")))


def sketch_error(lg_k=LG_K):
    """Relative standard error of a HyperLogLog count."""
    return 0.8326 / 2 ** (lg_k / 2)


def daily_theta(events, segments=(), lg_entries=LG_ENTRIES):
    """A theta sketch of the users per day and segment."""
    return events.groupBy(F.to_date("time").alias("date"), *segments).agg(
        F.theta_sketch_agg("user_id", F.lit(lg_entries)).alias("users"))


def sketched_overlap(feed, messages, first, last, lg_entries=LG_ENTRIES):
    """Users of the feed only, of the messenger only, of both, and of either, in the days
    `first`..`last`, estimated from the daily theta sketches of both products. One row; a
    product without sketches there has no users."""
    def users(sketches):
        return _days(sketches, first, last).agg(
            F.theta_union_agg("users", F.lit(lg_entries)).alias("users"))

    # Two single rows; each aggregate yields one even over no rows.
    sides = users(feed).withColumnRenamed("users", "f").crossJoin(
        users(messages).withColumnRenamed("users", "m"))
    sets = {"purely_feed_users": F.theta_difference("f", "m"),
            "purely_messenger_users": F.theta_difference("m", "f"),
            "both_func_users": F.theta_intersection("f", "m"),
            "all_unique_users": F.theta_union("f", "m", F.lit(lg_entries))}
    return sides.select(F.lit(first).alias("first_date"), F.lit(last).alias("last_date"),
                        *[F.theta_sketch_estimate(s).alias(name) for name, s in sets.items()])


def daily_bitmaps(events, segments=SEGMENTS):
    """Bitmaps of the users per day, segment and `bucket` of ids: `date`, segments, `bucket`, `bits`."""
    user = F.col("user_id")
    checked = F.when(user >= 0, user).otherwise(
        F.raise_error(F.concat(F.lit("negative user id "), user.cast("string"))))
    rows = events.where(user.isNotNull()).select(
        F.to_date("time").alias("date"), *segments, checked.alias("user_id"))
    return (rows.groupBy("date", *segments, F.bitmap_bucket_number("user_id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("bits")))


def bitmap_users(bitmaps, first, last, by=()):
    """Exact distinct users of the days `first`..`last`, per value of `by`.

    Bitmaps of one bucket are united first, so a segment's buckets are counted in parallel.
    """
    united = _days(bitmaps, first, last).groupBy(*by, "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(*by).agg(
        F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("users"))


def rolling_users(bitmaps, days, by=()):
    """Exact distinct users of the `days` days that end with each day: daily, weekly or monthly
    active users. A day's bitmap is copied to the days whose window holds it."""
    ends = F.sequence(F.col("date"), F.date_add("date", days - 1))
    last = bitmaps.agg(F.max("date").alias("last_date"))
    windows = (bitmaps.withColumn("date", F.explode(ends)).groupBy("date", *by, "bucket")
               .agg(F.bitmap_or_agg("bits").alias("bits"))
               .groupBy("date", *by).agg(F.sum(F.bitmap_count("bits")).alias("users")))
    return windows.join(F.broadcast(last), F.col("date") <= F.col("last_date")).drop("last_date")


def unite(tables):
    """Stored rows of several runs or regions as one table: everything here merges again."""
    return reduce(lambda a, b: a.unionByName(b), tables)

"""Daily audience and CTR of the feed over the last week."""

from pyspark.sql import functions as F

from tidemark.functions.clock import AsOf
from tidemark.functions.scalars import count_action, distinct_users, during_days, ratio

CHART_DAYS = 7
# Column names are the labels of the report text, and the width to
# which the text pads labels and values.
LABELS = ("Date", "Feed_DAU", "Likes", "Views", "CTR")
LABEL_WIDTH, VALUE_WIDTH = 8, 23


def feed_daily(feed, as_of, exact=True):
    """One row per day for the eight days up to yesterday."""
    return (during_days(feed, *AsOf.of(as_of).report_week)
            .groupBy(F.to_date("time").alias("Date"))
            .agg(distinct_users("user_id", exact).alias("Feed_DAU"),
                 count_action("like").alias("Likes"), count_action("view").alias("Views"))
            .withColumn("CTR", ratio("Likes", "Views")))


def feed_week_head(daily):
    """The first seven days, the frame behind the charts."""
    return daily.orderBy("Date").limit(CHART_DAYS)


def feed_latest_message(daily):
    """The most recent day as text: one label and right-aligned value per line."""
    shown_ctr = F.when(F.col("CTR").isNull(), "NaN").otherwise(
        F.regexp_replace(F.format_string("%.6f", "CTR"), r"(\.\d+?)0+$", "$1"))
    values = (F.concat(F.col("Date").cast("string"), F.lit(" 00:00:00")),
              F.col("Feed_DAU").cast("string"), F.col("Likes").cast("string"),
              F.col("Views").cast("string"), shown_ctr)
    lines = [F.concat(F.rpad(F.lit(label), LABEL_WIDTH, " "),
                      F.lpad(text, VALUE_WIDTH, " "))
             for label, text in zip(LABELS, values)]
    return (daily.orderBy(F.desc("Date")).limit(1)
            .select("Date", F.concat_ws("\n", *lines).alias("message")))

"""Daily activity by os, gender and age."""

from pyspark.sql import functions as F

from tidemark.functions.clock import AsOf
from tidemark.functions.scalars import during_days
from tidemark.operators.activity import roll_up, user_activity
from tidemark.sources.fact_table import create_daily_activity, load_daily_activity
from tidemark.sources.schemas import DAILY_ACTIVITY


def daily_cube(feed, messages, as_of, date_scope="all", exact=True):
    """Measures per dimension value, stamped with the day before `as_of`.

    `date_scope="all"` sums everything the tables hold, as the upstream job does
    although it stamps a single day; `"day"` restricts both tables to that day.
    """
    day = AsOf.of(as_of).yesterday
    if date_scope == "day":
        feed, messages = during_days(feed, day, day), during_days(messages, day, day)
    elif date_scope != "all":
        raise ValueError("date_scope must be 'all' or 'day'")
    return cube_of(user_activity(feed, messages, exact), day)


def cube_of(activity, day):
    """The measures of per-user activity, stamped with a day."""
    return roll_up(activity).withColumn("event_date", F.lit(day)).select(*DAILY_ACTIVITY.names)


def run_daily_cube(spark, feed, messages, as_of, table, location=None, date_scope="all",
                   append=False, exact=True):
    """Create the fact table if needed and load the cube of one run.

    `exact=False` counts distinct users by sketches.
    """
    create_daily_activity(spark, table, location)
    load_daily_activity(daily_cube(feed, messages, as_of, date_scope, exact), table,
                        AsOf.of(as_of).yesterday, append)

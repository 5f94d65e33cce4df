"""Every operator and report as a query over the given tables.

Doubles are rounded, timestamps lose their zone and flags become text here, so that
results compare with another engine; the library does none of this.
"""

from datetime import timedelta
from functools import cached_property

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.parameters import (ALERT_AS_OF, AS_OF, DIGITS, END, FEW_BUCKETS, HALF, LATE, MONTH,
                               REPAIRED, REPLICATES, SEED, SPLIT, START, USER)
from tidemark.functions.clock import AsOf
from tidemark.functions.scalars import during_days
from tidemark.operators import activity, audience, segments, user_sets
from tidemark.operators.bands import add_band, latest_points
from tidemark.operators.bootstrap import (bootstrap_by_cell, bootstrap_by_user,
                                          bootstrap_of_days, cells, daily_replicates)
from tidemark.operators.experiment import (bucketed, daily_experiment_users, experiment_users,
                                           group_ctr, linearized, smoothed_ctr)
from tidemark.operators.histogram import histogram
from tidemark.operators.intervals import (FEED_METRICS, MESSENGER_METRICS, history_metrics,
                                          interval_metrics)
from tidemark.operators.mannwhitney import mann_whitney_test
from tidemark.operators.welch import welch_test
from tidemark.plans import alerts, feed_report
from tidemark.plans.audience_report import SOURCES, SYSTEMS, audience_report
from tidemark.plans.daily_cube import daily_cube, run_daily_cube
from tidemark.plans.experiment import ctr_experiment, linearized_experiment
from tidemark.plans.incremental_cube import cube_from_parts, refresh_cube_parts
from tidemark.sources.clustered_tables import user_rows, write_bucketed, write_clustered
from tidemark.sources.derived_events import (feed_from_events, messages_from_events,
                                             read_events, stream_events)
from tidemark.sources.event_tables import feed_actions, message_actions, write_by_day
from tidemark.sources.fact_table import read_daily_activity
from tidemark.sources.shared_folder import new_path
from tidemark.sources.tab_separated import read_tsv, write_tsv
from tidemark.sources.user_set_tables import read_days, store_days
from tidemark.streaming.intervals import (interval_stream, read_alerts, repair_day,
                                          start_alerts, write_intervals)
from tidemark.streaming.late_rows import SOURCE_OPTIONS, run_in_any_order
from tidemark.streaming.stateful_alerts import read_stateful_alerts, start_stateful_alerts

CLOCK = AsOf.of(AS_OF)
DAY = CLOCK.yesterday
WEEK = CLOCK.report_week


def comparable(df):
    """Doubles to a fixed number of decimals, timestamps without zone, flags as text."""
    shown = {"double": lambda c: F.round(c, DIGITS) + 0.0,  # no -0.0
             "timestamp": lambda c: c.cast("timestamp_ntz"),
             "boolean": lambda c: c.cast("string"),
             "int": lambda c: c.cast("bigint")}
    return df.select(*[
        shown.get(kind, lambda c: c)(F.col(name)).alias(name) for name, kind in df.dtypes])


class Tables:
    """The two event tables behind one data directory."""

    def __init__(self, spark, sf_dir):
        self.spark = spark
        self.events = read_events(spark, sf_dir)

    @cached_property
    def feed(self):
        return feed_from_events(self.events)

    @cached_property
    def messages(self):
        return messages_from_events(self.events)

    @property
    def both(self):
        return self.feed, self.messages

    def metrics(self, on="time"):
        return interval_metrics(*self.both, CLOCK, on)

    def segments(self, how="inner"):
        return segments.segment_daily(*self.both, *WEEK, how=how)

    def users(self, *groups):
        return experiment_users(self.feed, START, END, groups)

    def buckets(self):
        return bucketed(self.users(1, 2))

    def smoothed(self):
        return smoothed_ctr(self.users(1, 2), (1, 2))

    def linearized(self, *pair):
        return linearized(self.users(*pair), pair[0])

    def replicates(self):
        return bootstrap_by_user(self.users(1, 2), REPLICATES, SEED, "md5")


def _feed_daily_by_day(t):
    """The feed report over the table laid out by day and read by its path."""
    path = new_path(t.spark, "feed-by-day")
    write_by_day(t.feed, path)
    return feed_report.feed_daily(feed_actions(t.spark, path=path), CLOCK)


def _overlap_by_name(t):
    """The overlap over tables found by the name of their database."""
    database = "product_" + new_path(t.spark, "")[-32:]
    t.spark.sql(f"CREATE DATABASE {database}")
    for name, rows in (("feed_actions", t.feed), ("message_actions", t.messages)):
        rows.write.option("path", new_path(t.spark, name)).saveAsTable(f"{database}.{name}")
    return audience.user_overlap(feed_actions(t.spark, database=database),
                                 message_actions(t.spark, database=database), DAY)


def _tsv_round_trip(t):
    stats = activity.user_feed_stats(t.feed)
    path = new_path(t.spark, "feed-stats-tsv")
    write_tsv(stats, path)
    return read_tsv(t.spark, path, T.StructType(
        [T.StructField(f.name, f.dataType) for f in stats.schema]))


def _tsv_escapes(t):
    """Properties of the events behind signs that the format escapes, written and read."""
    signs = "\"'\t\n\\N\\t \r"
    odd = t.events.groupBy("event_type").agg(
        F.concat(F.lit(signs), F.min("props"), F.lit(signs[::-1])).alias("odd\tname"),
        F.when(F.col("event_type") != "view", F.lit("")).alias("empty"),
        F.min("ts").cast("timestamp").alias("first"))
    path = new_path(t.spark, "odd-tsv")
    write_tsv(odd, path)
    read = read_tsv(t.spark, path, T.StructType(
        [T.StructField(f.name, f.dataType) for f in odd.schema]))
    return read.select("event_type", F.md5("odd\tname").alias("odd"), "empty", "first")


def _stored_cube(t):
    """Loaded twice, as after a retry: the date must not count twice."""
    path = new_path(t.spark, "daily-activity")
    table = "daily_activity_" + path[-32:]
    for _ in range(2):
        run_daily_cube(t.spark, *t.both, CLOCK, table, path)
    return read_daily_activity(t.spark, table)


def _incremental_cube(t):
    """A run after the first half of the days, with one of them still short of its late events;
    then a run after the rest has come and that day has been replaced."""
    feed_path, messages_path, parts = (new_path(t.spark, f"incremental-{name}")
                                       for name in ("feed", "messages", "parts"))
    tables = ((t.feed, feed_path), (t.messages, messages_path))
    day, early = F.to_date("time"), F.hour("time") < 12
    for events, path in tables:
        write_by_day(events.where((day < F.lit(HALF)) & ((day != F.lit(LATE)) | early)), path)
    refresh_cube_parts(t.spark, feed_path, messages_path, parts)
    for events, path in tables:
        write_by_day(events.where(day >= F.lit(HALF)), path, "append")
        write_by_day(events.where(day == F.lit(LATE)), path, "days")
    refresh_cube_parts(t.spark, feed_path, messages_path, parts)
    return cube_from_parts(t.spark, parts, CLOCK)


def _stored_sets(t, sets, name):
    path = new_path(t.spark, name)
    store_days(sets, path)
    return read_days(t.spark, path)


def _history(t):
    return alerts.smoothed_history(history_metrics(*t.both, MONTH, CLOCK.today))


def _sketched_users(t):
    """Users of the week per segment, from stored daily sketches, beside the exact count: is the
    estimate within four standard errors?"""
    week = user_sets.sketched_users(_stored_sets(t, user_sets.daily_sketches(t.feed), "sketches"),
                                    *WEEK, by=("os", "country"))
    exact = during_days(t.feed, *WEEK).groupBy("os", "country").agg(
        F.count_distinct("user_id").alias("exact_users"))
    bound = F.greatest(F.lit(1.0), 4 * user_sets.sketch_error() * F.col("exact_users"))
    return week.join(exact, ["os", "country"]).select(
        "os", "country", "exact_users",
        (F.abs(F.col("users") - F.col("exact_users")) <= bound).alias("within"))


def _sketched_overlap(t):
    feed, messages = [_stored_sets(t, user_sets.daily_theta(events), "theta") for events in t.both]
    return user_sets.sketched_overlap(feed, messages, *WEEK)


def _bitmap_users(t):
    bitmaps = _stored_sets(t, user_sets.daily_bitmaps(t.feed), "bitmaps")
    return user_sets.bitmap_users(bitmaps, *WEEK, by=("os", "source", "country"))


def _rolling_users(t):
    bitmaps = _stored_sets(t, user_sets.daily_bitmaps(t.feed, ("os",)), "bitmaps")
    return user_sets.rolling_users(bitmaps, 7, by=("os",))


def _incremental_bootstrap(t):
    """Replicates of the experiment from daily sums, stored in two runs."""
    path = new_path(t.spark, "replicates")
    for first, last in ((START, SPLIT - timedelta(microseconds=1)), (SPLIT, END)):
        days = daily_experiment_users(t.feed, first, last, (1, 2))
        store_days(daily_replicates(days, REPLICATES, SEED, "md5"), path)
    return bootstrap_of_days(read_days(t.spark, path), START.date(), END.date())


def _bucketed_activity(t):
    """Activity per user from tables hashed by user, the messages also by recipient."""
    names = []
    for rows, column in ((t.feed, "user_id"), (t.messages, "user_id"), (t.messages, "reciever_id")):
        path = new_path(t.spark, "bucketed")
        names.append("bucketed_" + path[-32:])
        write_bucketed(rows, names[-1], column, 8, path)
    feed, messages, received = map(t.spark.table, names)
    return activity.user_activity(feed, messages, received_from=received)


def _user_history(t):
    """Everything one user did in the feed in a week, from the clustered table."""
    path = new_path(t.spark, "clustered")
    write_clustered(t.feed, path, 4)
    return during_days(user_rows(t.spark.read.parquet(path), USER, 4), *WEEK).drop("event_date")


def _streamed_intervals(spark, sf_dir, exact=True):
    """All closed intervals of the event stream, written by a streaming query."""
    events = stream_events(spark, sf_dir)
    metrics = interval_stream(feed_from_events(events), messages_from_events(events), exact)
    target, checkpoint = new_path(spark, "intervals"), new_path(spark, "intervals-checkpoint")
    query = write_intervals(metrics, target, checkpoint)
    query.awaitTermination()
    return spark.read.schema(metrics.schema).parquet(target)


def _streamed_alerts(spark, sf_dir):
    """Alerts of all closed intervals, raised by a streaming query."""
    events = stream_events(spark, sf_dir)
    metrics = interval_stream(feed_from_events(events), messages_from_events(events))
    target = new_path(spark, "alerts")
    query = start_alerts(metrics, new_path(spark, "alert-intervals"), target,
                         new_path(spark, "alerts-checkpoint"))
    query.awaitTermination()
    return read_alerts(spark, target)


def _stateful_alerts(spark, sf_dir):
    """The same alerts from state alone."""
    events = stream_events(spark, sf_dir)
    metrics = interval_stream(feed_from_events(events), messages_from_events(events))
    target = new_path(spark, "stateful-alerts")
    start_stateful_alerts(metrics, target, new_path(spark, "stateful-checkpoint")).awaitTermination()
    return read_stateful_alerts(spark, target)


def _repaired(spark, sf_dir):
    """Alerts of all days after a stream that took the newest day first, day by day repaired."""
    t = Tables(spark, sf_dir)
    intervals, alerts_path = new_path(spark, "alert-intervals"), new_path(spark, "alerts")
    events = stream_events(spark, sf_dir)
    late = interval_stream(*[f(events).where(f"to_date(time) = '{CLOCK.today}'")
                             for f in (feed_from_events, messages_from_events)])
    start_alerts(late, intervals, alerts_path, new_path(spark, "checkpoint")).awaitTermination()
    for day in REPAIRED:
        repair_day(*t.both, day, intervals, alerts_path)
    return read_alerts(spark, alerts_path).where(F.col("date").isin(*REPAIRED))


def _disordered(spark, sf_dir):
    """Alerts of all whole days after a stream that took the days out of order, repaired by itself."""
    t = Tables(spark, sf_dir)
    source, target = new_path(spark, "disordered"), new_path(spark, "any-order")
    day = F.dayofmonth("ts")
    for part in range(4):  # each file spans the month; files are taken by age
        t.events.where(day % 4 == part).coalesce(1).write.mode("append").parquet(source)
    events = spark.readStream.schema(t.events.schema).options(**SOURCE_OPTIONS).parquet(source)
    run_in_any_order((feed_from_events(events), messages_from_events(events)), t.both, target)
    return read_alerts(spark, f"{target}/alerts").where(F.col("date") <= F.lit(DAY))


def _smoothed(t, method):
    names = {"single": MESSENGER_METRICS, "holt": FEED_METRICS}[method]
    return alerts.smoothed_metrics(t.metrics(), names)


def _banded(t, method, band="trailing"):
    return add_band(_smoothed(t, method), band=band)


def _alerts(band):
    return lambda t: alerts.banded_metrics(t.metrics(), band)


_OVER_TABLES = {
    # feed report
    "feed_daily": lambda t: feed_report.feed_daily(t.feed, CLOCK),
    "feed_daily_by_day": _feed_daily_by_day,
    "feed_week_head": lambda t: feed_report.feed_week_head(
        feed_report.feed_daily(t.feed, CLOCK)),
    "feed_latest_message": lambda t: feed_report.feed_latest_message(
        feed_report.feed_daily(t.feed, CLOCK)),
    # daily cube
    "user_feed_stats": lambda t: activity.user_feed_stats(t.feed),
    "user_feed_stats_tsv": _tsv_round_trip,
    "tsv_escapes": _tsv_escapes,
    "messages_received": lambda t: activity.received_per_user(t.messages),
    "messages_sent": lambda t: activity.sent_per_user(t.messages),
    "user_message_stats": lambda t: activity.user_message_stats(t.messages),
    "user_activity": lambda t: activity.user_activity(*t.both),
    "user_activity_bucketed": _bucketed_activity,
    "user_history_clustered": _user_history,
    "daily_cube": lambda t: daily_cube(*t.both, CLOCK),
    "daily_cube_one_day": lambda t: daily_cube(*t.both, CLOCK, date_scope="day"),
    "daily_cube_stored": _stored_cube,
    "daily_cube_incremental": _incremental_cube,
    # audience report
    "feed_only_users": lambda t: audience.feed_only_users(*t.both, DAY),
    "messenger_only_users": lambda t: audience.messenger_only_users(*t.both, DAY),
    "both_users": lambda t: audience.both_users(*t.both, DAY),
    "user_overlap": lambda t: audience.user_overlap(*t.both, DAY),
    "user_overlap_by_name": _overlap_by_name,
    "user_overlap_pct": lambda t: audience.overlap_shares(audience.user_overlap(*t.both, DAY)),
    "segment_daily": lambda t: t.segments(),
    "segment_daily_full": lambda t: t.segments("full"),
    "per_user_daily_means": lambda t: segments.per_user_daily_means(t.segments()),
    "daily_totals": lambda t: segments.daily_totals(t.segments()),
    "source_os_users": lambda t: segments.source_os_users(t.feed, DAY),
    "source_pivot": lambda t: segments.pivot_users(
        segments.source_os_users(t.feed, DAY), "source", SOURCES),
    "os_pivot": lambda t: segments.pivot_users(
        segments.source_os_users(t.feed, DAY), "os", SYSTEMS),
    "audience_summary": lambda t: audience_report(*t.both, CLOCK).summary,
    "weekly_users_sketched": _sketched_users,
    "weekly_users_bitmap": _bitmap_users,
    "rolling_users_bitmap": _rolling_users,
    "weekly_overlap_sketched": _sketched_overlap,
    # anomaly check
    "smooth_history": _history,
    "interval_metrics": lambda t: t.metrics(),
    "interval_metrics_by_label": lambda t: t.metrics("interval"),
    "smooth_single": lambda t: _smoothed(t, "single"),
    "smooth_holt": lambda t: _smoothed(t, "holt"),
    "band_single": lambda t: _banded(t, "single"),
    "band_holt": lambda t: _banded(t, "holt"),
    "alerts_centered": _alerts("centered"),
    "alerts_trailing": _alerts("trailing"),
    "check_alerts": lambda t: alerts.check_alerts(*t.both, ALERT_AS_OF).select(
        "metric", "date", "time", "interval", "value", "is_alert", "message"),
    "alerts_latest": lambda t: alerts.with_message(latest_points(_alerts("trailing")(t))),
    # experiments
    "ab_users": lambda t: t.users(0, 1, 2, 3),
    "ab_group_ctr": lambda t: group_ctr(t.users(1, 2), (1, 2)),
    "ab_smoothed_ctr": lambda t: t.smoothed(),
    "ab_linearized": lambda t: t.linearized(1, 2),
    "ab_buckets": lambda t: t.buckets(),
    "welch_ctr": lambda t: welch_test(t.users(1, 2), "ctr", (1, 2)),
    "welch_ctr_0_3": lambda t: welch_test(t.users(0, 3), "ctr", (0, 3)),
    "welch_smoothed": lambda t: welch_test(t.smoothed(), "smoothed_ctr", (1, 2)),
    "welch_linearized_0_3": lambda t: welch_test(t.linearized(0, 3), "lin_likes", (0, 3)),
    "welch_linearized_1_2": lambda t: welch_test(t.linearized(1, 2), "lin_likes", (1, 2)),
    "welch_buckets": lambda t: welch_test(t.buckets(), "bucket_ctr", (1, 2)),
    "mwu_ctr": lambda t: mann_whitney_test(t.users(1, 2), "ctr", (1, 2)),
    "mwu_smoothed": lambda t: mann_whitney_test(t.smoothed(), "smoothed_ctr", (1, 2)),
    "mwu_buckets": lambda t: mann_whitney_test(t.buckets(), "bucket_ctr", (1, 2)),
    "mwu_small": lambda t: mann_whitney_test(
        bucketed(t.users(1, 2), n_buckets=FEW_BUCKETS), "bucket_ctr", (1, 2)),
    "bootstrap_ctr": lambda t: t.replicates(),
    "bootstrap_incremental": _incremental_bootstrap,
    "bootstrap_cells": lambda t: cells(t.users(1, 2)),
    # The draws differ from engine to engine; that all of them are there does not.
    "bootstrap_by_cell": lambda t: bootstrap_by_cell(t.users(1, 2), REPLICATES, SEED).select(
        "exp_group", F.col("replicate").cast("bigint")),
    "hist_ctr": lambda t: histogram(t.users(1, 2), "ctr", (1, 2)),
    "hist_ctr_0_3": lambda t: histogram(t.users(0, 3), "ctr", (0, 3)),
    "hist_smoothed": lambda t: histogram(t.smoothed(), "smoothed_ctr", (1, 2)),
    "hist_bootstrap": lambda t: histogram(
        t.replicates(), "global_ctr", (1, 2), common=False),
    "hist_buckets": lambda t: histogram(t.buckets(), "bucket_ctr", (1, 2)),
    "hist_linearized": lambda t: histogram(t.linearized(0, 3), "lin_likes", (0, 3)),
    "hist_linearized_1_2": lambda t: histogram(t.linearized(1, 2), "lin_likes", (1, 2)),
    "ctr_experiment": lambda t: ctr_experiment(t.users(1, 2)),
    "linearized_experiment": lambda t: linearized_experiment(t.users(0, 1, 2, 3)),
}


def _over_tables(build):
    return lambda spark, sf_dir: comparable(build(Tables(spark, sf_dir)))


QUERIES = {name: _over_tables(build) for name, build in _OVER_TABLES.items()} | {
    "stream_interval_metrics": lambda spark, sf_dir: comparable(
        _streamed_intervals(spark, sf_dir)),
    "stream_alerts": lambda spark, sf_dir: comparable(_streamed_alerts(spark, sf_dir)),
    "stream_alerts_stateful": lambda spark, sf_dir: comparable(_stateful_alerts(spark, sf_dir)),
    "stream_any_order": lambda spark, sf_dir: comparable(_disordered(spark, sf_dir)),
    "stream_repaired": lambda spark, sf_dir: comparable(_repaired(spark, sf_dir)),
}

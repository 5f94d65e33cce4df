"""The 15-minute metrics and their anomaly check as a Structured Streaming job."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clock import INTERVAL_MINUTES
from tidemark.functions.scalars import during_days, interval_label, percent
from tidemark.operators.intervals import MESSENGER_METRICS
from tidemark.plans.alerts import DEFAULTS, banded_metrics, with_message

INTERVAL = f"{INTERVAL_MINUTES} minutes"
COUNTS = ("likes", "views", "messages_sent")
# Stated, since an empty table has no file to take a schema from.
POINT_ROWS = T.StructType([
    *[T.StructField(name, kind) for name, kind in (
        ("metric", T.StringType()), ("date", T.DateType()), ("time", T.TimestampType()),
        ("interval", T.StringType()))],
    *[T.StructField(name, T.DoubleType()) for name in (
        "value", "smooth", "smooth_75", "smooth_25", "iqr", "deviation", "smooth_upper",
        "smooth_lower")],
    T.StructField("is_alert", T.BooleanType()), T.StructField("message", T.StringType())])


def interval_stream(feed, messages, exact=True, delay=INTERVAL, rsd=0.01):
    """Closed intervals in which both products saw events.

    Works on streaming and on batch inputs. Both tables are unioned and
    aggregated together, which equals joining two interval tables but needs no
    join state. Streams cannot count distinct values directly:

    * `exact=True` first aggregates per (interval, user), then per interval. The
      large state is spread by user, so a crowded interval is no hot task.
    * `exact=False` keeps one sketch per interval instead: far less state.

    Events later than `delay` behind the newest one are dropped by the
    watermark; `dropped_rows` tells how many, `repair_day` counts a day anew.
    """
    events = (_tagged(feed, "feed").unionByName(_tagged(messages, "message"))
              .withWatermark("time", delay))
    is_feed, is_message = F.col("kind") == "feed", F.col("kind") == "message"
    likes = F.count_if(is_feed & (F.col("action") == "like")).alias("likes")
    views = F.count_if(is_feed & (F.col("action") == "view")).alias("views")
    sent = F.count_if(is_message).alias("messages_sent")
    if exact:
        per_user = events.groupBy(F.window("time", INTERVAL), "user_id").agg(
            likes, views, sent, F.bool_or(is_feed).alias("in_feed"),
            F.bool_or(is_message).alias("in_messenger"))
        closed = per_user.groupBy(F.window("window", INTERVAL)).agg(
            *[F.sum(c).alias(c) for c in COUNTS],
            F.count_if("in_feed").alias("feed_users"),
            F.count_if("in_messenger").alias("messenger_users"))
    else:
        closed = events.groupBy(F.window("time", INTERVAL)).agg(
            likes, views, sent,
            F.approx_count_distinct(F.when(is_feed, F.col("user_id")), rsd).alias("feed_users"),
            F.approx_count_distinct(F.when(is_message, F.col("user_id")), rsd
                                    ).alias("messenger_users"))
    start = F.col("window.start")
    return (closed.where((F.col("feed_users") > 0) & (F.col("messenger_users") > 0))
            .select(F.to_date(start).alias("date"), start.alias("time"),
                    interval_label(start).alias("interval"), "feed_users", "likes", "views",
                    percent("likes", "views").alias("ctr"), *MESSENGER_METRICS))


def _tagged(events, kind):
    action = F.col("action") if "action" in events.columns else F.lit(None).cast("string")
    return events.select("time", "user_id", action.alias("action"), F.lit(kind).alias("kind"))


def write_intervals(stream, path, checkpoint, available_now=True):
    """Append closed intervals to a Parquet table, exactly once."""
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def dropped_rows(query):
    """Rows that arrived behind the watermark, in the triggers that the query remembers."""
    return sum(state.numRowsDroppedByWatermark
               for progress in query.recentProgress for state in progress.stateOperators)


def _slots(rows):
    """Rows by the directory that identifies them: the day and the interval."""
    return rows.withColumn("slot", F.date_format("time", "HHmm"))


def _replace_slots(rows, path):
    """Overwrite the directories of these intervals, and no others.

    A replayed batch, or the same events again from a new checkpoint, end in the
    same directories, so an interval is never there twice.
    """
    (_slots(rows).repartition("date").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("date", "slot").parquet(path))


def _replace_day(rows, path, day):
    """Overwrite a whole day, intervals that are no longer found included."""
    (_slots(rows).drop("date").write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy("slot").parquet(f"{path}/date={day}"))


def read_intervals(spark, path, schema):
    """The interval table written by `start_alerts`; `schema` is that of its stream."""
    return _read_slots(spark, path, schema).select(*schema.names)


def _read_slots(spark, path, schema):
    slotted = T.StructType([*schema, T.StructField("slot", T.StringType())])
    return spark.read.schema(slotted).parquet(path)


def start_alerts(stream, intervals_path, alerts_path, checkpoint, band="trailing",
                 settings=DEFAULTS, available_now=True):
    """Check every newly closed interval against the band of its day.

    Both tables hold one directory per interval, so replaying a batch or starting again
    with a new checkpoint leaves the same rows. The alert table keeps every checked point
    with its flag: an alert that a later run takes back is overwritten. The band
    needs the day so far, at most 96 rows per metric, read back from the interval
    table; the smoothing puts them in time order, since a batch brings its rows in any.
    """
    schema = stream.schema

    def handle(batch, batch_id):
        spark = batch.sparkSession
        # Two actions follow; without this the second runs the stateful stages again.
        batch.persist()
        _replace_slots(batch, intervals_path)
        first, last = batch.agg(F.min("date"), F.max("date")).first()
        if first is None:
            batch.unpersist()
            return
        days = (_read_slots(spark, intervals_path, schema)
                .where(F.col("date").between(F.lit(first), F.lit(last))))
        points = with_message(banded_metrics(days.drop("slot"), band, settings))
        fresh = F.broadcast(batch.select("time"))  # the intervals of one batch
        _replace_slots(points.join(fresh, "time", "left_semi").select(*POINT_ROWS.names),
                       alerts_path)
        batch.unpersist()

    writer = (stream.writeStream.outputMode("append").foreachBatch(handle)
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def repair_day(feed, messages, day, intervals_path, alerts_path, band="trailing",
               settings=DEFAULTS, exact=True):
    """Count a day anew from the event tables and replace its intervals and alerts.

    For days of which the stream dropped late rows. `feed` and `messages` are batch
    inputs; only `day` of them is read. Running it again changes nothing.
    """
    spark = feed.sparkSession
    metrics = interval_stream(during_days(feed, day, day), during_days(messages, day, day), exact)
    _replace_day(metrics, intervals_path, day)
    schema = T.StructType([f for f in metrics.schema if f.name != "date"])
    stored = (spark.read.schema(T.StructType([*schema, T.StructField("slot", T.StringType())]))
              .parquet(f"{intervals_path}/date={day}").drop("slot")
              .withColumn("date", F.lit(day).cast("date")))
    points = with_message(banded_metrics(stored.select(*metrics.columns), band, settings))
    _replace_day(points.select(*POINT_ROWS.names), alerts_path, day)


def read_alerts(spark, alerts_path):
    return (_read_slots(spark, alerts_path, POINT_ROWS).where("is_alert")
            .select(*POINT_ROWS.names))

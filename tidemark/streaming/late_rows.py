"""Rows that a stream drops because they are late: diverted to a table, their days repaired.

The stateful stream (`streaming.intervals`) drops rows of intervals that its watermark has closed
and only counts them. A second query over the same files finds these rows itself: a row
is late if its interval ended `delay` or more before the newest event of the files that came earlier. It takes one
file at a time, so it knows at least the watermark that any other division into batches
gives, and misses no row that was dropped. Its state is one row per batch, the newest time.

Late rows are written whole, one directory per batch, so a replayed batch replaces itself.
`repair_late` counts the days they name anew, once both queries have come to rest, and notes
the batches it has dealt with.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.functions.scalars import interval_start
from tidemark.plans.alerts import DEFAULTS
from tidemark.streaming.intervals import INTERVAL, interval_stream, repair_day, start_alerts

LATE_ROWS = "time timestamp, user_id bigint, kind string, late_behind timestamp, batch bigint"
NEWEST = "newest timestamp, batch bigint"
REPAIRED = "batch bigint"
SOURCE_OPTIONS = {"maxFilesPerTrigger": 1}


def _stored(spark, path, schema):
    """A table that may not be there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def divert_late(feed, messages, late_path, checkpoint, delay=INTERVAL, available_now=True):
    """Start the query that writes late rows of both streams to `late_path`.

    Read the streams with `SOURCE_OPTIONS`: one file per batch.
    """
    events = (feed.select("time", "user_id", F.lit("feed").alias("kind"))
              .unionByName(messages.select("time", "user_id", F.lit("message").alias("kind"))))

    def handle(batch, batch_id):
        spark = batch.sparkSession
        before = _stored(spark, f"{late_path}/newest", NEWEST).where(F.col("batch") < batch_id)
        behind = F.broadcast(before.agg((F.max("newest") - F.expr(f"interval {delay}"))
                                        .alias("late_behind")))  # one row
        ended = batch.withColumn("ended", interval_start() + F.expr(f"interval {INTERVAL}"))
        late = ended.join(behind, F.col("ended") <= F.col("late_behind"))
        (late.select("time", "user_id", "kind", "late_behind")
         .write.mode("overwrite").parquet(f"{late_path}/rows/batch={batch_id}"))
        (batch.agg(F.max("time").alias("newest"))
         .write.mode("overwrite").parquet(f"{late_path}/newest/batch={batch_id}"))

    writer = events.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def late_rows(spark, late_path):
    """The diverted rows that no repair has dealt with."""
    done = _stored(spark, f"{late_path}/repaired", REPAIRED)
    return _stored(spark, f"{late_path}/rows", LATE_ROWS).join(done, "batch", "left_anti")


def repair_late(feed, messages, late_path, intervals_path, alerts_path, band="trailing",
                settings=DEFAULTS, exact=True):
    """Replace the days that late rows name, counted anew from the batch tables; these days.

    Cut short, it starts over with the days that are left and changes nothing that is right.
    """
    spark = feed.sparkSession
    rows = late_rows(spark, late_path)
    batches = [r[0] for r in rows.select("batch").distinct().collect()]
    days = sorted(r[0] for r in rows.select(F.to_date("time")).distinct().collect())
    for day in days:
        repair_day(feed, messages, day, intervals_path, alerts_path, band, settings, exact)
    if batches:
        (spark.createDataFrame([(b,) for b in batches], REPAIRED).coalesce(1)
         .write.mode("append").parquet(f"{late_path}/repaired"))
    return days


def run_in_any_order(streams, tables, path, band="trailing", settings=DEFAULTS, exact=True):
    """Take in all files that are there, in whatever order they came, and leave the intervals
    and alerts of a batch run under `path`; the days that were repaired.

    `streams` and `tables` are (feed, messages) as streams, read with `SOURCE_OPTIONS`, and as
    batch tables. A later call goes on where this one ended.
    """
    intervals_path, alerts_path, late_path = (f"{path}/{n}" for n in ("intervals", "alerts", "late"))
    queries = [
        start_alerts(interval_stream(*streams, exact), intervals_path, alerts_path,
                     f"{path}/alerts-checkpoint", band, settings),
        divert_late(*streams, late_path, f"{path}/late-checkpoint")]
    for query in queries:
        query.awaitTermination()
    return repair_late(*tables, late_path, intervals_path, alerts_path, band, settings, exact)

"""Event tables laid out for what reads them: by user, or by user and time inside a day.

`write_bucketed` keeps a table hashed by a user column. Aggregates per user and joins of
such tables then need no shuffle, as long as both have the same number of buckets.

`write_clustered` splits a day's rows among files by a hash of the user, sorts each file by time and
adds a bloom filter on the user to each row group. A question about one user opens one part of
a day and there the row groups that may hold the user, one about some minutes the row groups of these
minutes; Parquet decides from the footers.
"""

from contextlib import contextmanager

from pyspark.sql import functions as F

ROW_GROUP_BYTES = 16 * 1024 * 1024
TIMESTAMPS = "spark.sql.parquet.outputTimestampType"
#: Set to false, lets a join on (user, demographics) use tables that are hashed by the user alone.
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def write_bucketed(events, table, column="user_id", buckets=512, path=None):
    """Save `events` as the table `table`, hashed by `column` and sorted by it in every file.

    The rows are dealt to as many tasks as buckets first: one file per bucket instead of
    one per task and bucket. A bucket should fit the memory of a task after aggregation.
    """
    writer = (events.repartition(buckets, column).write.mode("overwrite")
              .bucketBy(buckets, column).sortBy(column))
    (writer.option("path", path) if path else writer).saveAsTable(table)


@contextmanager
def times_with_statistics(spark):
    """Inside, timestamps are written in the form that has minima and maxima in Parquet's footers;
    Spark's default form has none."""
    before = spark.conf.get(TIMESTAMPS)
    spark.conf.set(TIMESTAMPS, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        spark.conf.set(TIMESTAMPS, before)


def _part(user, files_per_day):
    return F.pmod(F.xxhash64(user.cast("bigint")), F.lit(files_per_day)).cast("int")


def write_clustered(events, path, files_per_day=32, row_group_bytes=ROW_GROUP_BYTES,
                    users_per_group=100_000, mode="overwrite"):
    """Lay `events` out by day, each day in `files_per_day` parts by user, sorted by time.

    `users_per_group` sizes the bloom filters. With `mode="days"` only the days of `events` are
    replaced.
    """
    rows = events.withColumns({"event_date": F.to_date("time"),
                               "part": _part(F.col("user_id"), files_per_day)})
    sorted_rows = rows.repartition("event_date", "part").sortWithinPartitions(
        "event_date", "part", "time")
    with times_with_statistics(events.sparkSession):
        (sorted_rows.write.mode("overwrite" if mode == "days" else mode)
         .option("partitionOverwriteMode", "dynamic" if mode == "days" else "static")
         .option("parquet.block.size", row_group_bytes)
         .option("parquet.bloom.filter.enabled#user_id", "true")
         .option("parquet.bloom.filter.expected.ndv#user_id", users_per_group)
         .partitionBy("event_date", "part").parquet(path))


def user_rows(table, user, files_per_day=32):
    """The rows of one user of a table that `write_clustered` laid out: one part of each day."""
    return table.where((F.col("user_id") == F.lit(user))
                       & (F.col("part") == _part(F.lit(user), files_per_day))).drop("part")

"""Stored sets of users: one directory per day, replaced as a whole."""

from pyspark.sql import functions as F


def store_days(sets, path):
    """Write daily sketches or bitmaps; the days they hold replace those stored before, all other
    days stay. A day has a few rows per segment, so the days of a run share few files."""
    (sets.hint("rebalance", "date").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path))


def read_days(spark, path, first=None, last=None):
    """Stored sets, of the days `first`..`last` if given: other directories are not opened."""
    sets = spark.read.option("basePath", path).parquet(path)
    if first is not None:
        sets = sets.where(F.col("date").between(F.lit(first), F.lit(last)))
    return sets

"""Which day folders of a table changed since a job last read them.

Spark never changes a file: appending adds files, replacing a day gives it new ones. So the
names of a day's files tell whether it changed, and listing them reads no data. What a
job has read is remembered in a small table beside its results, written as one
file per run; the last run counts.
"""

import re
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.sources.schemas import conform

SEEN = "run bigint, event_date date, files array<string>"
DAY = re.compile(r"/event_date=(\d{4}-\d{2}-\d{2})/")


def day_files(spark, path, schema):
    """Day -> sorted names of its files, for a table that `write_by_day` laid out; the
    driver lists files as for any read of the table."""
    found = {}
    for file in conform(spark.read.parquet(path), schema).inputFiles():
        day = DAY.search(file)
        if not day:
            raise ValueError(f"{path} is not laid out by event_date")
        found.setdefault(date.fromisoformat(day[1]), []).append(file.rpartition("/")[2])
    return {day: sorted(files) for day, files in found.items()}


def known_files(spark, path):
    """Day -> files as of the last run; nothing before the first one."""
    try:
        runs = spark.read.schema(SEEN).parquet(f"{path}/seen")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    last = runs.agg(F.max("run")).first()[0]
    return {r["event_date"]: r["files"] for r in runs.where(F.col("run") == last).collect()
            if r["event_date"]}


def changed_days(now, before):
    """Days whose files differ from before; days that are gone have nothing to read."""
    return sorted(day for day, files in now.items() if before.get(day) != files)


def remember_files(spark, files, path, days):
    """Store what has been read, unless nothing changed. A row without day stands for a run that
    found no days."""
    before = known_files(spark, path)
    if not days and set(files) == set(before):
        return
    try:
        run = spark.read.schema(SEEN).parquet(f"{path}/seen").agg(F.max("run")).first()[0] or 0
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        run = 0
    rows = [(run + 1, day, names) for day, names in files.items()] or [(run + 1, None, [])]
    spark.createDataFrame(rows, SEEN).coalesce(1).write.mode("append").parquet(f"{path}/seen")

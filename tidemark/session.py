"""Session settings the jobs are written for.

Every function in the package takes the caller's session as it is; this module
only offers a session with the settings we recommend.
"""

import math

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates and 15-minute buckets are calendar facts of the data, not of the host.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Timestamps with minima and maxima in Parquet's footers; the default form has none.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Streaming state is keyed by (interval, user): keep it off the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    # Call sites of every column expression: costs more than planning small jobs.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def cluster_settings(cores, largest_shuffle_gb):
    """Partition counts for a cluster, as keyword overrides of `build_session`.

    Shuffles start with about 128 MB per partition and at least three per core;
    AQE merges what turns out small and splits skewed join partitions.
    """
    partitions = max(3 * cores, math.ceil(largest_shuffle_gb * 1024 / 128))
    return {
        "spark__sql__shuffle__partitions": partitions,
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "128m",
        "spark__sql__files__maxPartitionBytes": "256m",
    }


def build_session(app_name="tidemark", master=None, **overrides):
    """A session with `SETTINGS`; keyword overrides win (dots as `__`).

    On a cluster add `**cluster_settings(...)`.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {k.replace("__", "."): str(v) for k, v in overrides.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

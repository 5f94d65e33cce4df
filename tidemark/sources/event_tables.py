"""Readers for the two append-only event tables.

A table is found by Parquet path, by database name in the catalog, or through
JDBC. Nothing is read until an action runs; filters and column pruning of the
jobs reach the scan.
"""

import re

from pyspark.sql import functions as F

from tidemark.sources.schemas import FEED_ACTIONS, MESSAGE_ACTIONS, conform


def feed_actions(spark, path=None, database=None):
    return _table(spark, "feed_actions", FEED_ACTIONS, path, database)


def message_actions(spark, path=None, database=None):
    return _table(spark, "message_actions", MESSAGE_ACTIONS, path, database)


def _table(spark, name, schema, path, database):
    if (path is None) == (database is None):
        raise ValueError("give either a path or a database name")
    df = spark.read.parquet(path) if path else spark.table(f"{database}.{name}")
    return conform(df, schema)


def jdbc_options(url, query_or_table, *, partition_column=None, lower=None, upper=None,
                 partitions=None, fetch_size=10_000, properties=None):
    """Options of a JDBC read; credentials come from the caller, never from here.

    Without a partition column JDBC yields one task, so a large table must name
    one with both bounds and a number of partitions; `lower`/`upper` only shape the
    split, they filter nothing. Common table expressions go ahead of the query that
    Spark wraps, because several databases refuse them in parentheses; they cannot
    be split.
    """
    options = {"url": url, "fetchsize": str(fetch_size)}
    is_query = re.match(r"\s*select\s", query_or_table, re.IGNORECASE)
    if re.match(r"\s*with\s", query_or_table, re.IGNORECASE):
        if partition_column is not None:
            raise ValueError("a WITH query cannot be split; name a table or a SELECT")
        tables, last = _split_common_tables(query_or_table)
        options |= {"prepareQuery": tables, "query": last}
    elif partition_column is None:
        options["query" if is_query else "dbtable"] = query_or_table
    else:
        if None in (lower, upper, partitions):
            raise ValueError("a partition column needs lower, upper and partitions")
        options |= {
            "dbtable": f"({query_or_table}) source" if is_query else query_or_table,
            "partitionColumn": partition_column, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(partitions)}
    return options | (properties or {})


def _split_common_tables(query):
    """The WITH clause and the SELECT after it: the first one outside parentheses and quotes."""
    depth, quote = 0, None
    for i, c in enumerate(query):
        if quote:
            quote = None if c == quote else quote
        elif c in "'\"":
            quote = c
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif depth == 0 and i and not query[i - 1].isalnum() and re.match(
                r"select\s", query[i:], re.IGNORECASE):
            return query[:i].strip(), query[i:]
    raise ValueError("no SELECT after the WITH clause")


def read_jdbc(spark, url, query_or_table, **kwargs):
    """Result of a database query, for users with a driver on the class path."""
    return spark.read.format("jdbc").options(**jdbc_options(url, query_or_table, **kwargs)).load()


def write_by_day(events, path, mode="overwrite"):
    """Lay an event table out by day, so that daily jobs open only their days.

    The rebalance hint lets AQE split a day that dwarfs the others and merge
    small ones, instead of one task per day. `mode="append"` adds to the days that are
    there, `"days"` replaces the days of `events` and no other.
    """
    rows = events.withColumn("event_date", F.to_date("time")).hint("rebalance", "event_date")
    writer = rows.write.mode("overwrite" if mode == "days" else mode)
    if mode == "days":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("event_date").parquet(path)

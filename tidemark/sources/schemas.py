"""Contracts of the two event tables and of the daily fact table."""

from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(spec):
    return T.StructType([T.StructField(name, kind) for name, kind in spec])


# Column names as the upstream tables spell them.
FEED_ACTIONS = _schema([
    ("user_id", T.LongType()),
    ("time", T.TimestampType()),
    ("action", T.StringType()),
    ("gender", T.LongType()),
    ("age", T.LongType()),
    ("os", T.StringType()),
    ("source", T.StringType()),
    ("country", T.StringType()),
    ("exp_group", T.LongType()),
])

MESSAGE_ACTIONS = _schema([
    ("user_id", T.LongType()),
    ("time", T.TimestampType()),
    ("reciever_id", T.LongType()),
    ("gender", T.LongType()),
    ("age", T.LongType()),
    ("os", T.StringType()),
    ("source", T.StringType()),
    ("country", T.StringType()),
])

DAILY_ACTIVITY = _schema([
    ("event_date", T.DateType()),
    ("dimension", T.StringType()),
    ("dimension_value", T.StringType()),
    ("views", T.LongType()),
    ("likes", T.LongType()),
    ("messages_received", T.LongType()),
    ("messages_sent", T.LongType()),
    ("users_received", T.LongType()),
    ("users_sent", T.LongType()),
])


def conform(df, schema):
    """Select the contract's columns in order, cast to its types.

    `timestamp_ntz` becomes `timestamp` here, once: watermarks need it. A
    layout column `event_date` is kept when the table has one. Ids and grouping
    keys are non-null by contract.
    """
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    if "event_date" in df.columns and "event_date" not in schema.names:
        columns.append(F.col("event_date"))
    return df.select(*columns)

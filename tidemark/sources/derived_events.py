"""The two event tables derived from a generic `events` table.

`events` has (ts, user_id, event_type, props); demographics follow from the
user id, the recipient of a message from the `k` field of `props`. Used by the
checks and the bench, which have no other event data.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.schemas import FEED_ACTIONS, MESSAGE_ACTIONS, conform

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# Fixed values of the derivation.
COUNTRIES = ("Russia", "Ukraine", "Belarus", "Kazakhstan", "Turkey")
FEED_TYPES = ("view", "error", "click")
LIKE_TYPE = "click"
MESSAGE_TYPES = ("purchase", "signup")


def read_events(spark, sf_dir):
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark, sf_dir):
    """The same table as a stream; a pattern, so that it may be one file or a folder."""
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parquet*")


def feed_from_events(events):
    rows = events.where(F.col("event_type").isin(*FEED_TYPES)).withColumn(
        "action", F.when(F.col("event_type") == LIKE_TYPE, "like").otherwise("view"))
    return conform(_with_user(rows), FEED_ACTIONS)


def messages_from_events(events):
    rows = events.where(F.col("event_type").isin(*MESSAGE_TYPES)).withColumn(
        "reciever_id", F.get_json_object("props", "$.k").cast("bigint"))
    return conform(_with_user(rows), MESSAGE_ACTIONS)


def _with_user(rows):
    user = F.col("user_id")
    return rows.withColumns({
        "time": F.col("ts"),
        "gender": user % 2,
        "age": 14 + (user * 7) % 50,
        "os": F.when(user % 3 == 0, "iOS").otherwise("Android"),
        "source": F.when(user % 10 < 4, "organic").otherwise("ads"),
        "country": F.element_at(F.array(*map(F.lit, COUNTRIES)), (user % 5 + 1).cast("int")),
        "exp_group": user % 4,
    })

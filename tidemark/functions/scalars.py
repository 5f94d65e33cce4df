"""Column expressions shared by the operators. All of them stay in the JVM."""

from datetime import timedelta
from functools import reduce

from pyspark.sql import functions as F

from tidemark.functions.clock import INTERVAL_MINUTES, midnight, timestamp_literal


def ratio(numerator, denominator):
    """Floating-point quotient; NULL (not an error, not inf) on a zero denominator."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def percent(part, whole):
    return ratio(part, whole) * 100


def half_even(column, digits=2):
    """Round half to even."""
    return F.bround(_col(column), digits)


def count_action(name):
    return F.count_if(F.col("action") == name)


def distinct_users(column="user_id", exact=True, rsd=0.01):
    """Number of distinct values: exact, or a sketch of relative error `rsd`.

    Spark plans a single exact distinct count as a two-level aggregate keyed by
    (group, value), so one huge group is spread over all tasks; the sketch saves
    that extra shuffle.
    """
    return F.count_distinct(column) if exact else F.approx_count_distinct(column, rsd)


# The age bands of the segment report (inclusive upper bounds).
AGE_BANDS = ((17, "<18"), (30, "18-30"), (45, "30-45"))
OLDEST_BAND = "45+"


def age_band(age="age"):
    """Age band; an unknown age falls into the oldest band."""
    age = _col(age)
    first, *rest = AGE_BANDS
    band = F.when(age <= first[0], first[1])
    for upper, label in rest:
        band = band.when(age <= upper, label)
    return band.otherwise(OLDEST_BAND)


def interval_start(time="time"):
    """Start of the 15-minute interval an event belongs to."""
    return F.window(time, f"{INTERVAL_MINUTES} minutes").start


def interval_label(start):
    return F.date_format(start, "HH:mm")


def between_times(start, end, time="time"):
    """Both ends included; plain comparisons, so they reach the Parquet scan."""
    return (F.col(time) >= timestamp_literal(start)) & (F.col(time) <= timestamp_literal(end))


def during_days(df, first, last, time="time"):
    """Rows of the calendar days `first`..`last`, both included.

    Written as a half-open time range for row-group pruning; a table laid out
    by `event_date` is pruned to the matching directories as well.
    """
    kept = df.where((F.col(time) >= timestamp_literal(midnight(first)))
                    & (F.col(time) < timestamp_literal(midnight(last + timedelta(days=1)))))
    if "event_date" in df.columns:
        kept = kept.where(F.col("event_date").between(F.lit(first), F.lit(last)))
    return kept


def md5_words(text):
    """The digest of `text` as four unsigned 32-bit words, most significant first."""
    digest = F.md5(text)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def hash_bucket(identifier, salt="bucket", n_buckets=50):
    """Salted MD5 of an id, as a 128-bit number modulo `n_buckets`.

    The digest does not fit a long, so the remainder is carried through its
    four words; `n_buckets` must stay below 2**31 for the products to fit.
    """
    if not 0 < n_buckets < 2 ** 31:
        raise ValueError("n_buckets must be in 1 .. 2**31 - 1")
    words = md5_words(F.concat_ws("-", _col(identifier).cast("string"), F.lit(str(salt))))
    return reduce(lambda rest, word: (rest * F.lit(2 ** 32) + word) % n_buckets,
                  words, F.lit(0).cast("bigint"))


def _col(column):
    return F.col(column) if isinstance(column, str) else column

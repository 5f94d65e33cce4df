"""Anomaly check of the current day's 15-minute metrics."""

from dataclasses import dataclass

from pyspark.sql import functions as F

from tidemark.functions.scalars import half_even
from tidemark.operators.bands import add_band, latest_points
from tidemark.operators.intervals import (FEED_METRICS, MESSENGER_METRICS, as_series,
                                          interval_metrics)
from tidemark.operators.smoothing import holt, single, smooth_series
from tidemark.operators.smoothing_scan import Smoother, smooth_scan

# Fixed value: the alert text.
ALERT = "%s = %s, Отклонение = %s %%"


@dataclass(frozen=True)
class SmoothingSettings:
    """Parameters of the two checks."""

    window: int = 6
    coef: float = 2
    alpha_single: float = 0.85
    alpha_holt: float = 0.35
    beta_holt: float = 1.0


DEFAULTS = SmoothingSettings()
SERIES = ("metric",)
DAY_SERIES = ("metric", "date")


def smoothed_metrics(metrics, names=MESSENGER_METRICS + FEED_METRICS, settings=DEFAULTS,
                     key=DAY_SERIES):
    """Messenger metrics by simple smoothing, feed metrics by smoothing with trend.

    Every day is a series of its own, so no group grows with the history;
    `key=SERIES` smooths on over midnight.
    """
    level = single(settings.alpha_single)
    trend = holt(settings.alpha_holt, settings.beta_holt)
    recursions = dict.fromkeys(MESSENGER_METRICS, level) | dict.fromkeys(FEED_METRICS, trend)
    return smooth_series(as_series(metrics, names), recursions, key)


def smoothed_history(metrics, names=MESSENGER_METRICS + FEED_METRICS, settings=DEFAULTS):
    """As `smoothed_metrics(key=SERIES)`, for histories of any length: no task holds a series."""
    level = Smoother(settings.alpha_single)
    trend = Smoother(settings.alpha_holt, settings.beta_holt)
    smoothers = {name: level if name in MESSENGER_METRICS else trend for name in names}
    return smooth_scan(as_series(metrics, names), smoothers, SERIES)


def banded_metrics(metrics, band="trailing", settings=DEFAULTS, key=DAY_SERIES):
    """All six metrics with band and flag, day by day; see `smoothed_metrics`."""
    return add_band(smoothed_metrics(metrics, settings=settings, key=key),
                    settings.window, settings.coef, band, key)


def check_alerts(feed, messages, as_of, band="trailing", settings=DEFAULTS, exact=True):
    """Latest point of every metric whose value left its band, with a message.

    Just after midnight the day before is still in view and its points count as
    before: they are one series with those of the new day.
    """
    metrics = interval_metrics(feed, messages, as_of, exact=exact)
    banded = banded_metrics(metrics, band, settings, SERIES)
    return with_message(latest_points(banded)).where("is_alert")


def with_message(points):
    """Counts are shown as whole numbers, the deviation in hundredths, NULL as nan."""
    whole = F.col("value") == F.floor("value")
    shown = F.when(whole, F.floor("value").cast("string")).otherwise(
        F.coalesce(F.col("value").cast("string"), F.lit("nan")))
    return points.withColumn("message", F.format_string(
        ALERT, "metric", shown, F.coalesce(half_even("deviation").cast("string"), F.lit("nan"))))

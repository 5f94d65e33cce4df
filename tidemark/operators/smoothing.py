"""Exponential smoothing of metric series.

Both recursions need their points in order, so one series is one group. Its
length is the number of 15-minute intervals in view (at most 96 a day), never
the number of events; different series run in parallel.
"""

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def simple_levels(values, alpha):
    """Level after each point, starting at the first point."""
    smoothed, level = [], None
    for value in values:
        level = value if level is None else alpha * value + (1 - alpha) * level
        smoothed.append(level)
    return smoothed


def trend_forecasts(values, alpha, beta):
    """First point, then level + trend after each further point.

    The initial trend is the first difference. Fewer than two points have no
    trend, so no value beyond the first.
    """
    if len(values) < 2:
        return list(values)
    level, trend = values[0], values[1] - values[0]
    smoothed = [values[0]]
    for value in values[1:]:
        before = level
        level = alpha * value + (1 - alpha) * (before + trend)
        trend = beta * (level - before) + (1 - beta) * trend
        smoothed.append(level + trend)
    return smoothed


def single(alpha):
    return lambda values: simple_levels(values, alpha)


def holt(alpha, beta):
    return lambda values: trend_forecasts(values, alpha, beta)


def smooth_series(series, recursions, key=("metric",)):
    """Adds `smooth` to the points (metric, time, value) of every series.

    `recursions` gives each metric its recursion, so that metrics smoothed in
    different ways share one pass over the events. A missing value makes all
    later smoothed values missing.
    """
    schema = T.StructType([*series.schema, T.StructField("smooth", T.DoubleType())])

    def smooth(points: pd.DataFrame) -> pd.DataFrame:
        points = points.sort_values("time")
        recursion = recursions[points["metric"].iloc[0]]
        return points.assign(smooth=recursion(points["value"].astype("float64").tolist()))

    return series.groupBy(*key).applyInPandas(smooth, schema)

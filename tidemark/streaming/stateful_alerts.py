"""The anomaly check as a stateful stream: no interval is read back.

Each series (a metric's day) keeps what its next point needs: level and trend of the smoothing, the last
few smoothed values for the quartiles, the last ten band limits for their average. A point costs the
same at any hour, a micro-batch touches the state of its series only, and the result is appended as it
comes, exactly once. The state of a day is dropped with its last interval.

The batch check and `streaming.intervals.start_alerts` give the same points. Only the trailing band
can be computed as time passes; late rows are the business of `streaming.late_rows`.
"""

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tidemark.operators.bands import BAND_ROWS
from tidemark.operators.intervals import FEED_METRICS, MESSENGER_METRICS, as_series
from tidemark.plans.alerts import DAY_SERIES, DEFAULTS, with_message
from tidemark.streaming.intervals import POINT_ROWS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LAST_INTERVAL = "23:45"
STATE = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("level", T.DoubleType()),
    T.StructField("trend", T.DoubleType()), T.StructField("smooth", T.ArrayType(T.DoubleType())),
    T.StructField("upper", T.ArrayType(T.DoubleType())),
    T.StructField("lower", T.ArrayType(T.DoubleType()))])
POINTS = T.StructType([f for f in POINT_ROWS if f.name != "message"])


def full(values, rows):
    """The values, if there are `rows` of them and none is missing."""
    found = [v for v in values if v is not None]
    return found if len(found) == rows else None


class Band:
    """What one series remembers, and its next point."""

    def __init__(self, alpha, beta, settings, state=None):
        self.alpha, self.beta, self.settings = alpha, beta, settings
        self.n, self.level, self.trend, self.smooth, self.upper, self.lower = state or (
            0, None, None, [], [], [])

    def state(self):
        return self.n, self.level, self.trend, self.smooth, self.upper, self.lower

    def smoothed(self, value):
        """Level, or level and trend, behind the value. The trend begins with the first difference."""
        if value is None or (self.n and self.level is None):
            self.n, self.level = self.n + 1, None
            return None
        before, self.n = self.level, self.n + 1
        if before is None:
            self.level, self.trend = value, None
            return value
        if self.beta is None:
            self.level = self.alpha * value + (1 - self.alpha) * before
            return self.level
        trend = value - before if self.trend is None else self.trend
        self.level = self.alpha * value + (1 - self.alpha) * (before + trend)
        self.trend = self.beta * (self.level - before) + (1 - self.beta) * trend
        return self.level + self.trend

    def add(self, value):
        """The columns from `value` to `is_alert` of the next point."""
        window, coef = self.settings.window, self.settings.coef
        smooth = self.smoothed(value)
        self.smooth = [*self.smooth, smooth][-window:]
        recent = full(self.smooth, window)
        high, low, iqr, upper, lower = None, None, None, None, None
        if recent:
            high, low = (float(q) for q in np.quantile(recent, [0.75, 0.25]))
            iqr = high - low
            upper, lower = high + coef * iqr, low - coef * iqr
        self.upper = [*self.upper, upper][-BAND_ROWS:]
        self.lower = [*self.lower, lower][-BAND_ROWS:]
        uppers, lowers = full(self.upper, BAND_ROWS), full(self.lower, BAND_ROWS)
        limits = (sum(uppers) / BAND_ROWS, sum(lowers) / BAND_ROWS) if uppers else (None, None)
        known = value is not None and uppers is not None
        return (value, smooth, high, low, iqr,
                (value - smooth) / smooth * 100 if smooth else None, *limits,
                bool(value > limits[0] or value < limits[1]) if known else None)


class BandProcessor(StatefulProcessor):
    """Points of one series, in time order within and across batches."""

    def __init__(self, settings):
        self.settings = settings

    def init(self, handle):
        self.held = handle.getValueState("band", STATE)

    def handleInputRows(self, key, rows, timerValues):
        metric, date = key
        points = pd.concat(list(rows)).sort_values("time")
        single = metric in MESSENGER_METRICS
        state = self.held.get() if self.held.exists() else None
        band = Band(self.settings.alpha_single if single else self.settings.alpha_holt,
                    None if single else self.settings.beta_holt, self.settings,
                    state and tuple(list(x) if isinstance(x, (list, tuple, np.ndarray)) else x
                                    for x in state))
        values = [None if pd.isna(v) else float(v) for v in points["value"]]
        found = [(metric, date, time, interval, *band.add(value)) for time, interval, value in zip(
            points["time"], points["interval"], values)]
        if points["interval"].iloc[-1] == LAST_INTERVAL:
            self.held.clear()
        else:
            self.held.update(band.state())
        yield pd.DataFrame(found, columns=POINTS.names)

    def close(self):
        pass


def alert_points(metrics, settings=DEFAULTS, names=MESSENGER_METRICS + FEED_METRICS):
    """Every point of the stream of closed intervals with its band, flag and message."""
    metrics.sparkSession.conf.set(PROVIDER, ROCKSDB)  # the only store with state variables
    points = as_series(metrics, names).groupBy(*DAY_SERIES).transformWithStateInPandas(
        statefulProcessor=BandProcessor(settings), outputStructType=POINTS,
        outputMode="Append", timeMode="None")
    return with_message(points).select(*POINT_ROWS.names)


def start_stateful_alerts(metrics, path, checkpoint, settings=DEFAULTS, available_now=True):
    """Append all checked points of `interval_stream` to a Parquet table by day, exactly once."""
    writer = (alert_points(metrics, settings).writeStream.format("parquet").outputMode("append")
              .partitionBy("date").option("path", path).option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_stateful_alerts(spark, path):
    """The points that alerted."""
    return (spark.read.schema(POINT_ROWS).parquet(path).where(F.col("is_alert"))
            .select(*POINT_ROWS.names))

import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from conftest import rows
from tidemark.functions.clock import AsOf
from tidemark.operators.bands import add_band, latest_points
from tidemark.operators.intervals import interval_metrics, live_events
from tidemark.operators.smoothing import (holt, simple_levels, single, smooth_series,
                                          trend_forecasts)
from tidemark.plans.alerts import check_alerts, with_message

START = datetime(2024, 1, 29)


@pytest.fixture
def make_series(spark):
    def build(**series):
        return spark.createDataFrame(
            [(m, START.date(), START + timedelta(minutes=15 * i),
              f"{i // 4:02d}:{i % 4 * 15:02d}", v)
             for m, values in series.items() for i, v in enumerate(values)],
            "metric string, date date, time timestamp, interval string, value double")
    return build


def test_trend_check_vector():
    assert trend_forecasts([10, 12, 9, 15], 0.35, 1) == pytest.approx([10, 14, 12.5, 14.5])


def test_single_point_series():
    assert simple_levels([3.0], 0.85) == trend_forecasts([3.0], 0.35, 1) == [3.0]


def test_simple_smoothing_equals_pandas():
    values = np.random.default_rng(1).normal(size=50)
    assert simple_levels(list(values), 0.85) == pytest.approx(
        list(pd.Series(values).ewm(alpha=0.85, adjust=False).mean()))


def test_series_do_not_mix_and_order_does_not_matter(make_series):
    mixed = make_series(a=[1.0, 2.0, 3.0], b=[10.0, 0.0, 10.0]).orderBy("value")
    found = rows(smooth_series(mixed, {"a": single(0.5), "b": single(0.5)}), "metric", "time")
    assert [r["smooth"] for r in found] == [1, 1.5, 2.25, 10, 5, 7.5]


def test_missing_value_makes_the_rest_missing(make_series):
    found = rows(smooth_series(make_series(a=[1.0, 2.0, None, 4.0]), {"a": holt(0.35, 1)}), "time")
    assert [r["smooth"] is None for r in found] == [False, False, True, True]


def test_band_equals_pandas(make_series):
    values = list(np.random.default_rng(2).normal(100, 10, size=40).round(3).tolist())
    smoothed = smooth_series(make_series(a=values), {"a": single(0.85)})
    x = pd.Series(values)
    s = x.ewm(alpha=0.85, adjust=False).mean()
    q75, q25 = s.rolling(6).quantile(0.75), s.rolling(6).quantile(0.25)
    upper, lower = q75 + 2 * (q75 - q25), q25 - 2 * (q75 - q25)
    for band, center in (("centered", True), ("trailing", False)):
        frame = add_band(smoothed, band=band).toPandas().sort_values("time")
        expected = {"smooth_75": q75, "smooth_25": q25, "iqr": q75 - q25,
                    "deviation": (x - s) / s * 100,
                    "smooth_upper": upper.rolling(10, center=center).mean(),
                    "smooth_lower": lower.rolling(10, center=center).mean()}
        for name, column in expected.items():
            np.testing.assert_allclose(frame[name].astype(float), column, rtol=1e-9)


def test_centered_band_never_flags_the_latest_point(make_series):
    spike = smooth_series(make_series(a=[10.0] * 30 + [500.0]), {"a": single(0.85)})
    centered = rows(add_band(spike, band="centered"), "time")
    assert [r["is_alert"] for r in centered[-4:]] == [None] * 4
    trailing = with_message(latest_points(add_band(spike, band="trailing")))
    assert [(r["metric"], r["is_alert"]) for r in rows(trailing)] == [("a", True)]
    assert rows(trailing)[0]["message"].startswith("a = 500, ")


def test_live_window():
    assert AsOf.of("2024-01-30 23:07:00").live_start == datetime(2024, 1, 30)
    assert AsOf.of("2024-01-30 00:00:00").live_start == datetime(2024, 1, 29)
    assert AsOf.of("2024-01-30 23:07:41").open_interval == datetime(2024, 1, 30, 23)


def test_open_interval_and_earlier_days_are_left_out(make_feed):
    feed = make_feed([dict(user_id=i, time=t) for i, t in enumerate((
        datetime(2024, 1, 29, 23, 59), datetime(2024, 1, 30), datetime(2024, 1, 30, 22, 59, 59),
        datetime(2024, 1, 30, 23)))])
    assert {r.user_id for r in live_events(feed, "2024-01-30 23:07:00").collect()} == {1, 2}


def test_joins_on_start_and_on_label_agree(feed, messages):
    by_time = interval_metrics(feed, messages, "2024-01-30 23:07:00")
    by_label = interval_metrics(feed, messages, "2024-01-30 23:07:00", on="interval")
    assert rows(by_time, "time") == rows(by_label.select(*by_time.columns), "time")


def test_alerts_of_the_latest_interval(make_feed, make_messages):
    times = [datetime(2024, 1, 30) + timedelta(minutes=15 * i) for i in range(40)]
    feed = make_feed([dict(user_id=u, time=t, action=a) for i, t in enumerate(times)
                      for u in range(3 + i % 2) for a in ("view", "like")])
    burst = [dict(user_id=u, reciever_id=1, time=times[-1]) for u in range(200)]
    messages = make_messages([dict(user_id=u, reciever_id=1, time=t) for i, t in enumerate(times)
                              for u in range(2 + i % 2)] + burst)
    alerts = rows(check_alerts(feed, messages, times[-1] + timedelta(minutes=20)), "metric")
    assert {"messages_sent", "messenger_users"} <= {r["metric"] for r in alerts}
    assert all(r["time"] == times[-1] and not math.isnan(r["deviation"]) for r in alerts)


def test_moment_has_no_offset():
    with pytest.raises(ValueError):
        AsOf.of("2024-01-30T23:07:00+03:00")

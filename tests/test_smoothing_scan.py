"""Smoothing as a scan against the recursions, point by point."""

from datetime import datetime, timedelta

import numpy as np
import pytest

from conftest import plan_of
from tidemark.operators.smoothing import simple_levels, trend_forecasts
from tidemark.operators.smoothing_scan import Smoother, smooth_scan

START = datetime(2024, 1, 1)
SIMPLE, TREND = Smoother(0.85), Smoother(0.35, 1.0)


@pytest.fixture
def build(spark):
    def make(series):
        """Metric -> values, or (values, seconds between points)."""
        rows = []
        for metric, points in series.items():
            values, step = points if isinstance(points, tuple) else (points, 900)
            rows += [(metric, f"{i:03d}", START + timedelta(seconds=step * i), v)
                     for i, v in enumerate(values)]
        return spark.createDataFrame(
            rows, "metric string, interval string, time timestamp, value double")
    return make


def smoothed(df, smoothers, **options):
    found = {}
    rows = smooth_scan(df, smoothers, **options).collect()
    for row in sorted(rows, key=lambda r: (r["metric"], r["time"])):
        found.setdefault(row["metric"], []).append(row["smooth"])
    return found


@pytest.mark.parametrize("fan, levels", [(128, 3), (2, 3), (3, 2), (4, 1)])
def test_scan_equals_the_recursions(build, fan, levels):
    drawn = np.random.default_rng(fan)
    week, year = 7 * 86400, 366 * 86400
    shapes = {"a": (400, 900), "b": (1, 900), "c": (2, week), "d": (9, 50_000), "e": (30, week),
              "f": (5, year), "g": (97, 900)}
    series = {}
    for name, (n, step) in shapes.items():
        for kind in ("s", "t"):
            series[name + kind] = (drawn.uniform(-5, 50, n).tolist(), step)
    found = smoothed(build(series), {m: SIMPLE if m[1] == "s" else TREND for m in series},
                     fan=fan, levels=levels)
    for metric, (values, _) in series.items():
        wanted = (simple_levels(values, 0.85) if metric[1] == "s"
                  else trend_forecasts(values, 0.35, 1.0))
        assert found[metric] == pytest.approx(wanted, abs=1e-9), metric


def test_points_keep_their_columns_and_missing_values_spread(build):
    values = [1.0, 2.0, None, 4.0] + [5.0] * 200
    df = build({"s": values, "t": values})
    result = smooth_scan(df, {"s": SIMPLE, "t": TREND})
    assert result.columns == [*df.columns, "smooth"]
    assert result.drop("smooth").exceptAll(df).count() == 0 == df.exceptAll(
        result.drop("smooth")).count()
    for row in result.collect():
        assert (row["smooth"] is None) == (row["time"] >= START + timedelta(minutes=30))


def test_empty_series(build):
    assert smooth_scan(build({}), {"s": SIMPLE}).count() == 0


def test_a_long_series_is_spread(spark):
    """200,000 points a second apart, in cells of two minutes."""
    n = 200_000
    df = spark.range(n).selectExpr(
        "'t' as metric", "timestamp_seconds(1704067200 + id) as time",
        "cast(pmod(xxhash64(id), 1000) as double) as value")
    result = smooth_scan(df, {"t": TREND}, cell_seconds=120)
    values = [r[0] for r in df.orderBy("time").select("value").collect()]
    wanted = trend_forecasts(values, 0.35, 1.0)
    found = [r[0] for r in result.orderBy("time").select("smooth").collect()]
    assert found == pytest.approx(wanted, abs=1e-7)
    # Rows of points only ever meet by cell; what meets by metric alone are the top stretches.
    exchanges = [line for line in plan_of(result).splitlines() if "Exchange hashpartitioning" in line]
    assert "cell" in exchanges[-1] or "_groupingexpression" in exchanges[-1]
    assert "Python" not in plan_of(result) and "Pandas" not in plan_of(result)

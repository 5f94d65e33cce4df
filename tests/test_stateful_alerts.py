"""The stateful check against the batch check, point by point."""

from datetime import datetime, timedelta

import numpy as np
import pytest

from conftest import DATA, rows
from tidemark.operators.bands import add_band
from tidemark.operators.smoothing import holt, single, smooth_series
from tidemark.plans.alerts import DEFAULTS, banded_metrics
from tidemark.sources.derived_events import feed_from_events, messages_from_events
from tidemark.sources.shared_folder import new_path
from tidemark.streaming.intervals import POINT_ROWS, interval_stream
from tidemark.streaming.stateful_alerts import (Band, read_stateful_alerts,
                                                start_stateful_alerts)

START = datetime(2024, 1, 29)


@pytest.mark.parametrize("beta", [None, 1.0, 0.4])
@pytest.mark.parametrize("gap", [None, 17])
def test_band_equals_the_windows(spark, beta, gap):
    values = np.random.default_rng(4).uniform(0, 9, 40).tolist()
    values[9] = 60.0
    if gap:
        values[gap] = None
    series = spark.createDataFrame(
        [("m", START + timedelta(minutes=15 * i), v) for i, v in enumerate(values)],
        "metric string, time timestamp, value double")
    recursion = single(0.35) if beta is None else holt(0.35, beta)
    if gap:  # the recursion in Python cannot go on behind a missing value
        series = series.where(f"time < timestamp '{START + timedelta(minutes=15 * gap)}'")
    wanted = rows(add_band(smooth_series(series, {"m": recursion})), "time")
    band = Band(0.35, beta, DEFAULTS)
    found = []
    for value in values:
        band = Band(0.35, beta, DEFAULTS, band.state())  # as from the store
        found.append(band.add(value))
    names = POINT_ROWS.names[4:13]
    for row, point in zip(wanted, found):
        for name, value in zip(names, point):
            assert (value is None) == (row[name] is None), name
            assert value == pytest.approx(row[name], abs=1e-9), name
    assert all(p[1] is None and p[8] is None for p in found[gap:] if gap)


def run(spark, events, source, **options):
    stream = spark.readStream.schema(events.schema).options(**options).parquet(source)
    metrics = interval_stream(feed_from_events(stream), messages_from_events(stream))
    path, checkpoint = new_path(spark, "points"), new_path(spark, "checkpoint")
    start_stateful_alerts(metrics, path, checkpoint).awaitTermination()
    return path, checkpoint, stream


def numbers(df):
    return [{k: pytest.approx(v, abs=1e-9) if isinstance(v, float) else v for k, v in row.items()
             if k != "message"} for row in rows(df, "metric", "time")]


def test_stream_in_batches_equals_the_batch_check(spark, events):
    source = new_path(spark, "events")
    for day, half in ((28, "<"), (28, ">="), (29, "<"), (29, ">="), (30, "<"), (30, ">=")):
        events.where(f"to_date(ts) = '2024-01-{day}' and hour(ts) {half} 12").coalesce(1).write.mode(
            "append").parquet(source)
    path, checkpoint, stream = run(spark, events, source, maxFilesPerTrigger=1)
    points = spark.read.schema(POINT_ROWS).parquet(path)
    last = points.agg({"time": "max"}).first()[0]
    table = spark.read.schema(events.schema).parquet(source)
    batch = interval_stream(feed_from_events(table), messages_from_events(table)).where(
        f"time <= timestamp '{last}'")
    expected = banded_metrics(batch).drop("message")
    assert rows(points.drop("message"), "metric", "time") == numbers(expected)
    assert 0 < read_stateful_alerts(spark, path).count() < points.count()

    # A restart goes on from the state: nothing is written twice.
    metrics = interval_stream(feed_from_events(stream), messages_from_events(stream))
    start_stateful_alerts(metrics, path, checkpoint).awaitTermination()
    assert spark.read.schema(POINT_ROWS).parquet(path).count() == points.count()


def test_the_whole_table_in_one_run(spark, events):
    path, _, _ = run(spark, events, f"{DATA}/events.parquet*")
    assert spark.read.schema(POINT_ROWS).parquet(path).where("is_alert is not null").count() > 100

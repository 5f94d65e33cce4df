import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import build_session  # noqa: E402
from tidemark.sources.derived_events import feed_from_events, messages_from_events  # noqa: E402
from tidemark.sources.schemas import FEED_ACTIONS, MESSAGE_ACTIONS  # noqa: E402

DATA = "/root/testdata/sf0.01"
DAY = datetime(2024, 1, 29)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests", "local[*]", spark__sql__shuffle__partitions=8,
        spark__checkpoint__dir=str(folder), spark__ui__showConsoleProgress="false",
        spark__sql__maxMetadataStringLength=5000,  # whole filters in printed plans
        spark__sql__warehouse__dir=str(folder / "warehouse"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet(f"{DATA}/events.parquet")


@pytest.fixture(scope="session")
def feed(events):
    return feed_from_events(events)


@pytest.fixture(scope="session")
def messages(events):
    return messages_from_events(events)


@pytest.fixture
def make_feed(spark):
    """Feed table from (user, action) plus any other column by name."""
    def build(rows):
        base = dict(time=DAY + timedelta(hours=1), action="view", gender=0, age=20, os="iOS",
                    source="ads", country="Russia", exp_group=1)
        return spark.createDataFrame(
            [tuple((base | row)[f] for f in FEED_ACTIONS.names) for row in rows], FEED_ACTIONS)
    return build


@pytest.fixture
def make_messages(spark):
    def build(rows):
        base = dict(time=DAY + timedelta(hours=1), gender=0, age=20, os="iOS", source="ads",
                    country="Russia")
        return spark.createDataFrame(
            [tuple((base | row)[f] for f in MESSAGE_ACTIONS.names) for row in rows],
            MESSAGE_ACTIONS)
    return build


def rows(df, *order):
    """Rows as dicts, sorted."""
    found = [r.asDict() for r in df.collect()]
    return sorted(found, key=lambda r: tuple(str(r[c]) for c in order)) if order else found


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()

"""Plans keep the shapes that hold at scale."""

from datetime import date, datetime

import pytest

from conftest import plan_of
from tidemark.operators import activity, audience, segments
from tidemark.operators.bootstrap import bootstrap_by_user
from tidemark.operators.experiment import experiment_users, linearized, smoothed_ctr
from tidemark.operators.histogram import histogram
from tidemark.operators.intervals import feed_intervals
from tidemark.operators.mannwhitney import mann_whitney_test
from tidemark.operators.ordering import exact_quantiles
from tidemark.plans.audience_report import day_numbers
from tidemark.plans.daily_cube import daily_cube
from tidemark.plans.experiment import ctr_experiment, linearized_experiment
from tidemark.plans.feed_report import feed_daily

AS_OF = "2024-01-30 23:07:00"
DAY = date(2024, 1, 29)


@pytest.fixture
def users(feed):
    return experiment_users(feed, datetime(2024, 1, 8), datetime(2024, 1, 14), (0, 1, 2, 3))


def shuffles(plan):
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_exact_distinct_counts_are_spread_by_the_counted_user(feed, messages):
    for job, spread in ((feed_daily(feed, AS_OF), "user_id"),
                        (feed_intervals(feed, AS_OF), "user_id"),
                        (segments.feed_segments(feed, DAY, DAY), "user_id"),
                        (activity.received_per_user(messages), "user_id"),
                        (activity.sent_per_user(messages), "reciever_id")):
        assert spread in shuffles(plan_of(job))[-1]


def under(lines, i):
    """The operator that feeds line i, past projections."""
    return next(line for line in lines[i + 1:] if "Project" not in line)


def final_plan(job):
    """The plan that ran; what was reused stands there once."""
    job.collect()
    return plan_of(job).partition("== Initial Plan ==")[0]


def test_every_shuffle_of_events_is_pre_aggregated(feed, messages):
    for job in (feed_daily(feed, AS_OF), daily_cube(feed, messages, AS_OF),
                audience.user_overlap(feed, messages, DAY),
                audience.feed_only_users(feed, messages, DAY),
                day_numbers(feed, messages, DAY)):
        lines = plan_of(job).splitlines()
        for i, line in enumerate(lines):
            if "Exchange hashpartitioning" in line:
                assert "HashAggregate" in under(lines, i) or "SortMergeJoin" in under(lines, i)


def test_report_text_reads_each_table_once(feed, messages):
    assert final_plan(day_numbers(feed, messages, DAY)).count("FileScan") == 2


def test_no_products_of_rows(feed, messages, users):
    for job in (daily_cube(feed, messages, AS_OF), ctr_experiment(users),
                linearized_experiment(users), smoothed_ctr(users, (1, 2)),
                linearized(users, 0), histogram(users, "ctr", (1, 2))):
        plan = plan_of(job)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_one_task_sees_only_ranges_and_candidates(users):
    plan = plan_of(mann_whitney_test(users, "ctr", (1, 2)))
    # The single-partition steps follow an aggregate per range or a bounded top-k.
    assert "TakeOrderedAndProject(limit=4096" in plan
    lines = plan.splitlines()
    for above, below in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in above:
            assert "HashAggregate(keys=[value_range" in below


def test_replicates_are_summed_before_the_shuffle(users):
    lines = plan_of(bootstrap_by_user(users, 1000)).splitlines()
    last = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert "block" in lines[last] and "partial_sum" in lines[last + 1]


def test_experiment_reads_its_events_once(users):
    for job in (ctr_experiment(users), linearized_experiment(users)):
        assert final_plan(job).count("FileScan") == 1


def test_only_ranges_with_a_quantile_are_sorted(users):
    found = plan_of(exact_quantiles(users, "ctr", (0.25, 0.75)))
    lines = found.partition("== Initial Plan ==")[0].splitlines()
    window = next(i for i, line in enumerate(lines) if "Window" in line and "value_range" in line)
    assert any("BroadcastHashJoin" in line for line in lines[window:])

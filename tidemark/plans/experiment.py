"""The two experiment analyses as tables of test results."""

from functools import reduce

from pyspark.sql import functions as F

from tidemark.operators.experiment import bucketed, linearized, smoothed_ctr
from tidemark.operators.mannwhitney import mann_whitney_test
from tidemark.operators.welch import welch_test

RESULT = ("metric", "test", "n_a", "n_b", "statistic", "p_value")


def _result(test, metric, name, statistic="statistic"):
    return test.select(F.lit(metric).alias("metric"), F.lit(name).alias("test"),
                       "n_a", "n_b", F.col(statistic).alias("statistic"), "p_value")


def _both_tests(df, value, pair):
    return [_result(welch_test(df, value, pair), value, "welch_t"),
            _result(mann_whitney_test(df, value, pair), value, "mann_whitney_u", "u_a")]


def ctr_experiment(users, pair=(1, 2), strength=5, salt="bucket", n_buckets=50):
    """CTR of two groups: raw, smoothed and per hash bucket, each with both tests.

    `users` is read by every test. For a large experiment pass the result of
    `sources.shared_folder.stored(users, ...)`, so that the events are
    aggregated once.
    """
    tests = (_both_tests(users, "ctr", pair)
             + _both_tests(smoothed_ctr(users, pair, strength), "smoothed_ctr", pair)
             + _both_tests(bucketed(users, salt, n_buckets), "bucket_ctr", pair))
    return reduce(lambda a, b: a.unionByName(b), tests).select(*RESULT)


def linearized_experiment(users, pairs=((0, 3), (1, 2))):
    """Plain CTR and linearized likes for each (control, treated) pair, by t-test."""
    tests = []
    for pair in pairs:
        suffix = "_".join(map(str, pair))
        tests += [
            _result(welch_test(users, "ctr", pair), f"ctr_{suffix}", "welch_t"),
            _result(welch_test(linearized(users, pair[0]), "lin_likes", pair),
                    f"lin_likes_{suffix}", "welch_t")]
    return reduce(lambda a, b: a.unionByName(b), tests).select(*RESULT)

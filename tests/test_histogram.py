import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.histogram import histogram
from tidemark.operators.mannwhitney import mann_whitney_test
from tidemark.operators.ordering import exact_quantiles

quick = settings(max_examples=6, deadline=None,
                 suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture
def grouped(spark):
    def build(**groups):
        return spark.createDataFrame([(int(g[1:]), float(x)) for g, xs in groups.items()
                                      for x in xs], "exp_group bigint, x double")
    return build


def auto_bins(x):
    spread, n = np.ptp(x), len(x)
    if spread == 0:
        return 1
    robust = 2 * np.subtract(*np.percentile(x, [75, 25])) / n ** (1 / 3)
    sturges = spread / (np.log2(n) + 1)
    return int(np.ceil(spread / (min(robust, sturges) if robust > 0 else sturges)))


def check(found, group, x, edges):
    counts, edges = np.histogram(x, edges)
    mine = {r.bin: r for r in found if r.exp_group == group}
    assert {b: r.n for b, r in mine.items()} == {
        i: c for i, c in enumerate(counts) if c}
    for b, r in mine.items():
        assert (r.bin_left, r.bin_right) == pytest.approx((edges[b], edges[b + 1]))


@pytest.mark.parametrize("bins", [None, 7])
def test_common_and_own_edges(grouped, bins):
    source = np.random.default_rng(5)
    a, b = source.normal(0, 1, 300).round(2), source.normal(1, 2, 200).round(2)
    df = grouped(g1=a, g2=b)
    both = np.concatenate([a, b])
    edges = np.histogram_bin_edges(both, bins or auto_bins(both))
    common = histogram(df, "x", (1, 2), bins=bins).collect()
    for group, x in ((1, a), (2, b)):
        check(common, group, x, edges)
    own = histogram(df, "x", (1, 2), bins=bins, common=False).collect()
    for group, x in ((1, a), (2, b)):
        check(own, group, x, np.histogram_bin_edges(x, bins or auto_bins(x)))


def test_constant_values_fill_one_bin(grouped):
    found = histogram(grouped(g1=[3.0] * 5), "x", (1,)).collect()
    assert [(r.bin, r.bin_left, r.bin_right, r.n) for r in found] == [(0, 2.5, 3.5, 5)]


def test_zero_quartile_range_uses_sturges(grouped):
    x = np.array([0.0] * 60 + [1.0, 2.0, 5.0])
    check(histogram(grouped(g1=x), "x", (1,)).collect(), 1, x,
          np.histogram_bin_edges(x, auto_bins(x)))


@quick
@given(xs=st.lists(st.floats(-1e6, 1e6, width=32), min_size=1, max_size=60),
       n_ranges=st.sampled_from([1, 4, 256]))
def test_quantiles_equal_numpy(grouped, xs, n_ranges):
    probabilities = (0.0, 0.25, 0.5, 0.9, 1.0)
    row = exact_quantiles(grouped(g1=xs), "x", probabilities, n_ranges=n_ranges).collect()[0]
    np.testing.assert_allclose(list(row), np.percentile(xs, [100 * p for p in probabilities]),
                               rtol=1e-9, atol=1e-9)


def test_quantiles_per_group(grouped):
    a, b = list(range(101)), [7.0, 7.0, 9.0]
    found = exact_quantiles(grouped(g1=a, g2=b), "x", (0.25, 0.75), ["exp_group"]).collect()
    assert {r.exp_group: (r.q_0, r.q_1) for r in found} == {1: (25, 75), 2: (7, 8)}


def test_more_values_than_candidates(spark):
    source = np.random.default_rng(6)
    xs = np.concatenate([source.normal(size=9000), source.exponential(size=9000),
                         np.full(6000, 0.25)])
    groups = source.integers(1, 3, len(xs))
    df = spark.createDataFrame(pd.DataFrame({"exp_group": groups, "x": xs}))
    row = exact_quantiles(df, "x", (0.01, 0.25, 0.6, 0.99)).collect()[0]
    np.testing.assert_allclose(list(row), np.percentile(xs, [1, 25, 60, 99]), rtol=1e-12)
    # Rank sums by pandas midranks; a quarter of all values tie.
    ranks = pd.Series(xs).rank().to_numpy()
    n_a = int((groups == 1).sum())
    test = mann_whitney_test(df, "x", (1, 2)).collect()[0]
    assert test.u_a == ranks[groups == 1].sum() - n_a * (n_a + 1) / 2
    assert mann_whitney_test(df.repartition(31), "x", (1, 2)).collect()[0] == test

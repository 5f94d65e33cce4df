"""Welch's two-sided t-test of two groups, in one aggregate."""

from pyspark.sql import functions as F

from tidemark.functions.pvalues import student_p
from tidemark.functions.scalars import ratio


def welch_test(df, value, pair, group="exp_group"):
    """One row: sizes, means, variances, t, degrees of freedom and p.

    Rows without a value (a ratio over zero views) are left out and counted in
    `n_dropped`. Without any variance t is infinite (p = 0), or undefined when
    the means agree as well.
    """
    first, second = pair
    x = F.col(value)

    def moments(side, label):
        mine = F.when(F.col(group) == label, x)
        return [F.count(mine).alias(f"n_{side}"), F.avg(mine).alias(f"mean_{side}"),
                F.var_samp(mine).alias(f"var_{side}")]

    # Conditions inside the aggregates instead of a filter: several tests over the
    # same rows then share one shuffle, whatever their pairs.
    stats = df.agg(*moments("a", first), *moments("b", second),
                   F.count_if(x.isNull() & F.col(group).isin(first, second)).alias("n_dropped"))

    share_a, share_b = ratio("var_a", "n_a"), ratio("var_b", "n_b")
    spread = share_a + share_b
    gap = F.col("mean_a") - F.col("mean_b")
    statistic = F.when((spread == 0) & (gap != 0), F.signum(gap) * F.lit(float("inf"))
                       ).otherwise(ratio(gap, F.sqrt(spread)))
    freedom = F.when(spread == 0, 1.0).otherwise(
        ratio(spread * spread, ratio(share_a * share_a, F.col("n_a") - 1)
              + ratio(share_b * share_b, F.col("n_b") - 1)))
    return (stats.withColumns({"statistic": statistic, "df": freedom})
            .withColumn("p_value", student_p("statistic", "df"))
            .select("n_a", "n_b", "n_dropped", "mean_a", "mean_b", "var_a", "var_b",
                    "statistic", "df", "p_value"))

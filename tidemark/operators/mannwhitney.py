"""Two-sided Mann-Whitney U test with ties."""

from pyspark.sql import functions as F

from tidemark.functions.pvalues import EXACT_LIMIT, rank_sum_p
from tidemark.functions.scalars import ratio
from tidemark.operators.ordering import RANGE, before, ranges_for, with_value_range


def mann_whitney_test(df, value, pair, group="exp_group", n_ranges=None):
    """One row: sizes, U of the first group, U of the second, z, method and p.

    U counts the pairs in which the first group is larger, ties as half. Per
    value range that needs only the counts inside the range and how many values
    of the second group lie in lower ranges, so no ranks are joined back.

    `method` is `exact` if a group has at most `EXACT_LIMIT` values and nothing ties, else
    `asymptotic`. It is `undefined`, without z and p, if a group has no value. If all
    values tie, z has no finite value and is NULL; p is 1.
    """
    first, second = pair
    counts = (df.where(F.col(group).isin(first, second)).groupBy(value)
              .agg(F.count_if(F.col(group) == first).alias("n_a"),
                   F.count_if(F.col(group) == second).alias("n_b")))
    both = F.col("n_a") + F.col("n_b")
    ranged = with_value_range(counts, value, both > 0, ranges_for(df, n_ranges))

    # Missing values form one row; set it aside.
    missing = F.col(value).isNull()
    ranged = ranged.select(value, RANGE, F.when(missing, both).otherwise(0).alias("n_dropped"), *[
        F.when(missing, 0).otherwise(F.col(c)).alias(c) for c in ("n_a", "n_b")])

    # Doubles from here on: products of counts outgrow a long.
    tied = both.cast("double")
    ranges = (ranged.withColumn("lower_b", before("n_b", RANGE, order=value))
              .groupBy(RANGE)
              .agg(*[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_dropped")],
                   F.sum(F.col("n_a").cast("double") * (F.col("lower_b") + F.col("n_b") / 2.0)
                         ).alias("wins"),
                   F.sum(tied * tied * tied - tied).alias("ties")))
    # One row per range: at most `n_ranges`, so this window may use one task.
    ordered = ranges.withColumn("ranges_below_b", before("n_b", F.lit(0), order=RANGE))
    totals = ordered.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_a", "n_b", "n_dropped")],
        F.sum(F.col("wins") + F.col("n_a").cast("double") * F.col("ranges_below_b")
              ).alias("u_a"),
        F.sum("ties").alias("ties"))

    n_a, n_b = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    n = n_a + n_b
    deviation = F.sqrt(n_a * n_b / 12.0 * (n + 1.0 - ratio(F.col("ties"), n * (n - 1.0))))
    method = (F.when(F.least("n_a", "n_b") == 0, "undefined")
              .when((F.least("n_a", "n_b") <= EXACT_LIMIT) & (F.col("ties") == 0), "exact")
              .otherwise("asymptotic"))
    known = F.col("method") != "undefined"
    return (totals.withColumn("u_b", n_a * n_b - F.col("u_a"))
            .withColumn("u_max", F.greatest("u_a", "u_b"))
            .withColumn("method", method)
            .withColumn("z", F.when(known, ratio(
                F.col("u_max") - n_a * n_b / 2.0 - 0.5, deviation)))
            # The correction of a half over no deviation is minus infinity.
            .withColumn("p_value", F.when(known & F.col("z").isNull(), 1.0).when(
                known, rank_sum_p("z", "u_max", "n_a", "n_b", F.col("method") == "exact")))
            .select("n_a", "n_b", "n_dropped", "u_a", "u_b", "z", "method", "p_value"))

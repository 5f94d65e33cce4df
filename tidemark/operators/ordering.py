"""Exact rank statistics without sorting everything in one task.

Equal values are first collapsed to counts. The distinct values are then cut
into consecutive ranges of about equal size, cumulative counts are taken inside
a range, and the ranges (a few hundred rows, whatever the data) are put in
order. The cut points shape the work only, every result is exact for any cut;
they are picked by hash, so that every evaluation picks the same.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

# Ranges, at least; as many as shuffle partitions if those are more.
N_RANGES = 256
# Distinct values the cut points are chosen from, per range.
CANDIDATES = 16
RANGE = "value_range"


def ranges_for(df, n_ranges=None):
    """The given number of ranges, or one that keeps every task of a shuffle busy."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return n_ranges or max(N_RANGES, tasks)


def with_value_range(counts, value, seen, n_ranges):
    """Adds the ordinal of the range that holds each value of `counts`.

    `seen` is a condition true on every row that uses all of its counts: it
    keeps the aggregate behind the cut points identical to the one behind the
    result, so that Spark runs it, and shuffles for it, once.
    """
    if n_ranges == 1:
        return counts.withColumn(RANGE, F.lit(0))
    # The values with the smallest hashes are a uniform choice among the distinct
    # values and, unlike those of a quantile sketch, do not depend on merge order.
    chosen = (counts.where(seen & F.col(value).isNotNull())
              .orderBy(F.xxhash64(value), value).limit(CANDIDATES * n_ranges)
              .agg(F.sort_array(F.collect_list(value)).alias("chosen")))
    cuts = chosen.select(F.transform(
        F.sequence(F.lit(1), F.lit(n_ranges - 1)),
        lambda i: F.get("chosen", F.floor(i * F.size("chosen") / n_ranges).cast("int")))).scalar()
    # Number of cuts below the value, by halving steps; past the end `get` is NULL.
    steps = [2 ** i for i in reversed(range((n_ranges - 1).bit_length()))]
    below = F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda found, step: F.when(F.get("cuts", found + step - 1) < F.col(value), found + step)
        .otherwise(found))
    # Never NULL, so that no derived null check drags this down to single rows.
    return (counts.withColumn("cuts", cuts)
            .withColumn(RANGE, F.coalesce(below, F.lit(0))).drop("cuts"))


def before(column, *partition, order):
    """Sum of `column` over the preceding rows of the partition."""
    frame = (Window.partitionBy(*partition).orderBy(order)
             .rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(F.sum(column).over(frame), F.lit(0))


def exact_quantiles(df, value, probabilities, by=(), n_ranges=None):
    """Linearly interpolated quantiles per `by` group, as columns `q_0`, `q_1`, ...

    `by` must have few distinct values (experiment groups): the table of ranges that hold
    a quantile, at most two per group and probability, is sent to every task. Only
    these ranges are sorted.
    """
    by, n_ranges = list(by), ranges_for(df, n_ranges)
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    ranged = with_value_range(counts, value, F.col("n") > 0, n_ranges)
    offsets = (ranged.groupBy(*by, RANGE).agg(F.sum("n").alias("in_range"))
               .select(*by, RANGE, "in_range",
                       before("in_range", *by, order=RANGE).alias("range_start"),
                       F.sum("in_range").over(Window.partitionBy(*by)).alias("total")))

    def ranks(p):
        """(position, the rank below it, the rank above it) of a probability."""
        position = F.lit(float(p)) * (F.col("total") - 1)
        lower = F.floor(position)
        return position, lower, F.least(lower + 1, F.col("total") - 1)

    wanted = F.lit(False)
    for p in probabilities:
        _, lower, upper = ranks(p)
        wanted |= ((F.col("range_start") <= upper)
                   & (lower < F.col("range_start") + F.col("in_range")))
    holding = offsets.where(wanted).drop("in_range")
    placed = (ranged.join(F.broadcast(holding), [*by, RANGE])
              .withColumn("start", F.col("range_start")
                          + before("n", *by, RANGE, order=value)))

    def at(rank):
        holds = (F.col("start") <= rank) & (rank < F.col("start") + F.col("n"))
        return F.max(F.when(holds, F.col(value)))

    picked = []
    for i, p in enumerate(probabilities):
        position, lower, upper = ranks(p)
        picked += [at(lower).alias(f"lower_{i}"), at(upper).alias(f"upper_{i}"),
                   F.max(position - lower).alias(f"part_{i}")]
    found = placed.groupBy(*by).agg(*picked)
    return found.select(*by, *[
        (F.col(f"lower_{i}") + (F.col(f"upper_{i}") - F.col(f"lower_{i}")) * F.col(f"part_{i}")
         ).alias(f"q_{i}") for i in range(len(probabilities))])

"""Chart-ready histograms: bin edges and counts instead of a drawing."""

from pyspark.sql import functions as F

from tidemark.functions.scalars import ratio
from tidemark.operators.ordering import exact_quantiles


def histogram(df, value, groups, group="exp_group", bins=None, common=True):
    """Non-empty bins per group: `bin`, `bin_left`, `bin_right`, `n`.

    With `common` all groups share one set of edges, otherwise each group has
    its own. `bins` fixes the number of bins; by default their width is the
    smaller of the Freedman-Diaconis and the Sturges width, the former only if
    the interquartile range is not zero. All bins are half-open but the last.
    Only the named `groups` enter, which bounds the table of edges to one row
    per group.
    """
    kept = df.where(F.col(value).isNotNull() & F.col(group).isin(*groups)).select(
        group, F.col(value).cast("double").alias(value))
    scope = [] if common else [group]
    edges = _edges(kept, value, scope, bins)
    if scope:
        placed = kept.join(F.broadcast(edges), scope)
    else:
        edge_row = edges.select(F.struct("low", "high", "bins").alias("edges")).scalar()
        placed = kept.withColumn("edges", edge_row).select(group, value, "edges.*")

    width = (F.col("high") - F.col("low")) / F.col("bins")
    last = F.col("bins") - 1
    x, low = F.col(value), F.col("low")
    guess = F.least(F.floor((x - low) / width), last)
    # The quotient may be off by one step at an edge; compare with the edge itself.
    placed = (placed.withColumn("guess", guess)
              .withColumn("bin", F.when(x < low + F.col("guess") * width, F.col("guess") - 1)
                          .when((x >= low + (F.col("guess") + 1) * width)
                                & (F.col("guess") < last), F.col("guess") + 1)
                          .otherwise(F.col("guess"))))
    return (placed.groupBy(group, "bin", "low", "high", "bins").agg(F.count("*").alias("n"))
            .select(group, "bin", (low + F.col("bin") * width).alias("bin_left"),
                    (low + (F.col("bin") + 1) * width).alias("bin_right"), "n"))


def _edges(kept, value, scope, bins):
    """Lower end, upper end and number of bins per scope."""
    extent = kept.groupBy(*scope).agg(F.min(value).alias("low"), F.max(value).alias("high"),
                                      F.count("*").alias("total"))
    if bins is None:
        quartiles = exact_quantiles(kept, value, (0.25, 0.75), scope)
        extent = (extent.join(F.broadcast(quartiles), scope) if scope
                  else _with_row(extent, quartiles))
        spread = F.col("high") - F.col("low")
        sturges = spread / (F.log2(F.col("total")) + 1)
        robust = 2 * (F.col("q_1") - F.col("q_0")) / F.pow("total", F.lit(1 / 3))
        width = F.when(robust > 0, F.least(robust, sturges)).otherwise(sturges)
        number = F.when(spread == 0, 1).otherwise(F.ceil(ratio(spread, width)))
    else:
        number = F.lit(bins)
    flat = F.col("low") == F.col("high")
    return extent.select(
        *scope, number.cast("bigint").alias("bins"),
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"))


def _with_row(one_row, other_row):
    """Columns of two one-row results side by side."""
    row = other_row.select(F.struct(*other_row.columns).alias("row")).scalar()
    return one_row.withColumn("row", row).select(*one_row.columns, "row.*")

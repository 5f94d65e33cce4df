"""Poisson bootstrap of the group CTR.

Every replicate weighs each user by an independent Poisson(1) draw and takes
the ratio of the weighted sums. The draws come from hashes or from seeded
generators, never from `rand()`: a retried or repartitioned task draws the same.
"""

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.functions.scalars import md5_words, ratio

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GROUP = "exp_group"
WORD = 2 ** 32


def poisson_thresholds():
    """Poisson(1) distribution function at 0, 1, 2, ... on the 32-bit scale.

    Stops where the remaining tail is below one step of that scale.
    """
    thresholds, term, total = [], math.exp(-1.0), 0.0
    for k in range(1, 40):
        total += term
        if math.floor(total * WORD) >= WORD - 1:
            break
        thresholds.append(math.floor(total * WORD))
        term /= k
    return thresholds


def poisson_weight(word):
    """Poisson(1) weight of a uniform 32-bit word."""
    first, *rest = enumerate(poisson_thresholds())
    weight = F.when(word < first[1], first[0])
    for k, threshold in rest:
        weight = weight.when(word < threshold, k)
    return weight.otherwise(len(rest) + 1)


def _md5(user, block, seed):
    return md5_words(F.concat_ws("-", user.cast("string"), block.cast("string"),
                                 F.lit(str(seed))))


def _xxhash64(user, block, seed):
    digest = F.xxhash64(user, block, F.lit(seed))
    return [F.shiftrightunsigned(digest, 32), digest.bitwiseAND(F.lit(WORD - 1))]


# One hash call gives this many independent words, so as many replicates.
HASHES = {"md5": (_md5, 4), "xxhash64": (_xxhash64, 2)}


def replicate_sums(users, replicates=1000, seed=0, algorithm="xxhash64", keys=(GROUP,)):
    """Weighted likes and views per value of `keys` and replicate, each user drawing its own
    weights: they depend on nothing but user, replicate and seed.

    Users meet the blocks of replicates inside the scan task and are summed per
    (keys, block) before the shuffle, so what moves is (tasks x keys x
    replicates) partial sums and no user-by-replicate rows. `md5` draws can be
    reproduced by any SQL engine; `xxhash64` is the cheap default.
    """
    words_of, per_block = HASHES[algorithm]
    blocks = math.ceil(replicates / per_block)
    # The work is `replicates` times the size of the users. Partitions sized by
    # bytes would be far too few, so the users are spread over all tasks first.
    tasks = int(users.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    drawn = (users.select(*keys, "user_id", "likes", "views").repartition(tasks, "user_id")
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    drawn = drawn.withColumn(
        "word", F.array(*words_of(F.col("user_id"), F.col("block"), seed)))
    drawn = drawn.select(*keys, "block", "likes", "views", *[
        poisson_weight(F.col("word")[i]).alias(f"w{i}") for i in range(per_block)])
    sums = drawn.groupBy(*keys, "block").agg(
        *[F.sum(F.col(f"w{i}") * F.col(m)).alias(f"{m}_{i}")
          for i in range(per_block) for m in ("likes", "views")])
    each = F.explode(F.array(*[
        F.struct((F.col("block") * per_block + i).alias("replicate"),
                 F.col(f"likes_{i}").alias("likes"), F.col(f"views_{i}").alias("views"))
        for i in range(per_block)])).alias("drawn")
    return (sums.select(*keys, each).select(*keys, "drawn.*")
            .where(F.col("replicate") < replicates))


def bootstrap_by_user(users, replicates=1000, seed=0, algorithm="xxhash64"):
    """CTR per (group, replicate), each user drawing its own weights; see `replicate_sums`."""
    return replicate_sums(users, replicates, seed, algorithm).select(
        GROUP, "replicate", ratio("likes", "views").alias("global_ctr"))


def daily_replicates(users, replicates=1000, seed=0, algorithm="xxhash64"):
    """Weighted sums of one or more days' users (`date`, group, `user_id`, `likes`, `views`).

    A user draws the same weights on every day, so the sums of days add up to those of the
    whole range: a day is drawn once, stored, and never read again.
    """
    return replicate_sums(users, replicates, seed, algorithm, ("date", GROUP))


def bootstrap_of_days(sums, first, last):
    """CTR per (group, replicate) of the days `first`..`last` from stored daily sums alone; equal
    to `bootstrap_by_user` over the events of these days, with the same seed and algorithm."""
    return (sums.where(F.col("date").between(F.lit(first), F.lit(last)))
            .groupBy(GROUP, "replicate").agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"))
            .select(GROUP, "replicate", ratio("likes", "views").alias("global_ctr")))


def cells(users):
    """Users with equal counts as one row with their number `k`."""
    return users.groupBy(GROUP, "likes", "views").agg(F.count("*").alias("k"))


def bootstrap_by_cell(users, replicates=1000, seed=0):
    """The same distribution with one draw per distinct (group, likes, views).

    k users with equal counts add up to a Poisson(k) weight, so the cost follows
    the number of distinct count pairs instead of the number of users. Each cell
    seeds its own generator; a task adds up its cells before anything moves. A cell is
    a few bytes and `replicates` draws, so cells are dealt to a number of tasks that
    does not follow their bytes.
    """
    tasks = int(users.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = cells(users).repartition(tasks, GROUP, "likes", "views")

    def draw(batches):
        sums = {}
        for batch in batches:
            for group, likes, views, k in batch.itertuples(index=False):
                source = np.random.default_rng([seed, group, likes, views])
                weights = source.poisson(k, replicates)
                total = sums.setdefault(group, np.zeros((2, replicates), dtype="int64"))
                total[0] += weights * likes
                total[1] += weights * views
        for group, (likes, views) in sums.items():
            yield pd.DataFrame({GROUP: group, "replicate": np.arange(replicates),
                                "likes": likes, "views": views})

    partial = spread.mapInPandas(
        draw, f"{GROUP} bigint, replicate int, likes bigint, views bigint")
    return (partial.groupBy(GROUP, "replicate")
            .agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"))
            .select(GROUP, "replicate", ratio("likes", "views").alias("global_ctr")))

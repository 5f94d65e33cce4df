"""Mixing documents to target weights of domains, by soft membership.

A multinomial classifier over hashed words, counted on labelled rows, gives every document
a posterior over the domains. Document d of t_d words counts with r_d t_d p_dk towards domain
k. The rates r_d >= 0 minimise

    sum_k (sum_d r_d t_d p_dk - T_k)^2 / (2 S_k),      S_k = sum_d t_d p_dk

by projected gradient from r = 1, T_k being the target weight times the words to be drawn.
In the metric of document lengths the step is r_d <- max(0, r_d - sum_k p_dk x_k), where x solves
G x = s - T for the present totals s and the Gram matrix G of the posteriors, weighed by length, of documents
with a positive rate: overlapping domains take no more rounds than distinct ones. A
round is one sum of K + K (K + 1) / 2 numbers over all documents; only these reach the driver.

Everything here is DataFrame expressions: no Python runs on the executors.
"""

import math
import warnings

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm.shared import bounded_sample
from tidemark.sources.shared_folder import stored

BUCKETS = 4096
#: Documents counted for the classifier, at most.
MOST_LABELLED = 20_000
SMOOTHING = 0.5
#: A document's mean log-probability weighs as so many words: memberships stay soft.
EVIDENCE = 12.0
ROUNDS = 30
HALVINGS = 6
TOLERANCE = 1e-6
SEED = 71


def hashed_words(docs):
    """`doc_id`, hashed `word`; a text without words is one row with a null word."""
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+")
    word = F.explode(words).alias("word")
    return docs.select("doc_id", word).select(
        "doc_id", F.when(F.col("word") != "", F.pmod(F.xxhash64("word"), F.lit(BUCKETS)))
        .alias("word"))


def classifier(docs, labelled, domains, most=MOST_LABELLED):
    """(log-probabilities by hashed word, log priors) of the domains.

    `labelled`: (`doc_id`, `domain`), of which at most `most` rows are used, chosen by the
    hashes of their ids; rows of other domains, or without id, teach nothing, and an id
    with several domains teaches the smallest.
    """
    known = (labelled.where(F.col("domain").isin(*domains) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min("domain").alias("domain")))
    sample = F.broadcast(bounded_sample(known, F.col("doc_id"), most))
    words = hashed_words(docs.join(sample.select("doc_id"), "doc_id", "left_semi")).join(
        sample, "doc_id")
    per_domain = [F.count_if((F.col("domain") == d) & F.col("word").isNotNull()).alias(f"c{k}")
                  for k, d in enumerate(domains)]
    spark = docs.sparkSession
    counts = stored(spark.range(BUCKETS).withColumnRenamed("id", "word").join(
        words.groupBy("word").agg(*per_domain), "word", "left").na.fill(0), "mix-words")
    totals = counts.agg(*[F.sum(f"c{k}") for k in range(len(domains))]).first()
    log_probability = [
        F.log((F.col(f"c{k}") + SMOOTHING) / (n + SMOOTHING * BUCKETS)).alias(f"l{k}")
        for k, n in enumerate(totals)]
    every = sum(totals) + len(domains)
    priors = [math.log((n + 1) / every) for n in totals]
    return counts.select("word", *log_probability), priors  # BUCKETS rows


def memberships(docs, labelled, domains, most=MOST_LABELLED):
    """`doc_id`, `tokens` (words) and posteriors `p0`, `p1`, ... of every document.

    Rows of one id are one document. A text without words has the priors.
    """
    table, priors = classifier(docs, labelled, domains, most)
    ks = range(len(domains))
    sums = (hashed_words(docs).join(F.broadcast(table), "word", "left").groupBy("doc_id")
            .agg(F.count("word").alias("tokens"), *[F.sum(f"l{k}").alias(f"s{k}") for k in ks]))
    logits = [F.lit(priors[k]) + F.coalesce(EVIDENCE * F.col(f"s{k}") / F.col("tokens"), F.lit(0.0))
              for k in ks]
    with_logits = sums.select("doc_id", "tokens", *[z.alias(f"z{k}") for k, z in enumerate(logits)])
    top = F.greatest(*[F.col(f"z{k}") for k in ks]) if len(domains) > 1 else F.col("z0")
    scaled = with_logits.select("doc_id", "tokens", *[
        F.exp(F.col(f"z{k}") - top).alias(f"e{k}") for k in ks])
    whole = sum((F.col(f"e{k}") for k in ks), F.lit(0.0))
    return scaled.select("doc_id", "tokens", *[(F.col(f"e{k}") / whole).alias(f"p{k}") for k in ks])


def fit_rates(members, weights, total=None):
    """The rate of a document as an expression over `members`, and (reached, wanted) by domain.

    `weights`: a number for each domain, in their order; `total`: words to be drawn, as many
    as there are by default. Projected gradient on the squared gaps between reached and wanted
    totals: rates move along the posteriors and stay nonnegative. The gradient is scaled by the
    inverse of the Gram matrix of the posteriors of documents with a positive rate, so that overlapping domains
    take no more rounds than distinct ones; a round that brings no gain is taken again with half the
    step. Ends when no domain is further than `TOLERANCE` of all words from its target, when
    `HALVINGS` halvings bring no gain (the targets cannot be met), or after `ROUNDS`. A
    round is one sum of K + K (K + 1) / 2 numbers over all documents.
    """
    ks = range(len(weights))
    pairs = [(i, j) for i in ks for j in ks if i <= j]

    def sums(rate):
        weighed = members.withColumn("mix_rate", rate)
        free = F.when(F.col("mix_rate") > 0, F.col("tokens")).otherwise(0)
        found = weighed.agg(
            *[F.sum(F.col("mix_rate") * F.col("tokens") * F.col(f"p{k}")) for k in ks],
            *[F.sum(free * F.col(f"p{i}") * F.col(f"p{j}")) for i, j in pairs]).first()
        values = [float(x or 0.0) for x in found]
        gram = np.zeros((len(weights), len(weights)))
        for (i, j), x in zip(pairs, values[len(weights):]):
            gram[i, j] = gram[j, i] = x
        return np.array(values[:len(weights)]), gram

    rate = F.lit(1.0)
    now, gram = sums(rate)
    drawn = float(now.sum() if total is None else total)
    targets = drawn * np.array(weights, float) / sum(weights)

    def gap(reached):
        return float(np.abs(reached - targets).max()) / (drawn or 1.0)

    for _ in range(ROUNDS):
        if gap(now) <= TOLERANCE:
            break
        pull = np.linalg.lstsq(gram, now - targets, rcond=1e-12)[0]
        for halving in range(HALVINGS):
            step = sum((F.col(f"p{k}") * float(pull[k] / 2 ** halving) for k in ks), F.lit(0.0))
            moved = F.greatest(F.lit(0.0), rate - step)
            reached, free = sums(moved)
            if gap(reached) < 0.999 * gap(now):
                break
        else:
            break
        rate, now, gram = moved, reached, free
    return rate, {k: (float(now[k]), float(targets[k])) for k in ks}


class TargetsNotMet(UserWarning):
    """No nonnegative rates give the wanted totals, or not to the tolerance."""


def soft_mix(docs, labelled, targets, total=None, most=MOST_LABELLED):
    """`doc_id`, `tokens`, `posteriors` (by domain), `rate` and `copies` of every document.

    `targets`: domain -> weight. `copies` are whole: the rate rounded up or down by a hash of
    the id, so that its mean is the rate and every run draws the same. One row per distinct
    id; a null id is one document with a row of its own. Null and empty texts have no
    tokens and the prior's rate. No documents, no rows; other columns are ignored. Targets that
    the documents cannot meet are approached, and a `TargetsNotMet` warning tells the totals.
    """
    domains = sorted(targets)
    members = stored(memberships(docs, labelled, domains, most), "mix-members")
    rate, totals = fit_rates(members, [targets[d] for d in domains], total)
    words = sum(wanted for _, wanted in totals.values())
    if any(abs(reached - wanted) > TOLERANCE * words for reached, wanted in totals.values()):
        warnings.warn("words by domain (reached, wanted): " + ", ".join(
            f"{d} ({reached:.0f}, {wanted:.0f})" for d, (reached, wanted) in zip(domains, totals.values())),
            TargetsNotMet, stacklevel=2)
    uniform = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 32)) / float(1 << 32)
    posteriors = F.create_map(*[x for k, d in enumerate(domains)
                                for x in (F.lit(d), F.col(f"p{k}"))])
    return members.select("doc_id", "tokens", posteriors.alias("posteriors"), rate.alias("rate")
                          ).withColumn("copies", F.floor(F.col("rate") + uniform).cast("int"))


def mixed(docs, labelled, targets, total=None):
    """The rows of `docs`, each as often as its document's copies say; all their columns.

    An expected share of the words for each domain; nothing is capped. Whole rows are
    repeated, so a document with three copies appears three times.
    """
    copies = soft_mix(docs, labelled, targets, total).select(
        F.col("doc_id").alias("mixed_id"), F.col("copies").alias("mixed_copies"))
    # Whole rows travel in one column, so that no name of theirs can clash.
    rows = docs.select(F.col("doc_id").alias("row_id"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("mixed_row"))
    joined = rows.join(copies, rows["row_id"].eqNullSafe(copies["mixed_id"]))
    return (joined.where("mixed_copies > 0")
            .select("mixed_row", F.explode(F.sequence(F.lit(1), "mixed_copies")).alias("copy"))
            .select("mixed_row.*"))

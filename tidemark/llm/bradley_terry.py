"""Quality scores by Bradley-Terry ranking of documents.

A document's utility is w . x for features x of its whole text. A pair of a good and a bad
document is a comparison that the good one won, with probability
sigmoid(w . (x_good - x_bad)); w minimises the logistic loss over such pairs. The utility
below which documents are rejected is a quantile of the utilities of the training rows, at the
share of bad ones among them. Scores are utilities on a logistic scale with that
threshold at `CUT`.
"""

import sys
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.llm.shared import bounded_batches, bounded_sample, fold, slices, texts_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CUT = 0.7
#: Labelled rows that the weights are fitted on, at most; and pairs drawn among them.
MOST_LABELLED = 20_000
PAIRS = 200_000
SEED = 20240
RIDGE = 1e-3

FEATURES = ("words", "empty", "symbols", "bars", "marks", "upper", "digits", "letters",
            "repeated_words", "top_word", "same_next", "repeated_pairs", "repeated_sentences",
            "word_length")
SYMBOLS = b"*&$%#@~^<>{}[]\\/=+_"


def share(part, whole):
    """A share on a scale where small shares differ."""
    return float(np.log1p(100.0 * part / whole)) if whole else 0.0


def features(text):
    raw = text.encode()
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = text.split()
    n = len(words)
    if not n:
        return [0.0, 1.0] + [0.0] * (len(FEATURES) - 2)
    visible = int(seen[33:].sum())
    upper, lower = int(seen[65:91].sum()), int(seen[97:123].sum())
    counts = Counter(words)
    sentences = [s for s in text.replace("\n", " ").split(". ") if s]
    pairs = set(zip(words, words[1:]))
    return [
        float(np.log1p(n)), 0.0,
        share(int(seen[list(SYMBOLS)].sum()), visible),
        share(int(seen[124]), visible),
        share(int(seen[33] + seen[63]), visible),
        share(upper, upper + lower),
        share(int(seen[48:58].sum()), visible),
        share(upper + lower + int(seen[128:].sum()), visible),
        1.0 - len(counts) / n,
        share(max(counts.values()) - 1, n),
        share(sum(map(eq, words, words[1:])), n),
        1.0 - len(pairs) / (n - 1) if n > 1 else 0.0,
        share(len(sentences) - len(set(sentences)), max(len(sentences), 1)),
        float(np.log1p(len(text) / n)),
    ]


@dataclass
class Ranking:
    """Weights on standardised features, the rejection threshold and the scale of scores."""
    center: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float
    scale: float

    def utilities(self, rows):
        return (np.asarray(rows, float).reshape(-1, len(FEATURES)) - self.center) / self.spread \
            @ self.weights

    def scores(self, rows):
        z = (self.utilities(rows) - self.threshold) / self.scale + np.log(CUT / (1 - CUT))
        # At the threshold itself the score is CUT, whatever the last digit of exp.
        return np.where(z >= np.log(CUT / (1 - CUT)), np.maximum(sigmoid(z), CUT),
                        np.minimum(sigmoid(z), np.nextafter(CUT, 0)))


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(rows, labels):
    """A ranking from feature rows and their 0/1 labels.

    Without both labels there are no pairs: all weights are zero and every document gets
    the score `CUT`, so nothing is rejected.
    """
    rows, labels = np.asarray(rows, float).reshape(-1, len(FEATURES)), np.asarray(labels)
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    center = rows.mean(axis=0) if len(rows) else np.zeros(len(FEATURES))
    spread = rows.std(axis=0) if len(rows) else np.ones(len(FEATURES))
    spread = np.where(spread > 1e-9, spread, 1.0)
    ranking = Ranking(center, spread, np.zeros(len(FEATURES)), 0.0, 1.0)
    if not len(good) or not len(bad):
        return ranking
    draw = np.random.default_rng(SEED)
    x = (rows - center) / spread
    differences = x[draw.choice(good, PAIRS)] - x[draw.choice(bad, PAIRS)]
    weights = np.zeros(len(FEATURES))
    for _ in range(30):  # Newton steps on the convex loss
        won = sigmoid(differences @ weights)
        slope = differences.T @ (won - 1) / PAIRS + RIDGE * weights
        curve = (differences * (won * (1 - won))[:, None]).T @ differences / PAIRS
        step = np.linalg.solve(curve + RIDGE * np.eye(len(weights)), slope)
        weights = weights - step
        if np.abs(step).max() < 1e-9:
            break
    ranking.weights = weights
    utilities = np.sort(ranking.utilities(rows))
    # Between the two rows that the quantile at the share of bad rows divides.
    ranking.threshold = float(utilities[len(bad) - 1:len(bad) + 1].mean())
    ranking.scale = float(np.median(np.abs(utilities - ranking.threshold))) / 3 or 1.0
    return ranking


FEATURE_ROW = "x array<double>"


def with_features(docs):
    """`docs` (ending in a text column) with the features of the text instead of it."""
    names = [f.name for f in docs.schema.fields if f.name != "text"]

    def rows(batches):
        for batch in batches:
            for part in slices(batch):
                x = [features(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [pa.array(x, pa.list_(pa.float64()))],
                    [*names, "x"])

    kinds = [f"{n} {docs.schema[n].dataType.simpleString()}" for n in names]
    return docs.mapInArrow(rows, ", ".join([*kinds, FEATURE_ROW]))


def learn(docs, labels, label="quality", folds=4, held_out=2, most=MOST_LABELLED):
    """Fit on at most `most` labelled rows outside the held-out fold.

    The bound is on rows of the training sample only; which rows it holds depends on
    their ids alone. Rows without label or id teach nothing; of repeated labels of one id
    the smallest counts.
    """
    known = (labels.where(F.col(label).isin(0, 1) & (fold(F.col("doc_id"), folds) != held_out))
             .groupBy("doc_id").agg(F.min(label).alias("label")))
    sample = bounded_sample(known, F.col("doc_id"), most)
    rows = with_features(texts_of(docs).join(F.broadcast(sample), "doc_id")
                         .select("doc_id", "label", "text"))
    found = rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("x").alias("x"))
    table = found.toPandas().sort_values("doc_id")  # at most `most` rows
    return fit(table["x"].tolist(), table["label"].to_numpy())


def score(docs, ranking, out="score", keep=None):
    """The columns `keep` of `docs` (all by default) and `out` in [0, 1] from the whole text.

    One row per row of `docs`, without a shuffle. Only the text is read for the score, a null
    one as empty; nulls in other columns do not matter. A column that is already
    called `out` is replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != out]
    inner = docs.select(*keep) if "text" in keep else docs.select(*keep, "text")
    bounded_batches(docs.sparkSession)

    def rows(batches):
        for batch in batches:
            for part in slices(batch):
                x = [features(t or "") for t in part.column("text").to_pylist()]
                scores = ranking.scores(x)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], pa.array(scores, pa.float64())],
                    [*keep, out])

    kinds = [f"`{c}` {inner.schema[c].dataType.simpleString()}" for c in [*keep]]
    return inner.mapInArrow(rows, ", ".join([*kinds, f"`{out}` double"]))

"""Toxicity scores from a weighted lexicon matched by an Aho-Corasick automaton.

Texts are folded first: lower case, compatibility forms, letters of other scripts that
look Latin, digits and signs that stand for letters; everything else that is no letter
becomes a space. The lexicon holds beginnings of words and whole words with weights: a fixed
list, and what the labelled rows show to be said in toxic documents far more often than in
others. Matches inside an exception phrase do not count. A document's weight is
taken per word of its length, and a logistic curve fitted on the labelled rows turns it
into a score.
"""

import sys
from bisect import bisect_right
import unicodedata
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.llm.shared import bounded_batches, bounded_sample, fold, slices, texts_of
from tidemark.sources.shared_folder import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Labelled rows that the lexicon and the curve are learned from, at most.
MOST_LABELLED = 20_000
#: Learned entries, at most; the strongest evidence counts. Far beyond what passes `EVIDENCE`.
MOST_ENTRIES = 5_000
#: Log-likelihood ratio an entry needs: about one in a million by chance.
EVIDENCE = 14.0
LEAST_RATIO = 10.0
STEMS = range(3, 11)

#: Insults and their weights before anything is learned.
INSULTS = {
    "idiot": 2.0, "moron": 2.0, "stupid": 1.5, "dumbass": 2.5, "imbecile": 2.0, "scum": 2.0,
    "loser": 1.5, "pathetic": 1.5, "worthless": 1.5, "disgusting": 1.5, "trash": 1.0,
    "clown": 1.0, "bastard": 2.5, "bitch": 3.0, "asshole": 3.0, "fuck": 3.0, "shit": 2.0,
    "retard": 3.0, "whore": 3.0, "slut": 3.0, "cunt": 3.5, "filth": 1.5, "vermin": 2.0,
}
#: Phrases in which these words insult nobody.
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "trash collection", "clown fish", "clownfish",
    "circus clown", "pond scum", "soap scum", "sore loser", "stupid mistake", "shiitake",
)
#: Letters of other scripts by the Latin letter that they look like.
HOMOGLYPHS = {
    "a": "аα", "b": "вβ", "c": "сϲ", "d": "ԁ", "e": "еε", "h": "һн", "i": "іιı", "j": "ј",
    "k": "кκ", "l": "ӏ", "m": "м", "n": "пη", "o": "оοσ", "p": "рρ", "s": "ѕ", "t": "тτ",
    "u": "υ", "v": "ν", "w": "ԝω", "x": "хχ", "y": "уγ",
}
#: Digits and signs by the letter that they stand for.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b",
               "@": "a", "$": "s", "€": "e"}
#: Characters that are not seen.
INVISIBLE = "­​‌‍⁠﻿"


def folding_table():
    table = {code: " " for code in range(128) if not chr(code).isalpha()}
    table |= {ord(look): letter for letter, looks in HOMOGLYPHS.items() for look in looks}
    table |= {ord(sign): letter for sign, letter in SUBSTITUTES.items()}
    return table | {ord(c): None for c in INVISIBLE}


FOLDING = folding_table()


def folded(text):
    """The text as words of letters, with a space before each word and at the end."""
    if not text.isascii() and not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    return f" {text.lower().translate(FOLDING)} "


@dataclass
class Lexicon:
    """Entries as they stand in a folded text (a space where a word begins or ends) and
    weights, and the coefficients of the curve."""
    entries: dict
    exceptions: tuple = EXCEPTIONS
    curve: tuple = (-3.0, 1.5, 1.0)

    def automaton(self):
        import ahocorasick
        found = ahocorasick.Automaton()
        for entry, weight in self.entries.items():
            found.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            found.add_word(f" {phrase}", (len(phrase) + 1, 0.0))
        found.make_automaton()
        return found


def measures(text, automaton):
    """(words, words matched, sum over them of the largest weight) of a whole text."""
    line = folded(text)
    best, spans = {}, []
    for end, (length, weight) in automaton.iter(line):
        start = end - length + 1
        if weight:
            best[start] = max(weight, best.get(start, 0.0))
        else:
            spans.append((start, end))
    # A place is excepted if one of the spans that start at or before it reaches beyond it.
    spans.sort()
    starts, reach = [first for first, _ in spans], []
    for _, last in spans:
        reach.append(max(last, reach[-1]) if reach else last)
    kept = [w for at, w in best.items()
            if not (i := bisect_right(starts, at)) or reach[i - 1] <= at]
    return len(line.split()), len(kept), sum(kept)


def curve_inputs(measured):
    words, matched, weight = np.asarray(measured, float).reshape(-1, 3).T
    return np.column_stack([np.ones(len(words)), np.log1p(100 * weight / np.maximum(words, 1)),
                            np.log1p(matched)])


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_curve(measured, labels):
    """Logistic coefficients by Newton's method with a small ridge."""
    x, y = curve_inputs(measured), np.asarray(labels, float)
    b = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        return Lexicon({}).curve
    for _ in range(50):
        p = sigmoid(x @ b)
        slope = x.T @ (p - y) + 1e-2 * b
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(b)), slope)
        b = b - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(b.tolist())


def first_entries():
    return {f" {word}": weight for word, weight in INSULTS.items()}


def training_rows(docs, labels, label, folds, held_out, most):
    """(doc_id, label, text) of at most `most` labelled rows outside the held-out fold."""
    known = (labels.where(F.col(label).isin(0, 1) & (fold(F.col("doc_id"), folds) != held_out))
             .groupBy("doc_id").agg(F.max(label).alias("label")))
    sample = bounded_sample(known, F.col("doc_id"), most)
    return texts_of(docs).join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")


def distinct_words(rows):
    """`doc_id`, `label`, distinct folded `words`, and a `sketch` that copies mostly share."""
    def found(batches):
        for batch in batches:
            for part in slices(batch):
                words = [folded(t).split() for t in part.column("text").to_pylist()]
                sketch = [min([zlib.crc32(" ".join(w[i:i + 3]).encode())
                               for i in range(max(1, len(w) - 2))]) for w in words]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"),
                     pa.array([sorted(set(w)) for w in words], pa.list_(pa.string())),
                     pa.array(sketch, pa.int64())], ["doc_id", "label", "words", "sketch"])

    label_kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(
        found, f"doc_id bigint, label {label_kind}, words array<string>, sketch bigint")


def learned_entries(rows):
    """Beginnings of words and whole words that toxic rows use far more than others.

    Copies of one text teach once. Counts are summed by word before their beginnings
    are listed, so no task sees more than the distinct words of the sample.
    """
    one_each = stored(distinct_words(rows).groupBy("sketch")
                      .agg(F.min(F.struct("doc_id", "label", "words")).alias("row"))
                      .select("row.*"), "toxicity-words")
    totals = one_each.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    if not totals[0] or not totals[1]:
        return {}
    words = (one_each.select("label", F.explode("words").alias("word"))
             .groupBy("word").agg(F.sum("label").alias("toxic"),
                                  F.sum(1 - F.col("label")).alias("other")))
    stems = F.array(*[F.when(F.length("word") >= k, F.concat(F.lit(" "), F.substring("word", 1, k)))
                      for k in STEMS], F.concat(F.lit(" "), "word", F.lit(" ")))
    counted = (words.select(F.explode(stems).alias("entry"), "toxic", "other")
               .where("entry is not null").groupBy("entry")
               .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))
    all_toxic, all_other = map(F.lit, totals)
    share = all_toxic / (all_toxic + all_other)
    toxic, both = F.col("toxic"), F.expr("toxic + other")
    evidence = (toxic * F.log(toxic / (both * share))
                + F.when(F.col("other") > 0, F.col("other") * F.log(
                    F.col("other") / (both * (1 - share)))).otherwise(0))
    ratio = ((toxic + 0.5) / (all_toxic + 1)) / ((F.col("other") + 0.5) / (all_other + 1))
    strong = (counted.where("toxic > 0")
              .select("entry", "toxic", "other", ratio.alias("ratio"), evidence.alias("evidence"))
              .where(f"ratio >= {LEAST_RATIO} and evidence >= {EVIDENCE}"))
    top = strong.orderBy(F.desc("evidence"), "entry").limit(MOST_ENTRIES)
    return most_specific(top.collect())


def most_specific(found):
    """Weights of entries; of beginnings that stand for the same uses only the longest."""
    counts = {r["entry"]: (r["toxic"], r["other"]) for r in found}
    longer = {e[:-1] for e, n in counts.items() if counts.get(e[:-1]) == n and e[-1] != " "}
    whole = {e for e, n in counts.items() if e[-1] == " " and counts.get(e[:-1]) == n}
    return {r["entry"]: float(np.log(r["ratio"])) for r in found
            if r["entry"] not in longer and r["entry"] not in whole}


def with_measures(rows, lexicon, most_columns):
    """`rows` with `measured` (words, matched, weight) instead of the text."""
    names = [c for c in most_columns if c != "text"]

    def found(batches):
        automaton = lexicon.automaton()
        for batch in batches:
            for part in slices(batch):
                m = [list(map(float, measures(t or "", automaton)))
                     for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [pa.array(m, pa.list_(pa.float64()))],
                    [*names, "measured"])

    kinds = [f"{n} {rows.schema[n].dataType.simpleString()}" for n in names]
    return rows.mapInArrow(found, ", ".join([*kinds, "measured array<double>"]))


def learn(docs, labels, label="toxic", folds=3, held_out=1, most=MOST_LABELLED):
    """The lexicon and its curve from at most `most` labelled rows outside the held-out fold.

    Rows without label or id teach nothing; of repeated labels of one id the largest
    counts. Without rows of both labels the fixed list and a fixed curve are used.
    """
    rows = stored(training_rows(docs, labels, label, folds, held_out, most), "toxicity-rows")
    lexicon = Lexicon(first_entries() | learned_entries(rows))
    measured = (with_measures(rows, lexicon, rows.columns).groupBy("doc_id")
                .agg(F.max("label").alias("label"), F.max("measured").alias("measured")))
    table = measured.toPandas().sort_values("doc_id")  # at most `most` rows
    lexicon.curve = fit_curve(table["measured"].tolist(), table["label"].to_numpy())
    return lexicon


def score(docs, lexicon, out="score", keep=None):
    """The columns `keep` of `docs` (all by default) and `out` in [0, 1] from the whole text.

    One row per row of `docs`, without a shuffle. Only the text is read for the score, a null
    one as empty; nulls in other columns do not matter. A column that is already
    called `out` is replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != out]
    inner = docs.select(*keep) if "text" in keep else docs.select(*keep, "text")
    bounded_batches(docs.sparkSession)

    def rows(batches):
        automaton = lexicon.automaton()
        for batch in batches:
            for part in slices(batch):
                m = [measures(t or "", automaton) for t in part.column("text").to_pylist()]
                scores = sigmoid(curve_inputs(m) @ np.array(lexicon.curve))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], pa.array(scores, pa.float64())],
                    [*keep, out])

    kinds = [f"`{c}` {inner.schema[c].dataType.simpleString()}" for c in [*keep]]
    return inner.mapInArrow(rows, ", ".join([*kinds, f"`{out}` double"]))

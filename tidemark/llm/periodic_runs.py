"""Periodic runs of words by Baier grouping.

A run is a stretch of words with smallest period q that no neighbouring word extends. Every run
holds a Lyndon word of q words, its root, which is the longest Lyndon word at its place for one of two
orders of the words: some order and its reverse. The first phase of Baier's suffix
sorter groups all suffixes by their longest Lyndon prefix: groups are taken from the highest
down; each suffix of a group points at the nearest suffix to its left that lies in a lower
group, and suffixes hit l times move into a new group straight above their own, whose prefix is
longer by l prefixes of the group that hit them. What remains are the Lyndon
array (prefix lengths) and which prefixes are equal. Equal prefixes that follow each other are
roots of one run; common extensions to both sides (LCE) complete it.

A run with `exponent` periods holds each of its words `exponent` times. So words that are rarer in their
document part it into stretches first, and stretches that are too short hold no run; this
excludes no run and spares most ordinary prose. Documents are independent: one pass, no shuffle;
time and memory are linear in a text but for the extensions, which compare runs found with
themselves.
"""

import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.llm.shared import slices, texts_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_LENGTH = 24
EXPONENT = 3
#: Rounds of parting a text at rare words; more would only exclude more.
ROUNDS = 8
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
SCHEMA = ("doc_id bigint, n_words bigint, "
          "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def lyndon_groups(codes, n_codes):
    """Groups of suffixes by longest Lyndon prefix: (group of each position, prefix lengths).

    `codes` are numbers below `n_codes`, in their order; the end of the text is below all.
    """
    n = len(codes)
    group = list(codes)
    members = [[] for _ in range(n_codes)]
    for i, code in enumerate(codes):
        members[code].append(i)
    width = [1] * n_codes
    above = [*range(1, n_codes), -1]
    below = list(range(-1, n_codes - 1))
    # Positions whose group is still to come, as a linked list; n (or -1) stands for both ends.
    left, right = list(range(-1, n)), [*range(1, n + 1), 0]
    now = n_codes - 1
    while now >= 0:
        hit = {}
        target, times = -1, 0
        for i in members[now]:
            if group[i] != now:
                continue  # it has moved up since
            a, b = left[i], right[i]
            right[a], left[b] = b, a
            if a == target:
                times += 1
            else:
                if target >= 0:
                    hit.setdefault((times, group[target]), []).append(target)
                target, times = a, 1
        if target >= 0:
            hit.setdefault((times, group[target]), []).append(target)
        for times, old in sorted(hit, reverse=True):
            new, over = len(width), above[old]
            width.append(width[old] + times * width[now])
            above.append(over)
            below.append(old)
            above[old] = new
            if over >= 0:
                below[over] = new
            members.append(hit[times, old])
            for j in hit[times, old]:
                group[j] = new
        now = below[now]
    return group, width


def common_length(a, b):
    """How many leading entries of two arrays are equal."""
    n, at, step = min(len(a), len(b)), 0, 32
    while at < n:
        differ = a[at:min(n, at + step)] != b[at:min(n, at + step)]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, 4 * step
    return n


def runs_of_codes(codes, min_length=MIN_LENGTH, exponent=EXPONENT):
    """The set of (start, length, period) of all long enough runs of an array of numbers."""
    codes = np.unique(codes, return_inverse=True)[1]
    n, found = len(codes), set()
    if n < min_length:
        return found
    place = np.arange(n)
    for ordered in (codes, codes.max() - codes):
        group, width = lyndon_groups(ordered.tolist(), int(codes.max()) + 1)
        group = np.array(group)
        period = np.array(width)[group]
        after, before = place + period, place - period
        repeats = (after < n) & (group[np.minimum(after, n - 1)] == group)
        heads = repeats & ~((before >= 0) & (group[np.maximum(before, 0)] == group))
        for head in np.flatnonzero(heads).tolist():
            q, last = int(period[head]), head
            while repeats[last]:
                last += q
            # A run that is long enough holds so many whole roots in one of the orders.
            if (last - head) // q + 1 < (max(min_length, exponent * q) + 1) // q - 1:
                continue
            start = head - common_length(codes[:head][::-1], codes[:head + q][::-1])
            end = last + q + common_length(codes[last:], codes[last + q:])
            if end - start >= max(min_length, exponent * q):
                found.add((start, end - start, q))
    return found


def stretches(words, min_length=MIN_LENGTH, exponent=EXPONENT):
    """(start, end) of the stretches that may hold runs."""
    waiting = [(0, len(words), 0)]
    while waiting:
        start, end, rounds = waiting.pop()
        if end - start < min_length:
            continue
        part = words[start:end]
        counts = Counter(part)
        rare = {w for w, n in counts.items() if n < exponent}
        if not rare or rounds == ROUNDS:
            yield start, end
            continue
        begin = start
        for i in [start + i for i, w in enumerate(part) if w in rare] + [end]:
            if i - begin >= min_length:
                waiting.append((begin, i, rounds + 1))
            begin = i + 1


def runs_of_words(words, min_length=MIN_LENGTH, exponent=EXPONENT):
    """Sorted (start, length, period) of all runs of a list of words; periods within one start."""
    found = set()
    for start, end in stretches(words, min_length, exponent):
        number = {}
        codes = np.array([number.setdefault(w, len(number)) for w in words[start:end]])
        found.update((start + s, length, q)
                     for s, length, q in runs_of_codes(codes, min_length, exponent))
    return sorted(found, key=lambda run: (run[0], run[2]))


def without_repeats(words, runs):
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    kept, end = [], 0
    for a, b in sorted((s + q, s + length) for s, length, q in runs):
        if b > end:
            kept += words[end:max(a, end)]
            end = b
    return kept + words[end:]


def cycled_by_id(doc_id, words):
    """The words of a tenth of the ids made periodic from some word on, by a hash of the id."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[:n - a]


def find_runs(docs, min_length=MIN_LENGTH, exponent=EXPONENT, change=None):
    """`doc_id`, `n_words`, `runs` and the `collapsed` text of every row of `docs`.

    Words are what white space of ASCII parts; `change(doc_id, words)` may replace them before
    anything else. A run has at least `min_length` words and `exponent` periods; runs are
    ordered by start, then period. `collapsed` keeps of every run its first period, words joined
    by one space. A null or empty text has no words, no runs and an empty `collapsed`;
    repeated rows have a row each; a null id stays null; texts are taken whole; other columns
    are ignored.
    """
    if not (isinstance(exponent, int) and exponent >= 3):
        raise ValueError("exponent must be a whole number from 3 on: then a root repeats in its run")

    def rows(batches):
        for batch in batches:
            for part in slices(batch):
                counts, runs, collapsed = [], [], []
                for doc_id, text in zip(part.column(0).to_pylist(),
                                        part.column(1).cast(pa.binary()).to_pylist()):
                    words = text.split()
                    if change:
                        words = change(doc_id, words)
                    found = runs_of_words(words, min_length, exponent)
                    counts.append(len(words))
                    runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                    collapsed.append(b" ".join(without_repeats(words, found)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(runs, RUNS),
                     pa.array(collapsed, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])

    return texts_of(docs).mapInArrow(rows, SCHEMA)


def digest(found):
    """Per document: `doc_id`, `n_runs`, the run of the greatest exponent (ties: smallest start,
    then period; nulls without a run) and hashes of all runs and of the collapsed text."""
    def order(x, y):
        mine, other = x["length"] * y["period"], y["length"] * x["period"]
        return (F.when(mine > other, -1).when(mine < other, 1)
                .when(x["start"] != y["start"], F.signum(x["start"] - y["start"]).cast("int"))
                .otherwise(F.signum(x["period"] - y["period"]).cast("int")))

    best = F.get(F.array_sort("runs", order), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[
        r[c].cast("string") for c in ("start", "length", "period")]))
    text = F.concat_ws("", F.transform(lines, lambda line: F.concat(line, F.lit("\n"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))

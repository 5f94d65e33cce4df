"""Near-duplicate documents by Order MinHash and banded alignment.

Words are lower-cased and lose their punctuation. A document's k-mers are its runs of
k words, each labelled with how often it stood before, so that repeats count. For
each hash function of a family the labelled k-mers with the smallest hashes are taken
*in the order of the text*; two documents collide where these agree,
which order-preserving copies do far more often than mere sharers of passages. Documents
that collide are candidates, and are linked if the word-level edit distance, computed by
alignment in a band, is at most a fifth of the longer one. Classes are what links connect.

The main family takes 2 of the three-word k-mers, 32 times: at the least similarity, 0.8, some
97 in 100 pairs with scattered changes collide. Texts of at most `SHORT` words vary
more and also have 16 sketches of one k-mer. Texts of at most `TINY` words have a
key for each way to leave out as many words as may differ, which finds all their pairs.

Copies with the same words are one text throughout. Inside a bucket every member is first aligned
with the smallest one, so a group of m near copies costs m alignments. A bucket whose
members are then in several classes holds strangers. Of up to `CROWD` members, all pairs across
classes are aligned. With more members in up to `CROWD` classes, each member is aligned with one
representative of every other class. Beyond, strangers share a passage: the members' keys are
deepened by one more minimum of their sketch, in text order with the others, once for each of the next
`DEPTH` minima that fewer than `CROWD` classes of the bucket have. Those lie outside the passage, so
strangers part, and each member is aligned with one representative of each other class there.

These steps join groups at a cost that grows with members, but leave pairs out. So an exact one follows
for all members of large buckets that are still in several classes. They are dealt to bounded blocks by
length, and a task compares two blocks. Words of a text that no other class there has are changes; who
has more of them than the limit is alike to nobody and leaves, which few strangers survive. The rest are
compared by the words that pairs share, and aligned where these leave the distance open and the two are
not in one class yet. A text with many candidates first looks for segments: of two texts within d changes,
d + c disjoint segments of one have c that stand in the other as they are, since a change spoils one segment at
most. So nobody is left out: every link inside a bucket is found, or its ends are in one class already; only links
that unite classes leave a task, as links between classes, and so only classes that they connect are gone through
again. The number of pairs of blocks grows with the square of a crowded bucket, at up to a thousand members a block.
Texts under four words have no changes within the limit: only equal ones are alike.
"""

import itertools
import math
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.llm.components import components, with_further_edges
from tidemark.llm.shared import slices, texts_of
from tidemark.sources.shared_folder import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIMILARITY = 0.8
#: Words of a k-mer, sketches and k-mers of a sketch; for all texts, and for short ones also.
FAMILY = (3, 32, 2)
SHORT_FAMILY = (3, 16, 1)
SHORT = 75
TINY = 14
#: Word hashes are counted in so many bins, which bounds distances from below.
BINS = 32
#: Members of a bucket that are all aligned across classes, classes of a larger one whose members are
#: aligned with representatives, and further minima of a crowded one.
CROWD = 32
DEPTH = 4
#: Words of the segments that a text with more than `CROWD` candidates looks for. The first must be 1.
LENGTHS = (1, 2, 4)
#: So many of them must stand in another text, where a text has as many that are not much dearer than one.
HITS = 3
#: The low bits of a bucket key tell its sketch; the last number is that of keys of tiny texts.
SKETCH_BITS = 6
TINY_KEY = 63
SEED = 0x9E3779B97F4A7C15
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
FIRST_BAND = 16
CELLS = 1 << 16
#: Most texts and words of a block of members of crowded buckets, on average, and more blocks than a band has.
BLOCK = 1024
BLOCK_WORDS = 200_000
BANDS = 1 << 32


def word_hashes(texts):
    """Hashes of all words of an Arrow string array in a row, and where each text's begin."""
    plain = pc.replace_substring_regex(pc.utf8_lower(texts.cast(pa.string())),
                                       r"[^\pL\pN\s]+", "")
    lists = pc.utf8_split_whitespace(plain)
    words = lists.flatten().dictionary_encode()
    distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct], np.uint64)
    codes, at = words.indices.to_numpy(), lists.offsets.to_numpy().astype(np.int64)
    filled = np.array([bool(w) for w in distinct], bool)[codes] if len(distinct) else codes > 0
    at = np.append(0, np.cumsum(filled))[at]  # white space at the ends makes empty words
    return hashes[codes][filled] if len(distinct) else np.zeros(0, np.uint64), at


def mixed(x):
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def labelled_kmers(words, at, k=5):
    """Hashes of all labelled k-mers in a row, and where each text's begin."""
    lengths = np.maximum(np.diff(at) - k + 1, 0)
    starts = np.append(0, np.cumsum(lengths))
    of_text = np.repeat(np.arange(len(lengths)), lengths)
    first = np.arange(starts[-1]) - starts[:-1][of_text] + at[:-1][of_text]
    kmers = np.zeros(len(first), np.uint64)
    for i in range(k):
        kmers = mixed(kmers + words[first + i] + np.uint64(i + 1))
    own = kmers + mixed(of_text.astype(np.uint64) + np.uint64(1))
    order = np.argsort(own, kind="stable")
    ranked = own[order]
    new = np.append(True, ranked[1:] != ranked[:-1]) if len(ranked) else np.zeros(0, bool)
    run = np.arange(len(ranked))
    label = np.empty(len(ranked), np.uint64)
    label[order] = (run - np.maximum.accumulate(np.where(new, run, 0))).astype(np.uint64)
    return mixed(kmers + label * np.uint64(SEED)), starts


def order_minhash(kmers, starts, sketches=24, minima=3):
    """One row of `sketches` bucket keys for every text that has k-mers, and those texts."""
    some = np.flatnonzero(np.diff(starts))
    if not len(some):
        return np.zeros((0, sketches), np.uint64), some
    lengths = np.diff(starts)[some]
    begins = np.append(0, np.cumsum(lengths)[:-1])  # texts without k-mers take no room
    keys = np.empty((len(some), sketches), np.uint64)
    rows = np.arange(len(some))
    of_row = np.repeat(rows, lengths)
    seeds = mixed(np.arange(1, sketches + 1, dtype=np.uint64) * np.uint64(SEED))
    for s in range(sketches):
        hashes = mixed(kmers ^ seeds[s])
        places = np.full((len(some), minima), len(kmers))
        for m in range(minima):
            least = np.minimum.reduceat(hashes, begins)
            found = np.flatnonzero(hashes == least[of_row])
            owner, at = np.unique(of_row[found], return_index=True)
            found = found[at]
            real = hashes[found] != NONE
            places[owner[real], m] = found[real]
            hashes[found] = NONE
        places.sort(axis=1)
        taken = np.append(kmers, NONE)[places]
        key = np.full(len(some), s + 1, np.uint64)
        for m in range(minima):
            key = mixed(key * np.uint64(SEED) + taken[:, m])
        keys[:, s] = key
    return keys, some


def band_distances(pairs, width):
    """Edit distances of pairs of word arrays where they are at most `width`; else more."""
    order = sorted(range(len(pairs)), key=lambda p: -len(pairs[p][0]))
    la = np.array([len(pairs[p][0]) for p in order])
    lb = np.array([len(pairs[p][1]) for p in order])
    result = np.full(len(pairs), width + 1)
    cells = 2 * width + 1
    most = int(la[0])
    a = np.zeros((len(pairs), most), np.uint64)
    b = np.zeros((len(pairs), max(most, int(lb.max())) + cells + 1), np.uint64)
    known = np.zeros(b.shape, bool)
    for row, p in enumerate(order):
        a[row, :la[row]] = pairs[p][0]
        b[row, width:width + lb[row]] = pairs[p][1]
        known[row, width:width + lb[row]] = True
    far = np.int32(1 << 28)
    diagonal = np.arange(cells, dtype=np.int32)
    held = np.where(diagonal >= width, diagonal - width, far)[None, :].repeat(len(pairs), 0)
    ends = lb - la + width
    active = len(pairs)
    for i in range(most + 1):
        while active and la[active - 1] == i:
            active -= 1
            if 0 <= ends[active] < cells:
                result[order[active]] = held[active, ends[active]]
        if not active:
            break
        held = held[:active]
        differ = (b[:active, i:i + cells] != a[:active, i:i + 1]) | ~known[:active, i:i + cells]
        step = held + differ
        step[:, :-1] = np.minimum(step[:, :-1], held[:, 1:] + 1)
        held = np.minimum.accumulate(step - diagonal, axis=1) + diagonal
    return np.minimum(result, width + 1)


def trimmed(a, b):
    """Both arrays without what they have in common at their ends."""
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    head = n if same.all() else int(np.argmin(same))
    a, b, n = a[head:], b[head:], n - head
    same = a[len(a) - n:][::-1] == b[len(b) - n:][::-1]
    tail = n if same.all() else int(np.argmin(same))
    return a[:len(a) - tail], b[:len(b) - tail]


def shared_words(a, b):
    """How many words both have, repeats counted."""
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    return int(np.minimum(ca[i], cb[j]).sum())


def alike(pairs, similarity=SIMILARITY):
    """For pairs of word arrays: is 1 - distance / longer length at least `similarity`?

    Lengths and shared words bound the distance from below; what they leave open is
    aligned in a band that grows until it holds the distance or the limit.
    """
    result = np.zeros(len(pairs), bool)
    open_pairs = {}
    for p, (a, b) in enumerate(pairs):
        longer = max(len(a), len(b))
        limit = int(np.floor((1 - similarity) * longer + 1e-9))
        if abs(len(a) - len(b)) > limit:
            continue
        a, b = trimmed(a, b)
        if max(len(a), len(b)) <= limit:
            result[p] = True
        elif max(len(a), len(b)) - shared_words(a, b) <= limit:
            open_pairs.setdefault(min(limit, FIRST_BAND), []).append((p, a, b, limit))
    while open_pairs:
        width = min(open_pairs)
        waiting = sorted(open_pairs.pop(width), key=lambda x: len(x[1]))
        size = max(1, CELLS // (2 * width + 1))
        for i in range(0, len(waiting), size):
            some = waiting[i:i + size]
            for (p, a, b, limit), distance in zip(
                    some, band_distances([x[1:3] for x in some], width).tolist()):
                if distance <= width:
                    result[p] = True
                elif width < limit:
                    open_pairs.setdefault(min(limit, 4 * width), []).append((p, a, b, limit))
    return result


def limit_of(n_words, similarity):
    return int(np.floor((1 - similarity) * n_words + 1e-9))


def deletion_keys(words, similarity):
    """Hashes of a tiny text without each set of as many words as may differ from another one."""
    limits = [limit_of(n, similarity) for n in range(len(words), TINY + 1)
              if n - len(words) <= limit_of(n, similarity)]
    return [xxhash.xxh3_64_intdigest(words[list(kept)].tobytes(), seed=2)
            for gone in range(min(max(limits), len(words)) + 1)
            for kept in itertools.combinations(range(len(words)), len(words) - gone)]


def families(lengths):
    """(k, sketches, minima, first sketch number, rows) of the families of texts of some lengths."""
    return [(*FAMILY, 0, np.arange(len(lengths))),
            (*SHORT_FAMILY, FAMILY[1], np.flatnonzero(lengths <= SHORT))]


def numbered(keys, sketch):
    """Keys whose low bits are the number of their sketch."""
    low = np.uint64((1 << SKETCH_BITS) - 1)
    return keys & ~low | np.asarray(sketch).astype(np.uint64)


def words_of_rows(words, at, rows):
    """The words of some of the texts, and where each begins."""
    picked = np.concatenate([np.arange(at[i], at[i + 1]) for i in rows.tolist()] + [[]])
    return words[picked.astype(np.int64)], np.append(0, np.cumsum(np.diff(at)[rows]))


def bucket_keys(words, at, similarity=SIMILARITY):
    """The list of distinct bucket keys of every text."""
    lengths = np.diff(at)
    lists = [[] for _ in lengths]
    for k, sketches, minima, first, rows in families(lengths):
        w, begins = (words, at) if len(rows) == len(lengths) else words_of_rows(words, at, rows)
        keys, some = order_minhash(*labelled_kmers(w, begins, k), sketches, minima)
        keys = numbered(mixed(keys + np.uint64(minima)), first + np.arange(sketches))
        for row, key in zip(rows[some].tolist(), keys.view(np.int64).tolist()):
            lists[row] += key
    for row in np.flatnonzero((lengths > 0) & (lengths <= TINY)).tolist():
        found = np.array(deletion_keys(words[at[row]:at[row + 1]], similarity), np.uint64)
        lists[row] += numbered(found, TINY_KEY).view(np.int64).tolist()
    return [list(dict.fromkeys(x)) for x in lists]


def deeper_keys(words, at, crowded, depth=DEPTH):
    """For every text and each of its crowded keys: (key, deeper keys, one for each of the next
    `depth` minima of its sketch, smallest first). They tell where in the order of the text it stands."""
    lengths = np.diff(at)
    lists = [[] for _ in lengths]
    for k, sketches, minima, first, rows in families(lengths):
        w, begins = (words, at) if len(rows) == len(lengths) else words_of_rows(words, at, rows)
        kmers, starts = labelled_kmers(w, begins, k)
        seeds = mixed(np.arange(1, sketches + 1, dtype=np.uint64) * np.uint64(SEED))
        for i, row in enumerate(rows.tolist()):
            own = kmers[starts[i]:starts[i + 1]]
            for key in crowded[row]:
                sketch = (key & ((1 << SKETCH_BITS) - 1)) - first
                if not (0 <= sketch < sketches and len(own) > minima):
                    continue
                hashes = mixed(own ^ seeds[sketch])
                most = min(len(own), minima + depth)
                least = np.argpartition(hashes, most - 1)[:most]
                least = least[np.argsort(hashes[least], kind="stable")]
                taken, further = np.sort(least[:minima]), least[minima:]
                place = np.searchsorted(taken, further).astype(np.uint64)
                deeper = mixed(mixed(own[further] + np.uint64(key & ((1 << 64) - 1))) + place)
                lists[row].append((key, deeper.view(np.int64).tolist()))
    return lists


def segment_hashes(words):
    """For each of `LENGTHS`, the hashes of all runs of so many words, by their first word."""
    found = []
    for k in LENGTHS:
        runs = np.full(max(len(words) - k + 1, 0), k, np.uint64)
        for i in range(k):
            runs = mixed(runs * np.uint64(SEED) + words[i:i + len(runs)])
        found.append(runs.view(np.int64))
    return found


def cheap_segments(costs, need):
    """`need` or more disjoint segments (cost, number of `LENGTHS`, first word) whose costs add up to
    little. `costs` has a list for each of `LENGTHS`, one cost for each first word.

    With a price paid for each segment, the best ones are found in one pass; it doubles until there are
    enough, and twice more, because segments beyond `need` exclude many texts for little.
    """
    n, price, more = len(costs[0]), 0.5, 2
    need = min(need, n)
    while True:
        gain, via = [0.0], [None]
        for end in range(1, n + 1):
            best, step = gain[-1], None
            for which, k in enumerate(LENGTHS):
                if k <= end and gain[end - k] + price - costs[which][end - k] > best:
                    best, step = gain[end - k] + price - costs[which][end - k], which
            gain.append(best)
            via.append(step)
        found, end = [], n
        while end:
            which = via[end]
            end -= 1 if which is None else LENGTHS[which]
            if which is not None:
                found.append((costs[which][end], which, end))
        if len(found) >= need and not more:
            return found
        more -= len(found) >= need
        price *= 2


def binned(words, at):
    """How many words of each text fall into each of `BINS` bins."""
    of_text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    at_bin = of_text * BINS + (mixed(words) % np.uint64(BINS)).astype(np.int64)
    return np.bincount(at_bin, minlength=(len(at) - 1) * BINS).reshape(-1, BINS)


def sketched(docs, similarity=SIMILARITY):
    """`doc_id`, `body` (hash of the words of the text), `n_words`, bucket `keys` and `bins`."""
    def rows(batches):
        for batch in batches:
            for part in slices(batch):
                words, at = word_hashes(part.column("text"))
                bodies = [body_of(words[a:b])
                          for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(bodies, pa.binary()),
                     pa.array(np.diff(at), pa.int64()),
                     pa.array(bucket_keys(words, at, similarity), pa.list_(pa.int64())),
                     pa.array(binned(words, at).tolist(), pa.list_(pa.int32()))],
                    ["doc_id", "body", "n_words", "keys", "bins"])

    return texts_of(docs).where("doc_id is not null").mapInArrow(
        rows, "doc_id bigint, body binary, n_words bigint, keys array<bigint>, bins array<int>")


def near_lengths(a, b, similarity):
    return F.least(a, b) >= similarity * F.greatest(a, b) - 1e-6


def within_counts(bins_a, n_a, bins_b, n_b, similarity):
    """Do the word counts leave a distance within the limit? A change moves one word out of
    a bin and one into a bin at most."""
    apart = F.aggregate(F.zip_with(bins_a, bins_b, lambda x, y: F.abs(x - y)),
                        F.lit(0), lambda x, y: x + y)
    limit = F.floor((1 - similarity) * F.greatest(F.col(n_a), F.col(n_b)) + 1e-9)
    return apart + F.abs(F.col(n_a) - F.col(n_b)) <= 2 * limit


def shuffled(rows):
    """Joined by a shuffle at any size: beside whole texts, plans that change with the number of
    pairs would make the growth of a job hard to foresee."""
    return rows.hint("merge")


def possible(pairs, texts, similarity):
    """The pairs (`a`, `b`) whose lengths and word counts leave a distance within the limit, with the
    hashes of their words."""
    for side in ("a", "b"):
        own = texts.select(F.col("doc_id").alias(side), F.col("n_words").alias(f"n_{side}"),
                           F.col("bins").alias(f"bins_{side}"), F.col("body").alias(f"body_{side}"))
        pairs = shuffled(pairs).join(own, side)
    return pairs.where(near_lengths(F.col("n_a"), F.col("n_b"), similarity)
                       & within_counts("bins_a", "n_a", "bins_b", "n_b", similarity)
                       ).select("a", "b", "body_a", "body_b")


def body_of(words):
    return xxhash.xxh3_128_digest(words.tobytes())


def verified(pairs, docs, similarity):
    """The pairs (`a`, `b`) of document ids, with the hashes of their words, whose texts are alike. Of
    rows that repeat an id, the one with those words is its text."""
    pairs = stored(pairs, "omh-pairs")
    ids = pairs.selectExpr("a as doc_id").union(pairs.selectExpr("b as doc_id")).distinct()
    # Texts of documents in no pair move once.
    texts = stored(texts_of(docs).join(shuffled(ids), "doc_id", "left_semi"), "omh-texts")
    sides = shuffled(pairs).join(
        texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = shuffled(sides).join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")

    def tested(batches):
        for batch in batches:
            for part in slices(batch, "text_b", 2_000_000):
                sides = {}
                for side in ("a", "b"):
                    words, at = word_hashes(part.column(f"text_{side}"))
                    own = [words[x:y] for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
                    bodies = part.column(f"body_{side}").to_pylist()
                    sides[side] = own, [body_of(w) == body for w, body in zip(own, bodies)]
                ok = np.array(sides["a"][1]) & np.array(sides["b"][1])
                at = np.flatnonzero(ok)
                ok[at] = alike([(sides["a"][0][i], sides["b"][0][i]) for i in at.tolist()], similarity)
                yield pa.RecordBatch.from_arrays(
                    [part.column(name) for name in ("a", "b")], ["a", "b"]).filter(pa.array(ok))

    # Rows that repeat as a whole may list a pair again.
    return both.select("a", "b", "body_a", "body_b", "text_a", "text_b").mapInArrow(
        tested, "a bigint, b bigint")


def across(members, similarity):
    """Pairs (`a`, `b`) of every member (`key`, `doc_id`, `n_words`, `class`) of a bucket and the
    smallest member of each other class there, once for each bucket."""
    reps = stored(members.groupBy("key", "class").agg(
        F.min(F.struct("doc_id", "n_words")).alias("rep")).select(
        "key", F.col("class").alias("other"), F.col("rep.doc_id").alias("r"),
        F.col("rep.n_words").alias("r_words")), "omh-representatives")
    met = members.join(reps, "key").where(
        (F.col("class") != F.col("other")) & near_lengths(F.col("n_words"), F.col("r_words"), similarity))
    return met.select(F.least("r", "doc_id").alias("a"), F.greatest("r", "doc_id").alias("b"))


def with_classes(members, known):
    return members.join(known, members["doc_id"] == known["node"], "left").select(
        "key", "doc_id", "n_words", F.coalesce("component", "doc_id").alias("class"))


def mixed_buckets(members):
    """Keys of buckets that hold several classes, how many, and how many members."""
    classes = members.groupBy("key", "class").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.count("*").alias("classes"), F.sum("n").alias("members"))
    return classes.where("classes > 1")


def crossed(members, similarity):
    """All pairs (`a`, `b`) of members of a bucket that are in different classes, once for each bucket."""
    others = members.select("key", F.col("doc_id").alias("b"), F.col("n_words").alias("b_words"),
                            F.col("class").alias("other"))
    met = members.join(others, "key").where(
        (F.col("doc_id") < F.col("b")) & (F.col("class") != F.col("other"))
        & near_lengths(F.col("n_words"), F.col("b_words"), similarity))
    return met.select(F.col("doc_id").alias("a"), "b")


def deepened(members, docs, texts):
    """Members of crowded buckets under deeper keys that between two and `CROWD` classes have."""
    crowded = members.groupBy("doc_id", "n_words", "class").agg(F.collect_set("key").alias("crowded"))
    crowded = crowded.join(shuffled(texts.select("doc_id", "body")), "doc_id")
    rows = texts_of(docs).join(shuffled(crowded), "doc_id")
    names = ["doc_id", "n_words", "class"]

    def found(batches):
        for batch in batches:
            for part in slices(batch):
                words, at = word_hashes(part.column("text"))
                bodies = part.column("body").to_pylist()
                lists = deeper_keys(words, at, part.column("crowded").to_pylist())
                of, deep = [], []
                for i, own in enumerate(lists):
                    if body_of(words[at[i]:at[i + 1]]) == bodies[i]:
                        for _, deeper in own:
                            of += [i] * len(deeper)
                            deep += deeper
                of = pa.array(of, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(deep, pa.int64()), *[part.column(name).take(of) for name in names]],
                    ["key", *names])

    under = stored(rows.select(*names, "text", "crowded", "body").mapInArrow(
        found, "key bigint, doc_id bigint, n_words bigint, class bigint").distinct(), "omh-deep")
    some = stored(mixed_buckets(under).where(F.col("classes") < CROWD).select("key"), "omh-mixed")
    return stored(under.join(some, "key"), "omh-deepened")


def in_order(text, others, similarity):
    """Which of the other texts hold as many segments of a text as changes must leave? A text looks
    for ones that few others have; all that are alike do."""
    hashes = [x.tolist() for x in segment_hashes(text)]
    held = [set(np.concatenate(segment_hashes(x)).tolist()) for x in others]
    counts = Counter(itertools.chain.from_iterable(held))
    limit = limit_of(max(len(x) for x in [text, *others]), similarity)
    chosen = sorted(cheap_segments([[counts[x] for x in some] for some in hashes], limit + 1))[:limit + HITS]
    sought = [hashes[which][first] for _, which, first in chosen]
    return np.array([sum(x in own for x in sought) >= len(chosen) - limit for own in held], bool)


def unshared(codes, owner, classes):
    """How many words of each text stand in no text of another class."""
    low, high = (np.full(codes.max(initial=0) + 1, x) for x in (len(classes), -1))
    _, number = np.unique(classes, return_inverse=True)
    np.minimum.at(low, codes, number[owner])
    np.maximum.at(high, codes, number[owner])
    return np.bincount(owner, weights=(low == high)[codes], minlength=len(classes))


def uniting_links(texts, classes, first, similarity):
    """Links (i, j) that unite all classes which alike pairs connect; `first` tells which texts are
    paired with the others, None pairs all.

    Words that no other class has are changes, so texts with too many of them leave, until nobody does.
    What stays is compared by the words that two texts share, and aligned if these leave it open.
    """
    lengths = np.array([len(x) for x in texts])
    limits = np.floor((1 - similarity) * lengths + 1e-9)
    owner = np.repeat(np.arange(len(texts)), lengths)
    codes = np.unique(np.concatenate(texts), return_inverse=True)[1]
    stays = np.ones(len(texts), bool)
    while True:
        leaves = stays & (unshared(codes, owner, classes) > limits)
        if not leaves.any():
            break
        stays &= ~leaves
        codes, owner = codes[stays[owner]], owner[stays[owner]]
    n_codes = codes.max(initial=0) + 1
    entries, times = np.unique(owner * n_codes + codes, return_counts=True)
    owner, codes = entries // n_codes, entries % n_codes
    begins = np.searchsorted(owner, np.arange(len(texts) + 1))
    seconds = stays if first is None else stays & ~first
    of_second = seconds[owner]
    other_codes, other_times = codes[of_second], times[of_second]
    others = np.flatnonzero(seconds)
    starts = np.searchsorted(owner[of_second], others)
    united, links, has = classes.copy(), [], np.zeros(n_codes, np.int64)
    for i in np.flatnonzero(stays if first is None else stays & first).tolist() if len(others) else []:
        own = slice(begins[i], begins[i + 1])
        has[codes[own]] = times[own]
        shared = np.add.reduceat(np.minimum(has[other_codes], other_times), starts)
        has[codes[own]] = 0
        longer = np.maximum(lengths[i], lengths[others])
        near = longer - shared <= np.maximum(limits[i], limits[others])
        met = others[near & (united[others] != united[i]) & ((others > i) | (first is not None))]
        if len(met) > CROWD:
            met = met[in_order(texts[i], [texts[j] for j in met.tolist()], similarity)]
        while len(met):
            some, met = met[:CROWD], met[CROWD:]
            ok = alike([(texts[i], texts[j]) for j in some.tolist()], similarity)
            for j in some[ok].tolist():
                if united[j] != united[i]:
                    united[united == united[j]] = united[i]
                    links.append((i, j))
            met = met[united[met] != united[i]]
    return links


def crowded_links(members, docs, texts, similarity):
    """Classes (`a`, `b`) that alike members of a bucket unite, as links that reach all of them.

    Buckets with the same largest class are one group, so that copies which meet in many of them meet
    once. The members of a group are dealt to blocks by their length and id; every block is compared with itself and
    with those of the same and of the next length.
    """
    held = members.groupBy("key", "class").agg(F.count("*").alias("n"))
    of_key = held.groupBy("key").agg(F.max(F.struct("n", "class")).alias("most")).select(
        "key", F.col("most.class").alias("group"))
    # Texts that may be alike are in one band or in neighbouring ones.
    width = -math.log(max(similarity, 1e-9)) + 1e-6
    grouped = stored(members.join(of_key, "key").select(
        "group", "doc_id", "n_words", "class",
        F.floor(F.log("n_words") / width).alias("band")).distinct(), "omh-groups")
    parts = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_words") / BLOCK_WORDS))
    sizes = stored(grouped.groupBy("group", "band").agg(parts.alias("parts")), "omh-blocks")
    other = sizes.select("group", F.col("band").alias("other"), F.col("parts").alias("other_parts"))
    part = F.pmod(F.xxhash64("doc_id"), F.col("parts"))
    place, met = F.col("band") * BANDS + part, F.col("other") * BANDS + F.col("other_part")
    near = F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)).alias("other")
    dealt = grouped.join(sizes, ["group", "band"]).select("*", near).join(other, ["group", "other"]).select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("other_parts") - 1)).alias("other_part"))
    dealt = stored(dealt.select("group", "doc_id", "class", place.alias("place"), F.least(place, met).alias("low"),
                                F.greatest(place, met).alias("high")), "omh-dealt")
    # Where one class is alone, there is nothing to unite.
    several = dealt.groupBy("group", "low", "high").agg(
        F.min("class").alias("least"), F.max("class").alias("most")).where("least < most")
    dealt = dealt.join(several.select("group", "low", "high"), ["group", "low", "high"])
    own = members.select("doc_id").distinct().join(shuffled(texts.select("doc_id", "body")), "doc_id")

    def hashed(batches):
        for batch in batches:
            for part in slices(batch):
                words, at = word_hashes(part.column("text"))
                found = [words[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                own = [body_of(w) == body for w, body in zip(found, part.column("body").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([w.tobytes() for w in found], pa.binary())],
                    ["doc_id", "words"]).filter(pa.array(own, pa.bool_()))

    words = stored(texts_of(docs).join(shuffled(own), "doc_id").select("doc_id", "text", "body").mapInArrow(
        hashed, "doc_id bigint, words binary").distinct(), "omh-words")

    def compared(block):
        classes, place = block.column("class").to_numpy(), block.column("place").to_numpy()
        found = [np.frombuffer(x, np.uint64) for x in block.column("words").to_pylist()]
        links = uniting_links(found, classes,
                              None if (place == place[0]).all() else place == place.min(), similarity)
        pairs = np.sort(classes[np.array(links, np.int64).reshape(-1, 2)], axis=1)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return dealt.join(shuffled(words), "doc_id").groupBy("group", "low", "high").applyInArrow(
        compared, "a bigint, b bigint")


def near_duplicates(docs, similarity=SIMILARITY):
    """`doc_id`, `class_id` (smallest id of its class) and `kept` (the two are equal).

    One row per distinct id. Documents with the same words are in one class, and so are
    those connected by links between candidates; a text of no words is like all
    others of no words. Repeated rows of an id stand for one document, whose words are those
    with the smallest hash; rows without id have no class and no row; null texts are
    empty ones; other columns are ignored.
    """
    one_each = stored(sketched(docs, similarity).groupBy("doc_id")
                      .agg(F.min(F.struct("body", "n_words", "keys", "bins")).alias("text"))
                      .select("doc_id", "text.*"), "omh-sketches")
    # Written before they are joined: then Spark can split a crowded group of copies.
    bodies = stored(one_each.groupBy("body").agg(F.min("doc_id").alias("first")), "omh-bodies")
    members = one_each.select("doc_id", "body").join(bodies, "body").select("doc_id", "first")
    texts = one_each.join(bodies.select(F.col("first").alias("doc_id")), "doc_id", "left_semi")
    buckets = texts.select("doc_id", "n_words", F.explode("keys").alias("key"))
    # Heads are written before they are joined: then Spark can split a crowded bucket.
    head = F.min(F.struct("doc_id", "n_words")).alias("head")
    heads = stored(buckets.groupBy("key").agg(head, F.count("*").alias("n")).where("n > 1")
                   .select("key", F.col("head.doc_id").alias("a"),
                           F.col("head.n_words").alias("a_words")), "omh-heads")
    shared = stored(buckets.join(heads, "key"), "omh-buckets")
    first = shared.where((F.col("a") < F.col("doc_id"))
                         & near_lengths(F.col("n_words"), F.col("a_words"), similarity))
    first = stored(first.select("a", F.col("doc_id").alias("b")).distinct(), "omh-first")
    known = components(verified(possible(first, one_each, similarity), docs, similarity), "omh-classes")
    # Buckets of several classes: their heads were strangers to some.
    left = stored(with_classes(shared, known), "omh-left")
    several = stored(mixed_buckets(left), "omh-mixed")
    small, crowd = F.col("members") <= CROWD, F.col("classes") > CROWD
    tiny = F.col("key").bitwiseAND(TINY_KEY) == TINY_KEY
    close = left.join(several.where(small).select("key"), "key")
    large = stored(left.join(several.where(~small).select("key", "classes"), "key"), "omh-large")
    few = large.where(~crowd).drop("classes")
    many = large.where(crowd & ~tiny).drop("classes")
    pairs = crossed(close, similarity).union(across(few, similarity)).union(
        across(deepened(many, docs, one_each), similarity)).distinct().join(
        first, ["a", "b"], "left_anti")
    pairs = stored(pairs, "omh-second")
    more = verified(possible(pairs, one_each, similarity), docs, similarity)
    classes = with_further_edges(known, more, "omh-classes")
    # Large buckets still of several classes: what no representative and no deeper key brought together.
    large = stored(with_classes(large.select("key", "doc_id", "n_words"), classes), "omh-left")
    several = large.groupBy("key").agg(F.min("class").alias("least"), F.max("class").alias("most"))
    rest = stored(large.join(several.where("least < most").select("key"), "key"), "omh-rest")
    if not rest.isEmpty():
        classes = with_further_edges(classes, crowded_links(rest, docs, one_each, similarity), "omh-classes")
    class_id = F.coalesce("component", "first")
    return members.join(classes, members["first"] == classes["node"], "left").select(
        "doc_id", class_id.alias("class_id"), (class_id == F.col("doc_id")).alias("kept"))

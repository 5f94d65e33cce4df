"""Phrase collocations by top-order marginalisation.

Every word begins exactly one window of `LONGEST` words, made of the word and lead columns, padded
where its piece of text ends. Only these longest windows are counted. A ROLLUP over their columns
sums the counts of all windows with a common beginning, which are the counts of the
shorter phrases: no shorter n-gram is ever made from the texts.

Windows hold 64-bit codes of words, hashes of language and word, which keeps the shuffled rows short.
That no two words share a code is checked on the whole vocabulary, which Spark collects in
its own table; if two did, another seed would be taken. So counts are exact.

Tasks merge equal windows before they are shuffled; a phrase that a third of all texts hold costs a
few rows per task. What occurs fewer than `least` times is neither a candidate nor a part of
one. So windows are padded from the first word on that is rarer in its language, prefixes that turn out
rarer are padded before the ROLLUP, and all joins are among phrases that occur `least` times.
Tasks know rare words by a bit set of `BITS` bits over the codes of the others; a rare word whose bit another
one has set stays in its windows, which costs rows and changes no count.

The windows of one prefix meet in one task, unless all its words are common: then their last words
deal them to `DEALS` tasks. A word is common if it makes up one in `COMMON` of all words,
so there are at most `COMMON` of these, and a prefix that is not dealt is no more frequent. This list
and the bit set are all that is collected and broadcast, at any size of the input.
"""

import string
import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.llm.shared import bounded_batches, slices
from tidemark.sources.shared_folder import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LONGEST = 3
LEAST = 10
TOP = 2000
#: A candidate goes where a longer one holds it in at least so many of a hundred occurrences.
WITHIN = 50
SCALE = 1_000_000
UNKNOWN = "und"
#: Ends a piece of text; no word can hold it.
STOP = b"."
STOPS = b".,;:!?\n\x0b\x0c\r"
PLAIN = bytes.maketrans(string.ascii_uppercase.encode() + STOPS,
                        string.ascii_lowercase.encode() + STOP * len(STOPS))
#: Stands where a window is shorter; no word has it as its code.
PAD = 0
SALTS = 64
DEALS = 64
COMMON = 200
#: Rows of windows that a task holds to merge them.
HELD_ROWS = 1_000_000
BITS = 1 << 26
BITS_OF_ROW = 1 << 15  # of a row that Spark's bitmap functions make
WORDS = [f"w{i}" for i in range(LONGEST)]


def words_of(texts):
    """The words of some texts in a row, with a stop after every piece."""
    return STOP.join(texts).translate(PLAIN).replace(STOP, b" . ").split() + [STOP]


def by_language(batches):
    """(language, numbered distinct words, their numbers in the texts) of parts of the batches."""
    for batch in batches:
        for part in slices(batch):
            texts = {}
            for lang, text in zip(part.column(0).to_pylist(),
                                  part.column(1).cast(pa.binary()).to_pylist()):
                texts.setdefault(lang, []).append(text)
            for lang, own in texts.items():
                words = words_of(own)
                distinct = dict.fromkeys([STOP, *words])
                for number, word in enumerate(distinct):
                    distinct[word] = number
                yield lang, list(distinct), np.fromiter(
                    map(distinct.__getitem__, words), np.int64, len(words))


def codes_of(lang, distinct, seed):
    """Codes of distinct words; the stop, which comes first, is coded as the pad."""
    salt = lang.encode() + b"\n"
    found = [xxhash.xxh3_64_intdigest(salt + word, seed) or 1 for word in distinct]
    found[0] = PAD
    return np.array(found, np.uint64).view(np.int64)


def counted_windows(numbers, n_distinct):
    """(numbers of the words of each distinct window, its count); the stop is number 0."""
    padded = np.append(numbers, np.zeros(LONGEST - 1, np.int64))
    columns, inside = [numbers], numbers > 0
    for lead in range(1, LONGEST):
        word = padded[lead:lead + len(numbers)]
        inside = inside & (word > 0)
        columns.append(np.where(inside, word, 0))
    columns = [c[numbers > 0] for c in columns]
    if n_distinct ** LONGEST >= 2 ** 63:
        rows, counts = np.unique(np.stack(columns), axis=1, return_counts=True)
        return list(rows), counts
    key = columns[0]
    for column in columns[1:]:
        key = key * n_distinct + column
    key, counts = np.unique(key, return_counts=True)
    rows = []
    for _ in WORDS:
        key, word = np.divmod(key, n_distinct)
        rows.append(word)
    return rows[::-1], counts


def texts_by_language(docs):
    bounded_batches(docs.sparkSession)
    return docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"),
                       F.coalesce("text", F.lit("")).alias("text"))


def bit_set(words, least):
    """The set of the codes (modulo `BITS`) of words that occur `least` times."""
    bit = F.pmod("code", F.lit(BITS)) + 1  # Spark's buckets and positions count from 1
    rows = (words.where(F.col("n") >= least).groupBy(F.bitmap_bucket_number(bit).alias("row"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")))
    held = np.zeros((BITS // BITS_OF_ROW, BITS_OF_ROW // 8), np.uint8)
    for row, bits in rows.collect():
        held[row - 1] = np.frombuffer(bits, np.uint8)
    return held.ravel()


def is_set(bits, codes):
    bit = codes % BITS
    return (bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def common_codes(words):
    """The codes of words that make up one in `COMMON` of all."""
    total = words.agg(F.sum("n")).first()[0] or 0
    rows = words.where(F.col("n") * COMMON >= total).select("code").collect()
    return np.array([row[0] for row in rows], np.int64)


def merged(columns, counts):
    """Equal rows of codes as one, with the sum of their counts, and rows of one first word
    together. Rows meet by a hash; one that meets a stranger first only stays apart."""
    first, mixed = columns[0].view(np.uint64), np.zeros(len(counts), np.uint64)
    for column in columns:
        mixed = (mixed + column.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(first >> np.uint64(40) << np.uint64(40) | mixed >> np.uint64(24))
    columns = [column[order] for column in columns]
    differ = np.ones(len(order), bool)
    differ[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    starts = np.flatnonzero(differ)
    return [c[starts] for c in columns], np.add.reduceat(counts[order], starts)


def windows(docs, seed, frequent, common):
    """`w0`, `w1`, ... (codes, padded), `f` and `deal`: windows counted within parts of a task's
    texts, and the part of their prefix that they are dealt to."""
    def counted(batches):
        for lang, distinct, numbers in by_language(batches):
            codes = codes_of(lang, distinct, seed)
            numbers = np.where(is_set(frequent.value, codes), np.arange(len(codes)), 0)[numbers]
            found, counts = counted_windows(numbers, len(distinct))
            yield [codes[c] for c in found], counts

    def batch(held):
        columns, counts = merged([np.concatenate([found[i] for found, _ in held])
                                  for i in range(LONGEST)], np.concatenate([c for _, c in held]))
        dealt = np.all([np.isin(c, common) for c in columns[:-1]], axis=0)
        deal = np.where(dealt, 1 + columns[-1] % DEALS, 0).astype(np.int8)
        return pa.RecordBatch.from_arrays(
            [*[pa.array(c) for c in columns], pa.array(counts), pa.array(deal)],
            [*WORDS, "f", "deal"])

    def rows(batches):
        held, size = [], 0
        for found, counts in counted(batches):
            if len(counts):
                held.append((found, counts))
                size += len(counts)
            if size >= HELD_ROWS:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)

    return texts_by_language(docs).mapInArrow(
        rows, ", ".join(f"{c} bigint" for c in [*WORDS, "f"]) + ", deal tinyint")


def vocabulary(docs, seed):
    """Every word of every language once: `lang`, `word`, `code`, `n`."""
    def rows(batches):
        for lang, distinct, numbers in by_language(batches):
            counts = np.bincount(numbers, minlength=len(distinct))[1:]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(counts), pa.string()), pa.array(distinct[1:], pa.binary()).cast(pa.string()),
                 pa.array(codes_of(lang, distinct, seed)[1:]), pa.array(counts)],
                ["lang", "word", "code", "n"])

    return (texts_by_language(docs).mapInArrow(rows, "lang string, word string, code bigint, n bigint")
            .groupBy("code", "lang", "word").agg(F.sum("n").alias("n")))


def coded_vocabulary(docs, seeds=range(8)):
    """The vocabulary with codes of which no two are equal, and their seed."""
    for seed in seeds:
        words = stored(vocabulary(docs, seed), "vocabulary")
        if words.groupBy("code").count().where("count > 1").isEmpty():
            return words, seed
    raise RuntimeError("two words share a code under every seed")


def phrase_counts(docs, words, seed, least=LEAST):
    """(`w0`, `w1`, ..., `n_words`, `f`): the phrases of 1 to `LONGEST` words, by their codes, that
    occur `least` times."""
    frequent = docs.sparkSession.sparkContext.broadcast(bit_set(words, least))
    prefix = WORDS[:-1]
    found = windows(docs, seed, frequent, common_codes(words))
    # The tasks have merged their windows: no second time before the shuffle.
    counted = found.repartition(*prefix, "deal").groupBy(*prefix, "deal", WORDS[-1]).agg(
        F.sum("f").alias("f"))
    # One condition on both: Spark would move one on the pad below the shuffle, and then read twice.
    longest = counted.where(F.when(F.col("f") >= least, F.col(WORDS[-1]) != PAD))
    # In the same partitions; a prefix that was dealt may be frequent in all of them together.
    whole = counted.groupBy(*prefix, "deal").agg(F.sum("f").alias("f"))
    kept = (F.col("f") >= least) | (F.col("deal") > 0)
    pruned = whole.select(prefix[0], *[F.when(kept, F.col(w)).otherwise(PAD).alias(w)
                                       for w in prefix[1:]], "f")
    rolled = (pruned.rollup(*prefix)
              .agg(F.grouping_id(*prefix).alias("level"), F.sum("f").alias("f"))
              .where(F.col("f") >= least))
    # grouping_id is 0 for whole prefixes, 1 without the last word, 3 without the last two, ...
    n_words = F.coalesce(*[F.when(F.col("level") == 2 ** i - 1, LONGEST - 1 - i)
                           for i in range(LONGEST)])
    shorter = rolled.withColumn("n_words", n_words).where("n_words > 0")
    for i, w in enumerate(prefix):  # a prefix that ends in pads is that of a shorter window
        shorter = shorter.where((F.col("n_words") <= i) | (F.col(w) != PAD))
    shorter = shorter.select(*[F.coalesce(w, F.lit(PAD)).alias(w) for w in prefix],
                             F.lit(PAD).cast("bigint").alias(WORDS[-1]), "n_words", "f")
    return longest.select(*WORDS, F.lit(LONGEST).alias("n_words"), "f").union(shorter)


def padded(words):
    return F.struct(*[(words[i] if i < len(words) else F.lit(PAD).cast("bigint")).alias(w)
                      for i, w in enumerate(WORDS)])


def scored_phrases(counts):
    """Candidates with the counts `l`, `r` of the two parts at their weakest cut and its `score`."""
    candidates = counts.where("n_words >= 2").select(
        F.struct(*WORDS).alias("phrase"), "n_words", F.col("f").alias("a"))
    words = [F.col(f"phrase.{w}") for w in WORDS]
    parts = [F.when(F.col("n_words") == n, F.struct(
        F.lit(k).alias("k"), F.lit(side).alias("side"), padded(part).alias("part")))
        for n in range(2, LONGEST + 1) for k in range(1, n)
        for side, part in (("l", words[:k]), ("r", words[k:n]))]
    sides = candidates.select("phrase", "a", "n_words", F.inline(F.array_compact(F.array(*parts))))
    known = counts.select(F.struct(*WORDS).alias("part"), F.col("f").alias("of_part"))
    each = sides.join(known, "part").groupBy("phrase", "n_words", "a", "k").agg(
        *[F.max(F.when(F.col("side") == side, F.col("of_part"))).alias(side) for side in ("l", "r")])
    wide = {c: F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r")}
    score = F.call_function("div", wide["a"] * wide["a"] * F.lit(SCALE).cast("decimal(7,0)"),
                            wide["l"] * wide["r"])
    weakest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return (each.withColumn("score", score).groupBy("phrase", "n_words", "a").agg(weakest)
            .select("phrase", "n_words", "a", "cut.l", "cut.r", "cut.score"))


def covered(counts, within=WITHIN):
    """Candidates that a longer one holds too often. One of one more word tells: counts fall with
    length, so it occurs as often as any still longer one."""
    words = [F.col(w) for w in WORDS]
    inner = [F.when(F.col("n_words") == n, padded(part)) for n in range(3, LONGEST + 1)
             for part in (words[:n - 1], words[1:n])]
    longer = counts.where("n_words >= 3").select(
        F.col("f").alias("longer"), F.explode(F.array_compact(F.array(*inner))).alias("phrase"))
    most = longer.groupBy("phrase").agg(F.max("longer").alias("longer"))
    own = counts.where("n_words >= 2").select(F.struct(*WORDS).alias("phrase"), "f")
    return most.join(own, "phrase").where(100 * F.col("longer") >= within * F.col("f")).select("phrase")


def spelled(phrases, words):
    """The phrases with their `lang` and as text, their words joined by spaces."""
    for i, w in enumerate(WORDS):
        named = words.select(F.col("code").alias(w), F.col("word").alias(f"t{i}"),
                             *([F.col("lang")] if i == 0 else []))
        phrases = phrases.withColumn(w, F.col(f"phrase.{w}")).join(
            named, w, "inner" if i < 2 else "left").drop(w)
    return phrases.withColumn("phrase", F.concat_ws(" ", *[f"t{i}" for i in range(LONGEST)]))


def top_of_each(rows, key, order, most):
    """The first `most` rows of every key with their `rank`; first among a part of a key's rows,
    so that no task sorts all of them."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = Window.partitionBy(key, "salt").orderBy(*order)
    best = salted.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= most)
    return best.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(
        F.col("rank") <= most).drop("salt")


def collocations(docs, least=LEAST, top=TOP, within=WITHIN):
    """The `top` phrases of each language: `lang`, `rank`, `phrase`, `a`, `l`, `r`, `n`, `score`.

    Texts are lower-cased (A-Z), parted into pieces at stops and line ends, and these into words at
    blanks and tabs. Candidates occur at least `least` times in all texts of their language; a
    null language is `und`. The score is floor(10^6 a^2 / (l r)) at the weakest cut (ties: the
    first), in exact arithmetic; `n` counts all words of the language. Ties of score and count
    go by the bytes of the phrase. Null and empty texts have no words; repeated rows count each;
    texts are taken whole; an empty table has no phrases; other columns are ignored.
    """
    words, seed = coded_vocabulary(docs)
    counts = stored(phrase_counts(docs, words, seed, least), "phrases")
    own = scored_phrases(counts).join(covered(counts, within), "phrase", "left_anti")
    best = top_of_each(spelled(own, words.where(F.col("n") >= least)), "lang",
                       (F.desc("score"), F.desc("a"), F.asc("phrase")), top)
    n = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(n, "lang").select(
        "lang", F.col("rank").cast("bigint"), "phrase", "a", "l", "r", "n", "score")

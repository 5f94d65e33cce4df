"""Near-duplicates, scores, mixing and licences."""

import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import (bradley_terry, licenses, order_minhash, soft_mix, toxicity)
from tidemark.llm.shared import BATCH_BYTES, bounded_batches, bounded_sample, fold

WORDS = [a + b + c for a in ("ba", "ke", "li", "mo", "nu", "ra") for b in ("l", "r", "st", "nd")
         for c in ("a", "en", "ix", "o", "um")]

# ------------------------------------------------------------ near-duplicates


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def edited(source, words, edits):
    words = list(words)
    for _ in range(edits):
        at = source.randrange(len(words))
        kind = source.randrange(3)
        if kind == 0:
            words[at] = source.choice(WORDS)
        elif kind == 1:
            words.insert(at, source.choice(WORDS))
        elif len(words) > 1:
            del words[at]
    return words


def test_band_distances_by_brute_force():
    source = random.Random(2)
    pairs = []
    for _ in range(120):
        a = [source.randrange(9) for _ in range(source.randrange(45))]
        b = edited(source, [str(x) for x in a] or ["0"], source.randrange(9))
        codes = {w: i for i, w in enumerate(sorted({*b, *map(str, a)}))}
        pairs.append(([codes[str(x)] for x in a], [codes[w] for w in b]))
    arrays = [(np.array(a, np.uint64), np.array(b, np.uint64)) for a, b in pairs]
    true = [edit_distance(a, b) for a, b in pairs]
    for width in (1, 4, 30):
        assert order_minhash.band_distances(arrays, width).tolist() == [
            min(d, width + 1) for d in true]
    assert order_minhash.alike(arrays).tolist() == [
        d <= int(0.2 * max(len(a), len(b)) + 1e-9) for d, (a, b) in zip(true, pairs)]


def test_repeated_kmers_have_labels():
    words, at = order_minhash.word_hashes(pa.array(["a b c d e " * 3, "a b c d e", ""]))
    kmers, starts = order_minhash.labelled_kmers(words, at)
    assert starts.tolist() == [0, 11, 12, 12]
    assert len(set(kmers[:11].tolist())) == 11 and kmers[11] == kmers[0]


def test_sketches_keep_the_order_of_the_text():
    source = random.Random(5)
    half, other = ([source.choice(WORDS) for _ in range(40)] for _ in range(2))
    texts = pa.array([" ".join(half + other), " ".join(other + half)])
    keys, _ = order_minhash.order_minhash(*order_minhash.labelled_kmers(
        *order_minhash.word_hashes(texts)))
    # Nearly the same k-mers, but only sketches inside one half agree.
    assert (keys[0] == keys[1]).mean() < 0.6


def classes(found):
    return {r["doc_id"]: r["class_id"] for r in found}


def brute_classes(docs):
    words = {}
    for doc_id, text in docs:
        hashes, _ = order_minhash.word_hashes(pa.array([text or ""], pa.string()))
        words.setdefault(doc_id, hashes)
    root = {i: i for i in words}
    pairs = list(itertools.combinations(sorted(words), 2))
    alike = order_minhash.alike([(words[a], words[b]) for a, b in pairs])
    linked = [p for p, ok in zip(pairs, alike) if ok]
    for _ in words:
        for a, b in linked:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_near_duplicates_equal_brute_force(spark, make_docs):
    source = random.Random(8)
    docs, passage = [], [source.choice(WORDS) for _ in range(60)]
    for original in range(14):
        base = [source.choice(WORDS) for _ in range(source.randrange(60, 300))]
        if original % 2:
            base[10:10] = passage  # shared by strangers
        docs.append(" ".join(base))
        docs += [" ".join(edited(source, base, len(base) // 40)) for _ in range(3)]
        docs.append(" ".join(base).upper().replace(" ", ",  "))
    order = list(range(len(docs)))
    source.shuffle(order)
    rows = [(i, docs[at]) for i, at in enumerate(order)]
    found = order_minhash.near_duplicates(make_docs(*rows).withColumn("n", F.lit(1)).withColumn(
        "key", F.lit(2)).withColumn("class", F.lit(3))).collect()
    assert classes(found) == brute_classes(rows)
    assert len(set(classes(found).values())) == 14 and len(found) == len(docs)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in found)


def test_a_stranger_at_the_head_of_a_bucket_splits_no_class(make_docs):
    """The smallest id shares most of its text, but not enough, with a group of copies."""
    source = random.Random(3)
    passage = [source.choice(WORDS) for _ in range(150)]
    head = passage + [source.choice(WORDS) for _ in range(70)]
    base = passage + [source.choice(WORDS) for _ in range(70)]
    rows = [(0, " ".join(head))] + [
        (i, " ".join(edited(source, base, 3))) for i in range(1, 25)]
    found = classes(order_minhash.near_duplicates(make_docs(*rows)).collect())
    assert found == brute_classes(rows) == {0: 0} | {i: 1 for i in range(1, 25)}


def changed(source, words, share, at=None):
    """`words` with a share of them, at scattered places, replaced by new ones."""
    words = list(words)
    for i in at or source.sample(range(len(words)), int(share * len(words) + 1e-9)):
        words[i] = f"new{source.randrange(10 ** 9)}"
    return words


@pytest.mark.parametrize("n_words, share", [
    (30, 0.1), (30, 0.2), (100, 0.1), (100, 0.15), (100, 0.2), (300, 0.2)])
def test_scattered_changes_within_the_limit_are_found(make_docs, n_words, share):
    source = random.Random(n_words)
    rows = []
    for i in range(100):
        base = [f"w{source.randrange(4000)}" for _ in range(n_words)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(changed(source, base, share)))]
    found = classes(order_minhash.near_duplicates(make_docs(*rows)).collect())
    assert all(found[i] in (i, i - 1) for i in found)
    linked = sum(found[2 * i + 1] == 2 * i for i in range(100))
    assert linked >= 95


def test_all_pairs_of_tiny_texts_are_found(make_docs):
    source, rows = random.Random(4), []
    for n in range(4, 15):
        base = [f"w{n}x{i}" for i in range(n)]
        most = (n + 1) // 5  # the longer one of a pair may have a word more
        more = base[:n // 2] + ["more"] + base[n // 2:]
        texts = [base, changed(source, base, 0, [n // 2])] + [more] * (most > 0)
        if n >= 10:
            texts.append(changed(source, base, 0, [n // 3, 2 * n // 3]))
        rows += [(len(rows) + i, " ".join(words)) for i, words in enumerate(texts)]
    assert classes(order_minhash.near_duplicates(make_docs(*rows)).collect()) == brute_classes(rows)


def test_pairs_among_strangers_who_share_a_passage_are_linked(make_docs):
    source = random.Random(6)
    passage = [f"p{source.randrange(4000)}" for _ in range(112)]
    rows = []
    for i in range(60):
        base = passage + [f"w{source.randrange(4000)}" for _ in range(38)]
        rows += [(j, " ".join(changed(source, base, share)))
                 for j, share in ((i, 0), (60 + i, 0.15))]
    found = classes(order_minhash.near_duplicates(make_docs(*rows)).collect())
    assert found == brute_classes(rows)
    assert all(found[60 + i] == found[i] for i in range(60))


def strangers(source, n, shared, own):
    passage = [f"p{source.randrange(4000)}" for _ in range(shared)]
    return [passage + [f"w{source.randrange(4000)}" for _ in range(own)] for _ in range(n)]


def test_pairs_of_strangers_grow_with_their_number(make_docs, monkeypatch):
    """Texts that share 70 of 110 words, no two alike: few pairs of them are aligned."""
    tested = []
    own = order_minhash.verified

    def counting(pairs, *rest):
        tested.append(pairs.count())
        return own(pairs, *rest)
    monkeypatch.setattr(order_minhash, "verified", counting)
    counts = []
    for n in (200, 800):
        rows = [(i, " ".join(words)) for i, words in enumerate(strangers(random.Random(n), n, 70, 40))]
        found = classes(order_minhash.near_duplicates(make_docs(*rows)).collect())
        assert all(found[i] == i for i in found)
        counts.append(sum(tested))
        tested.clear()
    assert counts[1] < 4 * counts[0] < 4 * 200 * order_minhash.CROWD


@pytest.mark.parametrize("share", [0.05, 0.1, 0.15, 0.19])
def test_pairs_in_crowded_buckets_are_found(make_docs, share):
    """Every second of 120 texts that share a third of their words has a copy with changes."""
    source = random.Random(int(100 * share))
    rows = []
    for i, words in enumerate(strangers(source, 120, 40, 80)):
        rows.append((2 * i, " ".join(words)))
        if i % 2:
            rows.append((2 * i + 1, " ".join(changed(source, words, share))))
    found = classes(order_minhash.near_duplicates(make_docs(*rows)).collect())
    assert all(found[i] in (i, i - 1) for i in found)
    copies = [i for i, _ in rows if i % 2]
    assert sum(found[i] == i - 1 for i in copies) >= 0.9 * len(copies)


@pytest.mark.parametrize("n, copies", [(150, 50), (300, 20)])
def test_links_beside_a_shared_passage_are_all_found(make_docs, n, copies):
    """Strangers share 78 of 100 words; a copy keeps the passage and six words more of its text."""
    source = random.Random(n)
    words = strangers(source, n, 78, 22)
    rows = [(i, " ".join(text)) for i, text in enumerate(words)]
    rows += [(n + i, " ".join(changed(source, words[i], 0, source.sample(range(78, 100), 16))))
             for i in range(copies)]
    found = classes(order_minhash.near_duplicates(make_docs(*rows)).collect())
    assert found == brute_classes(rows)
    assert all(found[n + i] == found[i] for i in range(copies))


def test_members_alike_to_no_representative_are_linked(make_docs):
    """Chains of copies whose ends are alike to a stranger's chain, in one large bucket."""
    source = random.Random(12)
    passage = [f"p{i}" for i in range(78)]
    rows = []
    for group in range(20):
        # Neighbours of a chain differ in 8 words, its ends in all 22.
        chain = [[f"g{group}x{i}" for i in range(22)]]
        for at in (range(8), range(8, 16), range(16, 22)):
            chain.append(changed(source, chain[-1], 0, list(at)))
        rows += [(len(rows) + i, " ".join(passage + words)) for i, words in enumerate(chain)]
        if group % 2:  # the end of this chain and that of the one before meet
            bridge = chain[-1][:11] + last[11:]
            rows.append((len(rows), " ".join(passage + bridge)))
        last = chain[-1]
    found = classes(order_minhash.near_duplicates(make_docs(*rows)).collect())
    assert found == brute_classes(rows)


def test_cheap_segments_by_brute_force():
    source = random.Random(9)

    def least(costs, n, need):
        best = [[0] + [float("inf")] * need for _ in range(n + 1)]
        for end, j in itertools.product(range(1, n + 1), range(1, need + 1)):
            best[end][j] = min([best[end - 1][j]] + [
                best[end - k][j - 1] + costs[which][end - k]
                for which, k in enumerate(order_minhash.LENGTHS) if k <= end])
        return best[n][need]
    for _ in range(100):
        n = source.randrange(1, 50)
        need = source.choice([n // 5 + 1, n])
        costs = [[source.choice([0, 1, 3, 20, 500]) for _ in range(max(0, n - k + 1))]
                 for k in order_minhash.LENGTHS]
        found = order_minhash.cheap_segments(costs, need)
        taken = [i for _, which, first in found for i in range(first, first + order_minhash.LENGTHS[which])]
        assert len(found) >= need and len(set(taken)) == len(taken) and set(taken) <= set(range(n))
        assert all(cost == costs[which][first] for cost, which, first in found)
        total, best = sum(cost for cost, _, _ in found), least(costs, n, need)
        assert best <= total <= 8 * best + 2 * len(found)


def test_segments_of_the_longer_text_stand_in_an_alike_one():
    source, tested = random.Random(10), 0
    for _ in range(300):
        a = [source.choice(WORDS) for _ in range(source.randrange(1, 60))]
        b = edited(source, a, source.randrange(1 + len(a) // 5)) or a
        longer, shorter = sorted((np.array([WORDS.index(w) for w in words], np.uint64)
                                  for words in (a, b)), key=lambda w: -len(w))
        if not order_minhash.alike([(longer, shorter)])[0]:
            continue
        tested += 1
        hashes = order_minhash.segment_hashes(longer)
        costs = [[source.randrange(9) for _ in some] for some in hashes]
        limit = order_minhash.limit_of(len(longer), 0.8)
        chosen = order_minhash.cheap_segments(costs, limit + 1)
        others = [x.tolist() for x in order_minhash.segment_hashes(shorter)]
        met = sum(any(x == hashes[which][first] and abs(at - first)
                      + abs(len(longer) - first - len(shorter) + at) <= limit
                      for at, x in enumerate(others[which])) for _, which, first in chosen)
        assert met >= len(chosen) - limit > 0
    assert tested > 200


def brute_union(texts, classes, pairs):
    """The classes that alike pairs of them connect, by their smallest member."""
    joined = {c: c for c in classes}
    linked = [p for p, ok in zip(pairs, order_minhash.alike([(texts[i], texts[j]) for i, j in pairs])) if ok]
    for _ in joined:
        for i, j in linked:
            joined[classes[i]] = joined[classes[j]] = min(joined[classes[i]], joined[classes[j]])
    return joined


@pytest.mark.parametrize("two_blocks", [False, True])
def test_links_of_blocks_unite_what_brute_force_does(two_blocks):
    source = random.Random(11 + two_blocks)
    for n_words in (9, 30, 60):
        texts = []
        for base in strangers(source, 8, n_words // 2, n_words // 2):
            texts += [base] + [changed(source, base, source.choice([0.05, 0.12, 0.2, 0.25])) for _ in range(6)]
            texts += [source.sample(base, len(base)) for _ in range(6)]  # other orders
        source.shuffle(texts)
        texts = [order_minhash.word_hashes(pa.array([" ".join(words)]))[0] for words in texts]
        number = [source.randrange(60) for _ in texts]
        first = np.array([source.random() < 0.5 for _ in texts]) if two_blocks else None
        pairs = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2)
                 if first is None or first[i] != first[j]]
        links = order_minhash.uniting_links(texts, np.array(number), first, 0.8)
        assert len(links) < len(set(number)) and all(tuple(sorted(link)) in set(pairs) for link in links)
        assert brute_union(texts, number, links) == brute_union(texts, number, pairs)


@pytest.mark.parametrize("block", [8, 1024])
def test_crowded_copies_equal_brute_force_in_blocks_of_any_size(make_docs, monkeypatch, block):
    """Copies of one text, few of which are alike, all in the same buckets."""
    monkeypatch.setattr(order_minhash, "BLOCK", block)
    source = random.Random(14)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(edited(source, base, source.randrange(4, 12)) + ["more"] * source.randrange(9)))
            for i in range(90)]
    found = classes(order_minhash.near_duplicates(make_docs(*rows)).collect())
    assert found == brute_classes(rows) and len(set(found.values())) > 1


def test_no_table_of_the_exact_step_holds_pairs(make_docs, monkeypatch):
    """400 copies of a text, most of them a little too far from each other: few rows for each."""
    written = []
    own = order_minhash.stored

    def counting(rows, label):
        found = own(rows, label)
        if label == "omh-rest" or written:
            written.append(found.count())
        return found
    monkeypatch.setattr(order_minhash, "stored", counting)
    source = random.Random(400)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(changed(source, base, 0.15))) for i in range(400)]
    order_minhash.near_duplicates(make_docs(*rows)).collect()
    assert 400 <= max(written) < 2 * order_minhash.FAMILY[1] * 400


def test_links_of_later_steps_are_between_classes(make_docs, monkeypatch):
    """A crowded bucket takes all three steps; only the first goes through the documents that are linked."""
    from tidemark.llm import components
    written = []
    own = components.stored

    def counting(rows, label):
        found = own(rows, label)
        written.append((found.columns, found.count()))
        return found
    monkeypatch.setattr(components, "stored", counting)
    source = random.Random(400)
    texts = [[f"w{group}.{i}" for i in range(100)] for group in range(8)]
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(passage + changed(source, texts[i % 8], 0.12))) for i in range(400)]
    order_minhash.near_duplicates(make_docs(*rows)).collect()
    assert len(written) <= 20
    minima = [n for columns, n in written if columns == ["u", "m", "open"]]
    assert max(minima) >= 200
    assert sum(n < 100 for n in minima) >= 2


def test_a_repeated_id_stands_with_one_of_its_texts(make_docs):
    """The text of the smallest hash speaks for an id; the other one links nothing."""
    source = random.Random(1)
    one, two = [[f"w{source.randrange(4000)}" for _ in range(60)] for _ in range(2)]
    first = min((one, two), key=lambda w: order_minhash.body_of(
        order_minhash.word_hashes(pa.array([" ".join(w)]))[0]))
    other = two if first is one else one
    rows = [(1, " ".join(one)), (1, " ".join(two)), (2, " ".join(changed(source, first, 0.05))),
            (3, " ".join(changed(source, other, 0.05)))]
    found = classes(order_minhash.near_duplicates(make_docs(*rows)).collect())
    assert found == {1: 1, 2: 1, 3: 3}


def test_awkward_documents_have_classes(awkward, make_docs):
    found = classes(order_minhash.near_duplicates(awkward).collect())
    assert found == {i: {2: 1, 3: 1, 12: 1}.get(i, i) for i in range(1, 13)}
    assert order_minhash.near_duplicates(make_docs()).collect() == []


# -------------------------------------------------------------------- scores


def test_folds(spark):
    import zlib
    rows = spark.range(50).select("id", fold(F.col("id"), 4).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 4 for r in rows)


@pytest.mark.parametrize("given,kept", [("64m", "8000000"), ("67108864b", "8000000"),
                                        ("2m", "2m"), ("4000", "4000")])
def test_batches_are_bounded(spark, given, kept):
    before = spark.conf.get(BATCH_BYTES)
    try:
        spark.conf.set(BATCH_BYTES, given)
        bounded_batches(spark)
        found = spark.conf.get(BATCH_BYTES)
        assert found.rstrip("b") == kept
    finally:
        spark.conf.set(BATCH_BYTES, before)


def test_samples_do_not_depend_on_the_layout(spark):
    ids = spark.range(1000)
    some = [sorted(r[0] for r in bounded_sample(ids.repartition(n), F.col("id"), 30).collect())
            for n in (1, 7)]
    assert some[0] == some[1] and len(some[0]) == 30


def accuracy(spark, scored, label, folds, held_out):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = (scored.join(labels, "doc_id").where(fold(F.col("doc_id"), folds) == held_out)
            .select("score", label).collect())
    return np.mean([(r["score"] >= 0.7) == (r[label] == 1) for r in rows]), len(rows)


@pytest.fixture(scope="module")
def larger(spark):
    return (spark.read.parquet("/root/testdata/sf0.01/documents.parquet"),
            spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))


def test_quality_of_held_out_documents(spark, larger):
    docs, labels = larger
    ranking = bradley_terry.learn(docs, labels)
    right, n = accuracy(spark, bradley_terry.score(docs, ranking), "quality", 4, 2)
    assert n > 80 and right >= 0.97


def test_toxicity_of_held_out_documents(spark, larger):
    docs, labels = larger
    lexicon = toxicity.learn(docs, labels)
    right, n = accuracy(spark, toxicity.score(docs, lexicon, keep=["doc_id"]), "toxic", 3, 1)
    assert n > 100 and right >= 0.95


def test_preferences_order_the_features():
    draw = np.random.default_rng(0)
    rows = draw.normal(size=(400, len(bradley_terry.FEATURES)))
    labels = (rows[:, 2] - rows[:, 3] > -0.8).astype(int)
    ranking = bradley_terry.fit(rows, labels)
    assert ranking.weights[2] > 0 > ranking.weights[3]
    scores = ranking.scores(rows)
    # The threshold rejects the share of bad rows, whichever rows these are.
    assert (scores < bradley_terry.CUT).sum() == (labels == 0).sum()
    assert ((scores >= 0) & (scores <= 1)).all()


@pytest.mark.parametrize("module", [bradley_terry, toxicity])
def test_scores_of_awkward_documents(awkward, make_docs, spark, module):
    no_labels = spark.createDataFrame([(1, None, None), (None, 1, 1)],
                                      "doc_id bigint, quality int, toxic int")
    model = module.learn(awkward, no_labels)
    more = awkward.withColumn("score", F.lit("clash")).withColumn("x", F.array(F.lit(1.5)))
    scored = module.score(more, model)
    assert scored.columns == [*[c for c in more.columns if c != "score"], "score"]
    rows = scored.collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert sorted(str(r["text"]) for r in rows) == sorted(
        str(r["text"]) for r in awkward.collect())
    if module is bradley_terry:  # nothing learned: nothing rejected
        assert {r["score"] for r in rows} == {bradley_terry.CUT}
    assert module.score(make_docs(), model).collect() == []


def measured(text, entries=None, exceptions=toxicity.EXCEPTIONS):
    lexicon = toxicity.Lexicon(entries or {" idiot": 2.0, " trash": 1.0}, exceptions)
    return toxicity.measures(text, lexicon.automaton())


def test_folding_and_matches():
    assert toxicity.folded("Ｉd1ot, іdіоts​!") == " idiot  idiots  "
    for text in ("you IDIOT", "1d10t", "іdiоt###", "i­diot", "idıots"):
        assert measured(text)[1:] == (1, 2.0)
    assert measured("videotrash ridiots")[1] == 0  # beginnings of words only


def test_exception_phrases_do_not_count():
    assert measured("the trash can and trash")[1:] == (1, 1.0)
    assert measured("a trash can")[1:] == (0, 0)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["trash", "can", "idiot", "idiots", "of", "x", "trashcan"]), max_size=30))
def test_matches_equal_plain_search(words):
    entries = {" idiot": 2.0, " idiots ": 3.0, " trash": 1.0, " x ": 0.5, " can": 0.25}
    exceptions = ("trash can", "can of x", "idiot of")
    text = " ".join(words)
    line = toxicity.folded(text)
    excepted = [(m, m + len(phrase) + 1) for phrase in exceptions
                for m in range(len(line)) if line.startswith(f" {phrase}", m)]
    found = [max(w for e, w in entries.items() if line.startswith(e, at)) for at in range(len(line))
             if any(line.startswith(e, at) for e in entries)
             and not any(a <= at < b - 1 for a, b in excepted)]
    assert measured(text, entries, exceptions) == (len(words), len(found), sum(found))


def test_many_exceptions_take_linear_time():
    text = "trash can idiot " * 40_000
    assert measured(text)[1] == 40_000


def test_length_normalises():
    lexicon = toxicity.Lexicon(toxicity.first_entries())
    auto = lexicon.automaton()
    short, long = ("you idiot " + "word " * n for n in (5, 2000))
    scores = toxicity.sigmoid(toxicity.curve_inputs(
        [toxicity.measures(t, auto) for t in (short, long, "")]) @ np.array(lexicon.curve))
    assert scores[0] > scores[1] > scores[2]


def test_lexicon_learns_stems_and_prefers_the_longest():
    rows = [{"entry": e, "toxic": t, "other": o, "ratio": 9.0} for e, t, o in (
        (" sc", 9, 0), (" scu", 9, 0), (" scum", 9, 0), (" scum ", 9, 0), (" s", 12, 3))]
    assert set(toxicity.most_specific(rows)) == {" scum", " s"}


def test_learned_lexicon(spark, make_docs):
    source = random.Random(1)
    rows = [(i, " ".join(source.choices(WORDS, k=30) + (
        [f"grob{source.choice(['an', 'ox', 'ul'])}"] if i % 5 == 0 else []))) for i in range(200)]
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(200)],
                                   "doc_id bigint, quality int, toxic int")
    lexicon = toxicity.learn(make_docs(*rows), labels)
    assert any(e.startswith(" grob") or " grob".startswith(e) for e in lexicon.entries)
    scored = toxicity.score(make_docs((1, "some grobul here"), (2, "some harmless words")),
                            lexicon).orderBy("doc_id").collect()
    assert scored[0]["score"] > 0.5 > scored[1]["score"]


# -------------------------------------------------------------------- mixing


def mixture(make_docs):
    source = random.Random(6)
    rows = []
    for i in range(300):
        lang = "en" if i % 10 < 7 else "de"
        words = WORDS[:40] if lang == "en" else WORDS[40:80]
        rows.append((i, " ".join(source.choices(words, k=source.randrange(5, 60))), lang))
    return rows, make_docs(*rows)


def test_rates_meet_the_targets(spark, make_docs):
    rows, docs = mixture(make_docs)
    labelled = docs.where("doc_id % 3 = 0").selectExpr("doc_id", "lang AS domain")
    found = soft_mix.soft_mix(docs, labelled, {"en": 1, "de": 3}).collect()
    tokens = {i: len(t.split()) for i, t, _ in rows}
    assert {r["doc_id"]: r["tokens"] for r in found} == tokens
    total = sum(tokens.values())
    for domain, share in (("en", 0.25), ("de", 0.75)):
        expected = sum(r["rate"] * r["tokens"] * r["posteriors"][domain] for r in found)
        assert expected == pytest.approx(share * total, rel=1e-4)
    langs = {i: lang for i, _, lang in rows}
    assert np.mean([max(r["posteriors"], key=r["posteriors"].get) == langs[r["doc_id"]]
                    for r in found]) > 0.97
    assert all(r["rate"] >= 0 and abs(r["copies"] - r["rate"]) <= 1 for r in found)


def test_rates_by_brute_force(spark):
    """Against projected gradient on arrays."""
    draw = np.random.default_rng(3)
    p = draw.dirichlet([0.4] * 3, 80)
    t = draw.integers(0, 50, 80)
    weights = np.array([0.1, 0.2, 0.7])
    members = spark.createDataFrame(
        [(i, int(t[i]), *map(float, p[i])) for i in range(80)],
        "doc_id bigint, tokens bigint, p0 double, p1 double, p2 double")
    rate, reached = soft_mix.fit_rates(members, weights.tolist())
    r, first = np.ones(80), t @ p
    targets = weights * t.sum()
    for _ in range(5000):
        r = np.maximum(0, r - p @ (((r * t) @ p - targets) / first))
    found = np.array([x["rate"] for x in members.select("doc_id", rate.alias("rate"))
                      .orderBy("doc_id").collect()])
    loss = [((((x * t) @ p - targets) ** 2) / first).sum() for x in (found, r, np.ones(80))]
    assert loss[0] <= loss[1] + 1e-3 * loss[2] and (found >= 0).all()
    assert [reached[k][0] for k in range(3)] == pytest.approx(((found * t) @ p).tolist())


def overlapping(spark, spread):
    draw = np.random.default_rng(8)
    first = 0.5 + draw.uniform(-spread, spread, 400)
    return spark.createDataFrame([(i, int(n), float(p), float(1 - p)) for i, (n, p) in enumerate(
        zip(draw.integers(1, 25, 400), first))], "doc_id bigint, tokens bigint, p0 double, p1 double")


def test_overlapping_domains_meet_their_targets(spark):
    """Posteriors within 0.03 of a half; a few rounds lead to the targets."""
    members = overlapping(spark, 0.03)
    rate, totals = soft_mix.fit_rates(members, [0.51, 0.49])
    every = sum(wanted for _, wanted in totals.values())
    for reached, wanted in totals.values():
        assert abs(reached - wanted) <= 1e-6 * every
    assert members.where(rate < 0).isEmpty()


def test_targets_out_of_reach_are_reported(spark, make_docs):
    members = overlapping(spark, 0.03)
    _, totals = soft_mix.fit_rates(members, [0.9, 0.1])
    assert abs(totals[0][0] - totals[0][1]) > 1e-3 * sum(t for _, t in totals.values())
    docs = make_docs(*[(i, "same words in all", "en" if i % 2 else "de") for i in range(40)])
    labelled = docs.selectExpr("doc_id", "lang as domain")
    with pytest.warns(soft_mix.TargetsNotMet, match="en"):
        soft_mix.soft_mix(docs, labelled, {"en": 9, "de": 1}).collect()


def test_mixed_rows_keep_columns_of_any_name(make_docs):
    rows, docs = mixture(make_docs)
    names = ["copies", "mixed_id", "mixed_copies", "mixed_row", "row_id", "copy", "rate", "a.b"]
    clash = docs.withColumns({name: F.lit(i) for i, name in enumerate(names)})
    labelled = docs.where("doc_id % 3 = 0").selectExpr("doc_id", "lang AS domain")
    found = soft_mix.mixed(clash, labelled, {"en": 1, "de": 3})
    assert found.columns == clash.columns and found.schema == clash.schema
    plain = soft_mix.mixed(docs, labelled, {"en": 1, "de": 3})
    assert sorted(r["doc_id"] for r in found.collect()) == sorted(
        r["doc_id"] for r in plain.collect())


def test_mixed_rows_and_awkward_documents(spark, awkward, make_docs):
    rows, docs = mixture(make_docs)
    labelled = docs.selectExpr("doc_id", "lang AS domain")
    mixed = soft_mix.mixed(docs, labelled, {"en": 1, "de": 1})
    assert mixed.columns == docs.columns
    copies = {r["doc_id"]: r["copies"] for r in soft_mix.soft_mix(
        docs, labelled, {"en": 1, "de": 1}).collect()}
    assert {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(
        F.count("*").alias("n")).collect()} == {i: c for i, c in copies.items() if c}
    nobody = awkward.limit(0).selectExpr("doc_id", "lang AS domain")
    found = soft_mix.soft_mix(awkward.withColumn("copies", F.lit(7)), nobody,
                              {"en": 1, "de": 1}).collect()
    assert len(found) == 13 and all(sum(r["posteriors"].values()) == pytest.approx(1)
                                    for r in found)
    assert soft_mix.soft_mix(make_docs(), nobody, {"en": 1}).collect() == []


def test_mixing_runs_no_python(make_docs):
    _, docs = mixture(make_docs)
    plan = soft_mix.mixed(docs, docs.selectExpr("doc_id", "lang AS domain"), {"en": 1, "de": 1})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text


# ------------------------------------------------------------------ licences

FILES = "doc_id bigint, path string, text string"


def scanned(spark, rows, **options):
    found = licenses.scan(spark.createDataFrame(rows, FILES), **options).collect()
    return {(r["doc_id"], r["path"]): (r["license"], r["origin"]) for r in found}


def test_licences_and_inheritance(spark):
    gpl = licenses.TEMPLATES["GPL-3.0"][2]
    rows = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x.py", "code"),
            (3, "a/b/c/y.py", "# SPDX-License-Identifier: Apache-2.0\nimport x"),
            (4, "z/q.py", None), (5, None, None), (6, "a/b/c/COPYING", gpl),
            (7, "a/b/c/d/e.py", "x"), (None, "a/k", "t"), (7, "a/b/c/d/e.py", "x"),
            (8, "ab/x", "not below a"), (9, "z/deep/notes.txt", "We need a license to fish here."),
            (10, "z/long", "word " * 5000 + "\nLicensed under CC BY-NC 4.0.\n" + "w " * 5000),
            (11, "z/two", "Text first. Licensed under CC BY 4.0. Text after that.")]
    mit, inherited = ("MIT", "inherited"), ("GPL-3.0", "inherited")
    assert scanned(spark, rows) == {
        (1, "a/LICENSE"): ("MIT", "own"), (2, "a/b/x.py"): mit,
        (3, "a/b/c/y.py"): ("Apache-2.0", "own"), (4, "z/q.py"): (None, None),
        (5, ""): (None, None), (6, "a/b/c/COPYING"): ("GPL-3.0", "own"),
        (7, "a/b/c/d/e.py"): inherited, (None, "a/k"): mit, (8, "ab/x"): (None, None),
        (9, "z/deep/notes.txt"): (None, None), (10, "z/long"): ("CC-BY-NC-4.0", "own"),
        (11, "z/two"): ("CC-BY-4.0", "own")}
    assert scanned(spark, []) == {}


def test_licence_at_the_root_and_other_templates(spark):
    rows = [(1, "LICENSE.txt", "House licence number nine."), (2, "x", "a"), (3, "d/e/f", "b")]
    found = scanned(spark, rows, templates={"House": ("House licence number nine.",)})
    assert found == {(1, "LICENSE.txt"): ("House", "own"), (2, "x"): ("House", "inherited"),
                     (3, "d/e/f"): ("House", "inherited")}


def test_cosine_by_hand():
    import math
    t = licenses.Templates({"A": ("alpha beta",), "B": ("alpha gamma gamma",)}, {"alpha": 3}, 7)
    common, rare = math.log(8 / 4) + 1, math.log(8) + 1
    score, name = t.nearest("gamma alpha delta")
    length = math.sqrt(common ** 2 + 4 * rare ** 2) * math.sqrt(common ** 2 + 2 * rare ** 2)
    assert name == "B" and score == pytest.approx((common ** 2 + 2 * rare ** 2) / length)
    assert t.nearest("nothing of it") == (0.0, None)


def test_every_notice_of_the_documents_is_found(spark, documents, texts):
    notice = {texts_[0]: name for name, texts_ in licenses.TEMPLATES.items()}
    files = documents.selectExpr("doc_id", "concat(source, '/', doc_id) AS path", "text")
    for r in licenses.scan(files).collect():
        expected = {notice[line] for line in texts[r["doc_id"]].split("\n") if line in notice}
        assert ({r["license"]} if r["license"] else set()) == expected


@pytest.mark.parametrize("n", [100, 3000])
def test_ordinary_words_of_a_notice_weigh_what_they_weigh_in_the_corpus(spark, n):
    """Words in four fifths of all files change a notice's score little, at any number of files."""
    notice = "This article is licensed under the MIT License."
    rows = [(i, f"d/{i}", f"this article is about thing{i}" if i % 5 else f"stone{i}")
            for i in range(2, n)] + [(0, "d/a", notice), (1, "d/b", notice + " Thing2 stone5.")]
    found = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, FILES)).collect()}
    assert (found[0]["license"], found[1]["license"]) == ("MIT", "MIT")
    assert {r["license"] for i, r in found.items() if i > 1} == {None}
    df = {t: 2 for t in licenses.terms("licensed under the mit license")}
    df |= {t: sum(i % 5 > 0 for i in range(2, n)) + 2 for t in ("this", "article", "is")}
    score, _ = licenses.Templates(licenses.TEMPLATES, df, n).nearest(notice)
    assert found[0]["score"] == pytest.approx(score)


LGPL_21 = (
    "This library is free software; you can redistribute it and/or\nmodify it under the terms of the "
    "GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion "
    "2.1 of the License, or (at your option) any later version.")
BSD_2 = (
    "Redistribution and use in source and binary forms, with or without\nmodification, are permitted "
    "provided that the following conditions are met:\n\n1. Redistributions of source code must retain "
    "the above copyright notice.\n\n2. Redistributions in binary form must reproduce the above "
    "copyright notice.\n")
BSD_3 = BSD_2 + "\n3. Neither the name of the copyright holder may be used to endorse products.\n"


@pytest.mark.parametrize("text, license", [
    (LGPL_21, "LGPL-2.1"), (BSD_2, "BSD-2-Clause"), (BSD_3, "BSD-3-Clause"),
    ("# SPDX-License-Identifier: BSD-2-Clause", "BSD-2-Clause"),
    ("# SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
    ("Licensed under CC BY 3.0.", "CC-BY-3.0"), ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
    ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"),
    ("Licensed under CC BY-ND 2.5.", "CC-BY-ND-2.5"), ("Licensed under CC BY 9.0.", None),
    ("Licensed under a Creative Commons Attribution-NonCommercial 3.0 Unported License.",
     "CC-BY-NC-3.0"),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("This work is licensed under the GNU General Public License, version 1.", None),
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("Licensed under the Apache License, Version 1.1.", None),
    ("Released under the MIT License.", "MIT")])
def test_variant_and_version_agree(spark, text, license):
    rows = [(1, "a/x.txt", text)] + [(i, f"b/{i}", f"other words {i} here") for i in range(2, 12)]
    assert scanned(spark, rows)[1, "a/x.txt"][0] == license


def test_own_licences_by_brute_force(spark):
    """Every notice of a whole table against every template, with the weights of all its terms."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    files = documents.selectExpr("doc_id", "concat_ws('/', source, lang, doc_id) as path", "text")
    texts = {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}
    df = Counter(t for text in texts.values() for t in set(licenses.terms(text)))
    known = licenses.Templates(licenses.TEMPLATES, df, len(texts))
    windows = licenses.Windows(licenses.TEMPLATES)
    wanted = {}
    for doc_id, text in texts.items():
        for notice in licenses.notices(text) + windows.of(text):
            vector = known.weighted(Counter(licenses.terms(notice)))
            scores = [(sum(w * vector.get(t, 0.0) for t, w in own.items())
                       / length / licenses.norm(vector), name)
                      for (name, own, length), template in zip(known.vectors, known.texts)
                      if licenses.agree(notice, text, template, name)]
            best = max(scores, default=(0, None))
            if best[0] >= licenses.THRESHOLD and best[0] > wanted.get(doc_id, (0, None))[0]:
                wanted[doc_id] = best
    found = {r["doc_id"]: (r["score"], r["license"]) for r in licenses.scan(files).collect()
             if r["license"]}
    assert set(found) == set(wanted) and len(found) > 10
    for doc_id, (score, name) in found.items():
        assert score == pytest.approx(wanted[doc_id][0]) and name == wanted[doc_id][1]


def test_wrapped_texts_and_headers_have_their_licence(spark):
    import textwrap

    def wrapped(licence, number, prefix="", width=60):
        return textwrap.fill(licenses.TEMPLATES[licence][number], width, initial_indent=prefix,
                             subsequent_indent=prefix)
    body = wrapped("MIT", -1).replace("MIT License ", "MIT License\n\nCopyright (c) 2020 Some One\n\n")
    gpl = licenses.TEMPLATES["GPL-3.0"][2]
    headers = {
        "GPL-2.0": gpl.replace("software:", "software;").replace("version 3", "version 2"),
        "GPL-3.0": gpl, "LGPL-3.0": gpl.replace("GNU General", "GNU Lesser General"),
        "AGPL-3.0": gpl.replace("GNU General", "GNU Affero General")}
    rows = [(0, "m/LICENSE", body), (1, "m/x.py", "import this"),
            (2, "t/short.py", "# This file is released under the\n# MIT License.\nimport this")]
    for i, (name, header) in enumerate(headers.items()):
        block = textwrap.fill(header, 50, initial_indent=" * ", subsequent_indent=" * ")
        rows.append((10 + i, f"h/{name}.c",
                     f"/* A tool of many parts.\n{block}\n * It is slow. */\nint main;"))
    rows += [(100 + i, f"z/{i}", f"this file is a tool of many parts {i} in the end")
             for i in range(200)]
    found = scanned(spark, rows)
    assert found[0, "m/LICENSE"] == ("MIT", "own") and found[1, "m/x.py"] == ("MIT", "inherited")
    assert found[2, "t/short.py"] == ("MIT", "own")
    for i, name in enumerate(headers):
        assert found[10 + i, f"h/{name}.c"] == (name, "own")
    assert all(found[r[0], r[1]] == (None, None) for r in rows if r[0] >= 100)

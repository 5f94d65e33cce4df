"""Collocations against a plain count of all phrases."""

import re
from collections import Counter

import numpy as np

from conftest import plan_of, rows
from tidemark.llm import collocations


def plain_collocations(docs, least, top, within=50):
    f, n = Counter(), Counter()
    for r in docs.select("lang", "text").collect():
        lang = "und" if r["lang"] is None else r["lang"]
        text = re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    found = {}
    for (lang, *words), a in candidates.items():
        if any(o[0] == lang and len(o) > len(words) + 1 and 100 * b >= within * a
               and any(list(o[i:i + len(words)]) == words for i in range(1, len(o)))
               for o, b in candidates.items()):
            continue
        score, k, left, right = min(
            (10 ** 6 * a * a // (f[lang, *words[:k]] * f[lang, *words[k:]]), k,
             f[lang, *words[:k]], f[lang, *words[k:]]) for k in range(1, len(words)))
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, own in found.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:top], 1))


def test_phrases_equal_a_plain_count(documents):
    for least, top in ((10, 2000), (3, 40)):
        found = sorted(tuple(r) for r in collocations.collocations(documents, least, top).collect())
        assert found == plain_collocations(documents, least, top)
        assert found


def test_small_texts_by_hand(make_docs):
    docs = make_docs(*[(i, "Ab c. d AB\tc, É ab") for i in range(4)], (9, "c ab"), (10, None))
    found = {r["phrase"]: (r["rank"], r["a"], r["l"], r["r"], r["n"], r["score"])
             for r in collocations.collocations(docs, least=4).collect()}
    # "ab c" stands in "d ab c" in half of its places, so it goes; so does "d ab".
    assert found == {"d ab c": (1, 4, 4, 9, 30, 444_444), "É ab": (2, 4, 4, 13, 30, 307_692)}, found


def test_odd_rows(awkward, make_docs, spark):
    docs = awkward.union(make_docs(*[(20 + i, "a\x0bb c! a", None) for i in range(9)]))
    clash = docs.withColumns({"w0": docs.doc_id, "f": docs.doc_id, "code": docs.doc_id})
    found = sorted(tuple(r) for r in collocations.collocations(clash, least=2).collect())
    assert found == plain_collocations(docs, 2, 2000)
    assert "und" in {r[0] for r in found}
    assert collocations.collocations(make_docs()).count() == 0


def test_equal_codes_lead_to_another_seed(make_docs, monkeypatch):
    docs = make_docs((1, "a b a b"))
    own = collocations.codes_of

    def clashing(lang, distinct, seed):
        return own(lang, distinct, seed) if seed else np.arange(len(distinct)) * 0 + 7
    monkeypatch.setattr(collocations, "codes_of", clashing)
    words, seed = collocations.coded_vocabulary(docs)
    assert seed == 1 and words.count() == 2


def test_a_set_bit_of_a_rare_word_changes_nothing(documents, monkeypatch):
    wanted = sorted(map(tuple, collocations.collocations(documents).collect()))
    monkeypatch.setattr(collocations, "is_set", lambda bits, codes: np.ones(len(codes), bool))
    assert sorted(map(tuple, collocations.collocations(documents).collect())) == wanted


def test_dealt_and_split_windows_count_alike(documents, monkeypatch):
    wanted = sorted(map(tuple, collocations.collocations(documents).collect()))
    monkeypatch.setattr(collocations, "HELD_ROWS", 1000)
    monkeypatch.setattr(collocations, "COMMON", 10 ** 9)  # every prefix is dealt
    assert sorted(map(tuple, collocations.collocations(documents).collect())) == wanted


def test_equal_rows_merge():
    drawn = np.random.default_rng(2)
    columns = [drawn.integers(-3, 3, 500) for _ in range(3)]
    counts = drawn.integers(1, 9, 500)
    found, sums = collocations.merged(columns, counts)
    wanted = Counter()
    for row, n in zip(zip(*[c.tolist() for c in columns]), counts.tolist()):
        wanted[row] += n
    assert dict(zip(zip(*[c.tolist() for c in found]), sums.tolist())) == wanted


def test_wide_vocabularies_count_alike():
    numbers = np.array([1, 2, 3, 0, 1, 2, 3, 0, 5, 0])
    def as_rows(found):
        return sorted(zip(*[c.tolist() for c in found[0]], found[1].tolist()))
    assert (as_rows(collocations.counted_windows(numbers, 6))
            == as_rows(collocations.counted_windows(numbers, 1 << 40))
            == [(1, 2, 3, 2), (2, 3, 0, 2), (3, 0, 0, 2), (5, 0, 0, 1)])


def test_windows_are_read_once_and_combined_before_the_shuffle(documents):
    words, seed = collocations.coded_vocabulary(documents)
    counts = collocations.phrase_counts(documents, words, seed)
    counts.collect()
    plan = plan_of(counts).partition("== Initial Plan ==")[0]
    assert plan.count("MapInArrow") == 1 and "ReusedExchange" in plan
    assert "rollup" not in plan and "Expand" in plan

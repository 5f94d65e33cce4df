"""Periodic runs: Lyndon arrays and runs against their definitions."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import rows
from tidemark.llm import periodic_runs
from tidemark.llm.queries import op12_baier_runs


def longest_lyndon(text, i):
    """The longest prefix of text[i:] that is below all of its proper suffixes."""
    return max(n for n in range(1, len(text) - i + 1)
               if all(text[i:i + n] < text[i + k:i + n] for k in range(1, n)))


def plain_runs(words, min_length=24, exponent=3):
    """All maximal stretches of each period, without those that have a smaller one."""
    found = []
    for q in range(1, len(words) // exponent + 1):
        same = [words[i] == words[i + q] for i in range(len(words) - q)] + [False]
        start = None
        for i, equal in enumerate(same):
            if equal and start is None:
                start = i
            elif not equal and start is not None:
                length = i - start + q
                part = words[start:start + length]
                if length >= max(min_length, exponent * q) and not any(
                        part[p:] == part[:-p] for p in range(1, q)):
                    found.append((start, length, q))
                start = None
    return sorted(found, key=lambda run: (run[0], run[2]))


few = st.lists(st.integers(0, 3), min_size=1, max_size=16)


@settings(max_examples=200, deadline=None)
@given(few)
def test_groups_hold_the_longest_lyndon_prefixes(text):
    codes = np.unique(text, return_inverse=True)[1].tolist()
    group, width = periodic_runs.lyndon_groups(codes, max(codes) + 1)
    assert [width[g] for g in group] == [longest_lyndon(codes, i) for i in range(len(codes))]
    prefixes = [tuple(codes[i:i + width[g]]) for i, g in enumerate(group)]
    assert len(set(zip(group, prefixes))) == len(set(group)) == len(set(prefixes))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9),
                          st.integers(1, 7)), max_size=5),
       st.sampled_from([(24, 3), (6, 3), (5, 4)]))
def test_runs_equal_those_of_every_period(parts, limits):
    words = [w for unit, times in parts for w in unit * times]
    assert periodic_runs.runs_of_words(words, *limits) == plain_runs(words, *limits)


def test_long_texts_of_one_and_two_words():
    assert periodic_runs.runs_of_words(["a"] * 50_000) == [(0, 50_000, 1)]
    assert periodic_runs.runs_of_words(["a", "b"] * 25_000) == [(0, 50_000, 2)]


def test_words_after_the_first_period_of_a_run_go():
    words = list("xyz" + "ab" * 12 + "q")
    runs = periodic_runs.runs_of_words(words)
    assert runs == [(3, 24, 2)]
    assert periodic_runs.without_repeats(words, runs) == list("xyzabq")
    overlapping = [(0, 30, 10), (12, 24, 3)]
    assert periodic_runs.without_repeats(list(range(40)), overlapping) == [
        *range(10), *range(36, 40)]


def test_a_tenth_of_the_ids_is_made_periodic():
    words = [str(i) for i in range(100)]
    for doc_id in range(200):
        h = zlib.crc32(str(doc_id).encode())
        g, a = h // 10, h // 10 % 100
        p = 1 + (100 - a) // (3 + g % 8)
        wanted = words if h % 10 else [
            words[i] if i < a else words[a + (i - a) % p] for i in range(100)]
        assert periodic_runs.cycled_by_id(doc_id, words) == wanted


def plain_digest(doc_id, text):
    words = periodic_runs.cycled_by_id(doc_id, (text or "").encode().split())
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    return dict(
        doc_id=doc_id, n_runs=len(runs), start=best and best[0], length=best and best[1],
        period=best and best[2], exponent_milli=best and 1000 * best[1] // best[2],
        runs_sha256=hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        collapsed_sha256=hashlib.sha256(b" ".join(
            w for i, w in enumerate(words) if i not in gone)).hexdigest())


def test_query_equals_the_definition_on_small_texts(spark, make_docs, monkeypatch):
    drawn = random.Random(3)
    texts = [" ".join(drawn.choice("abc") for _ in range(drawn.randint(0, 9)))
             + f" {' '.join(drawn.choices('ab', k=drawn.randint(1, 8)))}" * drawn.randint(0, 30)
             for _ in range(150)]
    docs = make_docs(*enumerate(texts), (900, None), (901, ""), (902, "\x0b\x1f \t"))
    found = rows(periodic_runs.digest(periodic_runs.find_runs(
        docs, change=periodic_runs.cycled_by_id)), "doc_id")
    wanted = [plain_digest(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found == sorted(wanted, key=lambda r: str(r["doc_id"]))
    assert sum(r["n_runs"] for r in found) > 100


def test_query_on_the_table(spark, texts):
    found = {r["doc_id"]: r for r in rows(op12_baier_runs(spark, "/root/testdata/sf0.001"))}
    assert set(found) == set(texts)
    for doc_id, text in texts.items():
        if len(text) < 1500:
            assert found[doc_id] == plain_digest(doc_id, text)


def test_odd_rows(awkward, make_docs):
    found = rows(periodic_runs.find_runs(awkward.withColumn("runs", awkward.n_chars)))
    assert len(found) == awkward.count()
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[1]["n_words"] == by_id[2]["n_words"] == by_id[3]["n_words"] == 0
    assert by_id[1]["collapsed"] == "" and by_id[1]["runs"] == []
    assert [tuple(r) for r in by_id[5]["runs"]] == [(0, 30_000, 1)]
    assert by_id[5]["collapsed"] == "word"
    empty = periodic_runs.digest(periodic_runs.find_runs(make_docs()))
    assert empty.count() == 0


def test_exponents_below_three_are_refused(make_docs):
    with pytest.raises(ValueError):
        periodic_runs.find_runs(make_docs(), exponent=2)


def test_nothing_is_shuffled(awkward):
    found = periodic_runs.digest(periodic_runs.find_runs(awkward))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()

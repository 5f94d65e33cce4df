"""Personal data: patterns against plain expressions, messages against enumeration."""

import hashlib
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import rows
from tidemark.llm import skip_chain_pii as pii
from tidemark.llm.queries import op11_skip_chain_pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def checksum(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    """The patterns, each as one expression over the whole text."""
    def count(m):
        return len(re.findall("[0-9]", m[0]))
    found = [("email", m) for m in EMAIL.finditer(text)]
    found += [("ip", m) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", m) for m in CARD.finditer(text)
              if 13 <= count(m) <= 19 and checksum(re.sub("[^0-9]", "", m[0]))]
    found += [("phone", m) for m in PHONE.finditer(text) if 9 <= count(m) <= 15]
    return [(kind, *m.span()) for kind, m in found]


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("a0159@.-_+ ()é\n²"), max_size=60))
def test_patterns_equal_plain_expressions(text):
    assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text)] == plain_spans(text)


@pytest.mark.parametrize("text", [
    "a@b.c_d@e.f", "a@b.c@d.e.f", "x..@a.b-@c.d", "1.2.3.4.5.6.7.8", "256.1.1.1 0007.0.0.1",
    "4111 1111-1111 1111", "4111111111111111 2", "41111111111111112222", "+1 (377) 555-0271.",
    "+1 +22 (0) 123456789-", "+123456789012345678", "é@a.b ü.x@y.z"])
def test_patterns_on_cases(text):
    assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text)] == plain_spans(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "+1" * 100_000, "1." * 100_000, "a@" * 100_000):
        pii.Field(text)


def enumerated(unary, edges, potentials):
    n, k = unary.shape
    totals = np.zeros((n, k))
    for labels in itertools.product(range(k), repeat=n):
        weight = np.exp(sum(unary[i, y] for i, y in enumerate(labels))
                        + sum(p[labels[i], labels[j]] for (i, j), p in zip(edges, potentials)))
        for i, y in enumerate(labels):
            totals[i, y] += weight
    return totals / totals.sum(1, keepdims=True)


def test_messages_are_exact_without_loops_and_near_with_them():
    drawn = np.random.default_rng(5)
    for _ in range(20):
        unary = drawn.normal(size=(6, 3))
        tree = [(int(drawn.integers(0, i)), i) for i in range(1, 6)]
        potentials = drawn.normal(size=(5, 3, 3))
        assert np.allclose(pii.marginals(unary, tree, potentials, rounds=60),
                           enumerated(unary, tree, potentials), atol=1e-6)
        loop = [*tree, (0, 5)]
        potentials = np.concatenate([potentials, drawn.normal(size=(1, 3, 3))]) * 0.3
        assert np.allclose(pii.marginals(unary, loop, potentials, rounds=60),
                           enumerated(unary, loop, potentials), atol=0.05)
    assert np.allclose(pii.marginals(unary, [], np.zeros((0, 3, 3))),
                       enumerated(unary, [], []))


def test_weights_reach_the_top_of_the_pseudo_likelihood():
    masks, sides = [1, 3, 1, 3], [0, 0, 0, 0]
    beside = [[0] * pii.LABELS] * 4
    labels, counts = [0, 1, 1, 0], [90, 70, 10, 30]
    weights = pii.fit(masks, sides, sides, beside, labels, counts)
    score = (pii.bits_of(masks) @ weights["features"] + weights["chain"][0] + weights["chain"][:, 0])
    posterior = np.exp(score - pii.log_sum(score, 1)[:, None])
    assert posterior[0, 0] == pytest.approx(0.9, abs=0.02)
    assert posterior[1, 1] == pytest.approx(0.7, abs=0.02)
    assert (pii.fit([], [], [], [], [], [])["skip"] == [0.0] + [pii.SKIP] * 4).all()


@pytest.fixture(scope="module")
def weights(spark):
    return pii.learn(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def spans_of(text, weights):
    field = pii.Field(text)
    found = pii.mentions(field, pii.posteriors([field], weights)[0])
    return [(pii.KINDS[k], text[a:b]) for k, a, b in found]


def test_labels_reach_distant_tokens(weights):
    filler = "and of the " * 2000
    assert spans_of(f"Call +1 (377) 555-0271 {filler} (377) 555-0271, 4.0.", weights) == [
        ("phone", "(377) 555-0271")]
    assert spans_of(f"maria.lopez@mail.example.com {filler} write maria.lopez, or maria.lopez!",
                    weights) == [("email", "maria.lopez")] * 2
    # Two cards behind each other are one number of 32 digits to the patterns.
    assert spans_of("4111111111111111. 4111111111111111 4111111111111111", weights) == [
        ("card", "4111111111111111 4111111111111111")]


def test_nothing_is_added_without_a_path_to_a_pattern(weights):
    for text in ("(377) 555-0271", "version 4.0. of 2024", "maria.lopez", "9807915762804491 x",
                 "+1 (377) 555-0271 and (911) 444-1234"):
        assert spans_of(text, weights) == []


def test_query_keeps_all_spans_of_the_patterns(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in
             spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    found = rows(op11_skip_chain_pii(spark, sf_dir))
    assert len(found) == len(texts)
    for row in found:
        wanted = plain_spans(texts[row["doc_id"]])
        spans = ",".join(f"{k}:{a}:{b}" for k, a, b in wanted)
        assert row["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
        assert row["spans"].startswith(spans)
        for kind in pii.KINDS:
            assert row[f"n_{kind}"] == sum(k == kind for k, _, _ in wanted)
        for added in row["spans"][len(spans):].split(",")[bool(spans):]:
            if added:
                kind, a, b = added.split(":")
                assert kind.endswith(pii.MENTION) and any(k + pii.MENTION == kind for k, _, _ in wanted)
                assert all(int(b) <= s or e <= int(a) for _, s, e in wanted)
    assert sum(bool(r["spans"]) for r in found) > 20


def test_odd_rows(awkward, make_docs, weights):
    docs = awkward.union(make_docs((30, "x +1 (377) 555-0271 é 1.2.3.4"), (30, None)))
    clash = docs.withColumns({"spans": docs.doc_id, "label": docs.doc_id, "mask": docs.doc_id})
    found = rows(pii.find(clash, weights))
    assert len(found) == docs.count()
    assert [[tuple(s) for s in r["spans"]] for r in found if r["spans"]] == [
        [("ip", 22, 29, True), ("phone", 2, 19, True)]]
    assert pii.find(make_docs(), weights).count() == 0
    nothing = pii.learn(make_docs((1, None), (2, "no marks")))
    assert spans_of("+1 (377) 555-0271 (377)", nothing) == []
    digest = rows(pii.digest(pii.find(make_docs((1, None)), weights)))
    assert digest[0]["base_sha256"] == hashlib.sha256(b"").hexdigest() and digest[0]["spans"] == ""

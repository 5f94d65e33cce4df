"""The corpus pipeline, each stage against a plain version of it on the same input."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm.conftest import DATA
from llm.test_documents import brute_classes
from llm.test_tokens import check_packing, library
from tidemark.llm import bradley_terry, soft_mix, toxicity
from tidemark.llm.queries import QUERIES, TARGETS, labelled_languages
from tidemark.sources.shared_folder import stored


@pytest.fixture(scope="module")
def stages(spark, documents):
    """What goes into each stage, and the last stage's rows."""
    docs, found = documents, [documents]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, DATA), f"test-{name}")
        found.append(docs)
    return found


def held(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_names_and_columns(stages, documents):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "toxicity", "near_dedup", "mixing", "packing"]
    assert all(df.columns == documents.columns for df in stages[:5])
    assert stages[4].count() > 0


def test_quality_rejects_what_the_ranking_rejects(stages, labels):
    ranking = bradley_terry.learn(stages[0], labels)
    kept = {k: n for k, n in held(stages[0]).items()
            if ranking.scores([bradley_terry.features(k[1])])[0] >= 0.7}
    assert held(stages[1]) == kept and 0 < len(kept) < stages[0].count()


def test_toxicity_rejects_what_the_lexicon_rejects(stages, labels):
    lexicon = toxicity.learn(stages[1], labels)
    automaton = lexicon.automaton()

    def score(text):
        return toxicity.sigmoid(toxicity.curve_inputs(
            [toxicity.measures(text, automaton)]) @ list(lexicon.curve))[0]
    kept = {k: n for k, n in held(stages[1]).items() if score(k[1]) < 0.7}
    assert held(stages[2]) == kept and 0 < len(kept) < stages[1].count()


def test_one_document_of_each_class_stays(stages):
    classes = brute_classes([(r["doc_id"], r["text"]) for r in stages[2].collect()])
    assert {d for d, _ in held(stages[3])} == set(classes.values())
    assert set(held(stages[3]).values()) == {1}


def test_documents_are_as_often_as_the_mixture_says(stages, labels):
    labelled = labelled_languages(stages[3], labels)
    copies = soft_mix.soft_mix(stages[3], labelled, TARGETS).collect()
    expected = {r["doc_id"]: r["copies"] for r in copies if r["copies"]}
    assert Counter(r["doc_id"] for r in stages[4].select("doc_id").collect()) == expected


def test_every_id_is_packed_once(stages, tokenizer):
    rows = [(r["doc_id"], r["text"]) for r in stages[4].collect()]
    pieces = stages[5].collect()
    check_packing(pieces, rows, library(tokenizer("word_bpe_49k.json")), 4096)
    assert stages[5].where(F.crc32("ids") != F.col("ids_crc32")).count() == 0


def test_awkward_documents_pass_through(spark, awkward, make_docs, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(5, 0, 0), (6, 1, 1), (None, None, None)],
                          "doc_id bigint, quality int, toxic int").write.parquet(
                              f"{folder}/labels.parquet")
    for docs in (awkward, make_docs()):
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, stored(stage(spark, docs, folder), f"awkward-{name}")
            if name != "packing":
                assert docs.columns == before.columns
                assert set(held(docs)) <= set(held(before))


def test_one_query_for_each_operator():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))

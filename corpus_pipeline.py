"""From raw documents to packed training sequences, stage by stage.

Each stage takes what its predecessor kept, written as Parquet and read again, and uses one
of the operators of `tidemark.llm` on all of it.
"""

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import bradley_terry, order_minhash, packing, soft_mix, toxicity
from tidemark.llm.queries import CUT, TARGETS, WINDOW, labelled_languages, table
from tidemark.sources.shared_folder import stored

#: Training a classifier and aligning texts are no SQL.
ORACLE_SQL = None
SCORE = "corpus_pipeline_score"


def quality_stage(spark, docs, sf_dir):
    """Documents that the quality ranking accepts, with their columns as they are.

    Null and empty texts have a score too; repeated rows are kept or go together; no documents, no
    rows. Columns of any other name pass through.
    """
    ranking = bradley_terry.learn(docs, table(spark, sf_dir, "labels"))
    scored = bradley_terry.score(docs, ranking, SCORE)
    return scored.where(F.col(SCORE) >= CUT).drop(SCORE)


def toxicity_stage(spark, docs, sf_dir):
    """Documents that the lexicon does not call toxic, with their columns as they are.

    Null and empty texts match nothing and stay; repeated rows are kept or go together; no
    documents, no rows. Columns of any other name pass through.
    """
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, lexicon, SCORE)
    return scored.where(F.col(SCORE) < CUT).drop(SCORE)


def near_dedup_stage(spark, docs, sf_dir):
    """One document of each class of near-duplicates, the one with the smallest id; documents
    without id cannot be named in a class and stay.

    Rows of one id are one document, of which one row stays. Documents without words are alike:
    one of them stays. No documents, no rows.
    """
    kept = order_minhash.near_duplicates(docs).where("kept").select("doc_id")
    one_each = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return one_each.union(docs.where("doc_id is null"))


def mixing_stage(spark, docs, sf_dir):
    """Documents as often as the mixture of languages wants them, with their columns as they are.

    Repeated rows of an id share its rate; null and empty texts have no words and the rate of the
    prior; a null id is a document like others. No documents, no rows.
    """
    return soft_mix.mixed(docs, labelled_languages(docs, table(spark, sf_dir, "labels")), TARGETS)


def packing_stage(spark, docs, sf_dir):
    """Pieces of all documents, placed in training sequences, with their ids.

    A null or empty text is its end id alone; repeated rows are packed once each; a null id stays
    null; only `doc_id` and `text` are used. No documents, no rows.
    """
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2,
                          window=WINDOW)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("quality", quality_stage), ("toxicity", toxicity_stage),
          ("near_dedup", near_dedup_stage), ("mixing", mixing_stage), ("packing", packing_stage)]


def run(spark, sf_dir):
    """The last stage's rows; every stage's result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

import public_tokenizers
import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])
LABELS = "doc_id bigint, quality int, toxic int"
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


@pytest.fixture
def make_docs(spark):
    """Documents from (id, text) pairs; a third entry is the language."""
    def build(*rows):
        return spark.createDataFrame(
            [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or "")) for r in rows],
            DOCUMENTS)
    return build


@pytest.fixture
def awkward(make_docs):
    """Nulls, empty and very long texts, repeated rows, odd white space and signs."""
    return make_docs(
        (1, None), (2, ""), (3, "   "), (4, "one"), (4, "one"), (None, "no id at all"),
        (5, "word " * 30_000), (6, "a \n b\t\tc  d "), (7, "x" * 20_000), (8, "\x01 q \x01r"),
        (9, "日本 語 É é ß ﬁ ▁ ▁▁ z"), (10, "It's. we'll, | a|b ||| <|endoftext|> <s>"),
        (11, "Ra.\nThe next, line. \nand\n\nmore\n"), (12, None, None))


@pytest.fixture(scope="session")
def tokenizer():
    return public_tokenizers.path

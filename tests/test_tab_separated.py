"""Tab-separated text: escapes, headers, errors."""

from datetime import datetime
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from tidemark.sources.tab_separated import read_tsv, write_tsv

TEXT = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


def written(tmp_path, *files):
    for i, text in enumerate(files):
        Path(tmp_path, f"{i}.tsv").write_bytes(text.encode())
    return str(tmp_path)


def pairs(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_escapes_are_decoded_and_quotes_are_not(spark, tmp_path):
    path = written(tmp_path, 'a\tb\n"quoted\ta\\tb\nx\\\\y\t\\\\\\\\n\n\\N\t\n\\\\N\tN\\n\\\'\\q\n'
                             'one " two"\t\\\\\\t\n')
    assert pairs(read_tsv(spark, path, TEXT)) == sorted([
        ('"quoted', "a\tb"), ("x\\y", "\\\\n"), (None, ""), ("\\N", "N\n'q"),
        ('one " two"', "\\\t")], key=str)


def test_a_row_like_the_header_stays_and_every_file_has_its_own(spark, tmp_path):
    path = written(tmp_path, "a\tb\na\tb\n1\t2\n", "a\tb\n", "a\tb\n3\t4\na\tb", "")
    assert pairs(read_tsv(spark, path, TEXT)) == [("1", "2"), ("3", "4"), ("a", "b"), ("a", "b")]


def test_files_are_split(spark, tmp_path):
    path = written(tmp_path, "a\tb\n" + "".join(f"{i}\t{'x' * 50}\n" for i in range(4000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = read_tsv(spark, path, TEXT)
        assert rows.rdd.getNumPartitions() > 5
        assert sorted(int(r["a"]) for r in rows.collect()) == list(range(4000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("text, message", [
    ("b\ta\n1\t2\n", "the header is"), ("a\tb\n1\n", "has not 2 fields"),
    ("a\tb\n1\t2\t3\n", "has not 2 fields")])
def test_wrong_files_are_errors(spark, tmp_path, text, message):
    with pytest.raises(PySparkException, match=message):
        read_tsv(spark, written(tmp_path, text), TEXT).collect()


def test_typed_fields(spark, tmp_path):
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("t", T.TimestampType()),
                           T.StructField("x", T.DoubleType()), T.StructField("f", T.BooleanType())])
    rows = [(1, datetime(2024, 1, 2, 3, 4, 5), 0.1, True), (None, None, None, None),
            (-2 ** 63, datetime(1970, 1, 1), -1e300, False)]
    path = str(tmp_path / "typed")
    write_tsv(spark.createDataFrame(rows, schema), path)
    assert pairs(read_tsv(spark, path, schema)) == sorted(rows, key=str)
    bad = written(tmp_path, "n\tt\tx\tf\nno\t\\N\t\\N\t\\N\n")
    with pytest.raises(PySparkException, match="no bigint: no"):
        read_tsv(spark, f"{bad}/0.tsv", schema).collect()


odd = st.one_of(st.none(), st.text(st.sampled_from("ab\\\t\n\r\"'N0nt \0\b\f,#é"), max_size=8))


@settings(max_examples=25, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(odd, odd), min_size=1, max_size=20))
def test_what_is_written_is_read(spark, tmp_path, rows):
    path = str(tmp_path / "odd")
    write_tsv(spark.createDataFrame(rows, TEXT), path)
    assert pairs(read_tsv(spark, path, TEXT)) == sorted(rows, key=str)


def test_one_empty_column_and_odd_names(spark, tmp_path):
    schema = T.StructType([T.StructField("a\tb\\", T.StringType())])
    path = str(tmp_path / "one")
    write_tsv(spark.createDataFrame([("",), ("x",), (None,)], schema), path)
    assert pairs(read_tsv(spark, path, schema)) == sorted([("",), ("x",), (None,)], key=str)

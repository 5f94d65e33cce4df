"""Tab-separated text with a header row, as analytics databases exchange it.

There is no quoting. A backslash escapes: `\\t` tab, `\\n` line feed, `\\r`, `\\b`, `\\f`, `\\0`, `\\\\`
and `\\'`; `\\N` as a whole field is NULL, an empty field the empty text. As line feeds are escaped,
a line is a row, and Spark may split files anywhere between lines.
"""

import sys

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NULL = "\\N"
# The escapes of the format, but for that of the backslash itself.
ESCAPES = {"\t": "t", "\n": "n", "\r": "r", "\b": "b", "\f": "f", "\0": "0"}


def escaped(column):
    text = F.replace(column.cast("string"), F.lit("\\"), F.lit("\\\\"))
    for plain, letter in ESCAPES.items():
        text = F.replace(text, F.lit(plain), F.lit("\\" + letter))
    return text


def unescaped(field):
    """Escaped backslashes part the text; between them a backslash always begins an escape."""
    def decode(part):
        for plain, letter in ESCAPES.items():
            part = F.replace(part, F.lit("\\" + letter), F.lit(plain))
        return F.regexp_replace(part, r"(?s)\\(.)", "$1")

    parts = F.transform(F.split(field, r"\\\\", -1), decode)
    return F.when(F.instr(field, "\\") == 0, field).otherwise(F.array_join(parts, "\\"))


def header_of(names):
    def encode(name):
        name = name.replace("\\", "\\\\")
        for plain, letter in ESCAPES.items():
            name = name.replace(plain, "\\" + letter)
        return name
    return [encode(name) for name in names]


def without_headers(lines, header):
    """The lines (`value`, `file`, `start` of their split) without the first one of every file, which must be
    the header. A task reads the splits of its files one after the other."""
    def rows(batches):
        last = None
        for batch in batches:
            runs = pc.run_end_encode(pc.binary_join_element_wise(
                batch.column(2).cast(pa.string()), batch.column(1), ":"))
            kept = [True] * batch.num_rows
            begins = [0, *runs.run_ends.to_pylist()]
            for split, at in zip(runs.values.to_pylist(), begins):
                if split != last and split.startswith("0:"):
                    found = batch.column(0)[at].as_py()
                    if found != header:
                        raise ValueError(f"{split[2:]}: the header is {found!r}, not {header!r}")
                    kept[at] = False
                last = split
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["value"]).filter(pa.array(kept))

    return lines.mapInArrow(rows, "value string")


def read_tsv(spark, path, schema):
    """The rows of all files under `path`, typed as `schema`, whose names every header must have.

    A row with another number of fields, or a field that is no value of its type, is an error.
    """
    meta = F.col("_metadata")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", meta["file_path"].alias("file"), meta["file_block_start"].alias("start"))
    rows = without_headers(lines, "\t".join(header_of(schema.names)))
    whole = F.split("value", "\t", -1)
    fields = F.when(F.size(whole) == len(schema), whole).otherwise(F.raise_error(F.concat(
        F.lit(f"a row has not {len(schema)} fields: "), "value")))
    parsed = rows.select(fields.alias("fields"))

    def value(i, kind):
        raw = F.col("fields")[i]
        text = unescaped(raw)
        if kind.simpleString() == "string":
            return F.when(raw != NULL, text)
        typed = text.try_cast(kind)
        wrong = F.raise_error(F.concat(F.lit(f"no {kind.simpleString()}: "), raw)).cast(kind)
        return F.when(raw != NULL, F.coalesce(typed, wrong))

    return parsed.select(*[value(i, f.dataType).alias(f.name) for i, f in enumerate(schema)])


def write_tsv(df, path):
    """Write `df`, a header in every file; nested columns have no form here."""
    header = "\t".join(header_of(df.columns))
    fields = [F.coalesce(escaped(F.col(f"`{name}`")), F.lit(NULL)) for name in df.columns]

    def with_header(batches):
        yield pa.RecordBatch.from_arrays([pa.array([header])], ["value"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["value"])

    lines = df.select(F.concat_ws("\t", *fields).alias("value"))
    # A task writes one file: its first line is the first one of the task.
    (lines.mapInArrow(with_header, "value string").write.mode("overwrite")
     .option("lineSep", "\n").option("maxRecordsPerFile", 0).text(path))

"""What several operators need: text columns, Arrow batches, training folds."""

import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

# Executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_BYTES = 4_000_000
UNITS = ["", "k", "m", "g", "t", "p"]
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark):
    """Lower the session's bound on the bytes of an Arrow batch to twice a slice.

    Batches are held several times over, by the executor and its worker; counted in
    rows, as many long texts would not fit.
    """
    number, unit = re.match(r"(\d+)([kmgtp]?)", spark.conf.get(BATCH_BYTES).lower()).groups()
    if int(number) * 1024 ** UNITS.index(unit) > 2 * SLICE_BYTES:
        spark.conf.set(BATCH_BYTES, str(2 * SLICE_BYTES))


def texts_of(docs):
    """(doc_id, text) only, a null text as the empty one."""
    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def slices(batch, column="text", most_bytes=SLICE_BYTES):
    """Parts of an Arrow batch of about `most_bytes` of text each, one row at least."""
    start, held = 0, 0
    sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
    for row, size in enumerate(sizes):
        if row > start and held + (size or 0) > most_bytes:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def fold(doc_id, folds):
    """crc32 of the id as text, modulo `folds`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def bounded_sample(rows, key, most):
    """At most `most` rows, the same ones every time: those with the smallest key hashes.

    A top-k per task and one merge of k rows, so the cost does not depend on
    how many rows are labelled.
    """
    return rows.orderBy(F.xxhash64(key), key).limit(most)

"""Token files: concatenated ids with Elias-Fano coded document boundaries.

The documents are range-partitioned by id, so part k of the files holds smaller ids than
part k + 1. Each task encodes its documents in order and writes blocks of about
`BLOCK_IDS` ids; a block is a row of a Parquet table with

    part, block       place in the order of all blocks
    before            ids of the part before this block
    n_docs, n_ids
    width             bytes of an id, 2 or 4
    ids               the ids, little-endian
    bounds            Elias-Fano code of the documents' ends in the block
    nulls             documents without id; they come first
    first_doc, last_doc  smallest and largest of the other ids
    doc_ids           Elias-Fano code of the other ids less the first

Parquet because Spark's committer then makes each part appear once, whatever tasks were
retried, on any store. An offset among all ids is one number per *part* (their sums, a
table of as many rows as there are partitions), plus `before`, plus a select in the
block: no 64-bit table of documents exists anywhere.
"""

import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.llm.shared import slices, texts_of
from tidemark.llm.tokens import encoder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_IDS = 1_000_000
SAMPLE = 64
BLOCKS = ("part int, block int, before bigint, n_docs bigint, n_ids bigint, width int, "
          "ids binary, bounds binary, nulls bigint, first_doc bigint, last_doc bigint, "
          "doc_ids binary")


class EliasFano:
    """A non-decreasing sequence of n numbers below `universe` in about
    n * (2 + log2(universe / n)) bits.

    The low bits of each number stand packed in a row; the high bits are a unary bit
    vector, number i setting bit (high part + i). Every `SAMPLE`-th set bit's place is
    kept, so `select(i)` scans a short stretch of the vector only.
    """

    def __init__(self, n, low_bits, low, high, samples):
        self.n, self.low_bits = n, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def of(cls, values):
        values = np.asarray(values, np.uint64)
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits((values[:, None] >> shifts & np.uint64(1)).astype(bool), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, bool)
        bits[ones] = True
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"),
                   ones[::SAMPLE].astype(np.uint64))

    def to_bytes(self):
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high)], "<u8").tobytes()
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, raw):
        n, low_bits, n_low, n_high = np.frombuffer(raw, "<u8", 4).tolist()
        low = np.frombuffer(raw, np.uint8, n_low, 32)
        high = np.frombuffer(raw, np.uint8, n_high, 32 + n_low)
        return cls(n, low_bits, low, high, np.frombuffer(raw, "<u8", -1, 32 + n_low + n_high))

    def _low(self, first, count):
        if not self.low_bits:
            return np.zeros(count, np.uint64)
        bit = first * self.low_bits
        last = bit + count * self.low_bits
        bits = np.unpackbits(self.low[bit // 8:-(-last // 8)], bitorder="little")
        bits = bits[bit % 8:bit % 8 + count * self.low_bits].reshape(count, self.low_bits)
        return (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(
            axis=1, dtype=np.uint64)

    def select(self, i):
        """Number i, from its sample on."""
        place, wanted = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, skip, seen = place // 8, place % 8, 0
        while True:
            bits = np.flatnonzero(np.unpackbits(self.high[byte:byte + 32], bitorder="little"))
            bits = bits[bits >= skip]
            if seen + len(bits) > wanted:
                high = byte * 8 + int(bits[wanted - seen]) - i
                return high << self.low_bits | int(self._low(i, 1)[0])
            seen, byte, skip = seen + len(bits), byte + 32, 0

    def find(self, value):
        """The first i with number i >= `value`, by halving; n if there is none."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            if self.select(middle) < value:
                low = middle + 1
            else:
                high = middle
        return low

    def all(self):
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        return (high | self._low(0, self.n)).astype(np.int64)


def block_row(part, block, before, doc_ids, pieces, dtype):
    known = [d for d in doc_ids if d is not None]
    ends = np.cumsum([len(p) for p in pieces])
    first = known[0] if known else None
    gaps = np.array([d - first for d in known], np.uint64)
    return (part, block, before, len(doc_ids), int(ends[-1]), dtype.itemsize,
            np.concatenate(pieces).astype(dtype).tobytes(), EliasFano.of(ends).to_bytes(),
            len(doc_ids) - len(known), first, known[-1] if known else None,
            EliasFano.of(gaps).to_bytes())


def rows_to_batch(rows):
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(),
             pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = [field.split()[0] for field in BLOCKS.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def write_token_files(docs, tokenizer, folder, end_id, keeps_space=True, parts=None):
    """Write the ids of all whole texts, each followed by `end_id`, in ascending doc_id order.

    Documents with a null id come first, repeated ids follow each other; a null or
    empty text is the end id alone; other columns are ignored; no documents make a
    folder without blocks. The only shuffle is the range partitioning of the texts.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def blocks(batches):
        encode = encoder(tokenizer, keeps_space)
        part, block, before = TaskContext.get().partitionId(), 0, 0
        doc_ids, pieces, held = [], [], 0
        for batch in batches:
            for some in slices(batch):
                ids, at = encode.encode(some.column(1))
                for row, doc_id in enumerate(some.column(0).to_pylist()):
                    pieces.append(np.append(ids[at[row]:at[row + 1]], ids.dtype.type(end_id)))
                    doc_ids.append(doc_id)
                    held += len(pieces[-1])
                    if held >= BLOCK_IDS:
                        yield rows_to_batch(
                            [block_row(part, block, before, doc_ids, pieces, encode.dtype)])
                        block, before = block + 1, before + held
                        doc_ids, pieces, held = [], [], 0
        if pieces:
            yield rows_to_batch([block_row(part, block, before, doc_ids, pieces, encode.dtype)])

    ordered = texts_of(docs).repartitionByRange(parts, "doc_id").sortWithinPartitions(
        "doc_id", "text")
    ordered.mapInArrow(blocks, BLOCKS).write.mode("overwrite").parquet(folder)


ROWS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


def with_bases(blocks):
    """Blocks with `base`, the ids of all parts before theirs."""
    parts = blocks.groupBy("part").agg(F.max(F.col("before") + F.col("n_ids")).alias("n"))
    # One row per written partition, a number the writer chose.
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    return blocks.join(F.broadcast(bases), "part")


def read_token_files(spark, folder):
    """One row per document of the files: `doc_id`, `start` (ids of all documents before it),
    `n_tokens`, `ids` (little-endian unsigned 32-bit)."""
    blocks = with_bases(spark.read.schema(BLOCKS).parquet(folder))

    def documents(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ends = EliasFano.from_bytes(row["bounds"]).all()
                starts = np.append(0, ends[:-1])
                ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4")
                raw = ids.tobytes()
                known = EliasFano.from_bytes(row["doc_ids"]).all() + (row["first_doc"] or 0)
                yield pa.RecordBatch.from_arrays([
                    pa.array([None] * row["nulls"] + known.tolist(), pa.int64()),
                    pa.array(starts + (row["base"] + row["before"]), pa.int64()),
                    pa.array(ends - starts, pa.int64()),
                    pa.array([raw[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist())],
                             pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return blocks.mapInArrow(documents, ROWS)


def read_documents(spark, folder, doc_ids):
    """The documents with these ids (a short list), as `read_token_files` gives them.

    Only blocks that may hold one of them are read beyond their bounds; in a block
    a few selects find the document and its offsets, and nothing else is decoded.
    """
    wanted = sorted(set(doc_ids))
    blocks = with_bases(spark.read.schema(BLOCKS).parquet(folder))
    held = F.exists(F.array(*map(F.lit, wanted)).cast("array<bigint>"),
                    lambda x: x.between(F.col("first_doc"), F.col("last_doc")))

    def found(row):
        known, ends = (EliasFano.from_bytes(row[c]) for c in ("doc_ids", "bounds"))
        ids = np.frombuffer(row["ids"], f"<u{row['width']}")
        for doc_id in wanted:
            i = known.find(doc_id - row["first_doc"]) if doc_id >= row["first_doc"] else known.n
            while i < known.n and known.select(i) == doc_id - row["first_doc"]:
                at = row["nulls"] + i
                start, end = ends.select(at - 1) if at else 0, ends.select(at)
                yield (doc_id, row["base"] + row["before"] + start, end - start,
                       ids[start:end].astype("<u4").tobytes())
                i += 1

    def documents(batches):
        for batch in batches:
            for row in batch.to_pylist():
                rows = list(found(row))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(
                            zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                        ["doc_id", "start", "n_tokens", "ids"])

    return blocks.where(held).mapInArrow(documents, ROWS)


def digest(documents):
    """The documents of token files with the crc32 of their ids instead of the ids."""
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

"""Packing of documents into windows by non-negative least squares.

Every task streams over its documents. Documents at least a window long fill whole
windows by themselves; what is left of each document is a piece shorter than a window.
For a buffer of pieces the task counts lengths in `BINS` steps of the window, lists
every combination of up to `MOST_PARTS` steps that fills a window exactly, solves for
the non-negative number of times each combination is used so that the counts match
the histogram, and rounds down. The pieces that rounding leaves over are then packed
greedily: cut to fill the gaps that the steps leave, and last into windows one after
another.

No row leaves its task, so there is no shuffle, no hot key, and a lost executor
costs only its own splits. Memory is one buffer of ids, whatever the input.
"""

import sys
from collections import deque
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import functions as F

from tidemark.llm.shared import slices, texts_of
from tidemark.llm.tokens import encoder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 64
MOST_PARTS = 4
BUFFER_TOKENS = 6_000_000
BUFFER_DOCS = 100_000
EMIT_IDS = 1_000_000
ROUNDS = 400

PIECES = ("doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, sequence_tokens bigint, ids binary")


def combinations(bins, most_parts):
    """Columns of part counts: every way to make `bins` of up to `most_parts` steps of 1..bins."""
    found = []
    for parts in range(1, most_parts + 1):
        for head in combinations_with_replacement(range(1, bins + 1), parts - 1):
            last = bins - sum(head)
            if last >= (head[-1] if head else 1):
                found.append((*head, last))
    matrix = np.zeros((bins, len(found)))
    for column, steps in enumerate(found):
        for step in steps:
            matrix[step - 1, column] += 1
    return matrix


def nnls(matrix, target, rounds=ROUNDS):
    """Non-negative x with least |matrix x - target|, by the active-set method.

    The column with the steepest descent joins the support; if the solution on the
    support has negative entries, walk towards it up to the first zero and drop
    that column. Stops after `rounds` columns, each round no worse than the last.
    """
    n = matrix.shape[1]
    x, held = np.zeros(n), np.zeros(n, bool)
    for _ in range(rounds):
        slope = matrix.T @ (target - matrix @ x)
        slope[held] = 0
        best = int(np.argmax(slope))
        if slope[best] <= 1e-9 * (1 + np.abs(target).sum()):
            break
        held[best] = True
        while held.any():
            trial = np.zeros(n)
            trial[held] = np.linalg.lstsq(matrix[:, held], target, rcond=None)[0]
            if (trial[held] > 1e-12).all():
                x = trial
                break
            sinking = held & (trial <= 1e-12)
            step = np.min(x[sinking] / np.maximum(x[sinking] - trial[sinking], 1e-300))
            x = x + min(1.0, step) * (trial - x)
            held &= x > 1e-12
            x[~held] = 0
    return x


def powers_of_two(tokens):
    """`tokens` as a sum of falling powers of two: sequences that need no padding."""
    return [1 << b for b in range(tokens.bit_length() - 1, -1, -1) if tokens >> b & 1]


def plan(lengths, window, matrix):
    """Sequences of (piece, start in the piece, length) that hold every token of `lengths` once.

    All sequences are full windows; the last tokens make sequences whose lengths are
    powers of two.
    """
    bins = matrix.shape[0]
    lengths = np.asarray(lengths, np.int64)
    step = -(-window // bins)
    of_bin = np.minimum(-(-lengths // step), bins)
    waiting = [deque(np.flatnonzero(of_bin == b + 1).tolist()) for b in range(bins)]
    histogram = np.array([len(w) for w in waiting], float)
    times = np.floor(nnls(matrix, histogram) + 1e-6).astype(int)
    planned = []
    for column in np.flatnonzero(times).tolist():
        steps = np.repeat(np.arange(bins), matrix[:, column].astype(int)).tolist()
        for _ in range(times[column]):
            pieces = [waiting[b].popleft() if waiting[b] else None for b in steps]
            if None in pieces:  # the solution may ask for a little more than there is
                for b, piece in zip(steps, pieces):
                    if piece is not None:
                        waiting[b].appendleft(piece)
                break
            if sum(int(lengths[p]) for p in pieces) > window:
                for b, piece in zip(steps, pieces):
                    waiting[b].appendleft(piece)
                break
            planned.append(pieces)
    rest = deque((p, 0, int(lengths[p])) for b in reversed(waiting) for p in b)
    planned = deque(planned)
    done = []

    def fill(sequence, room):
        while room and rest:
            piece, start, length = rest.popleft()
            taken = min(room, length)
            sequence.append((piece, start, taken))
            if taken < length:
                rest.appendleft((piece, start + taken, length - taken))
            room -= taken
        return room

    while planned:
        pieces = planned.popleft()
        sequence = [(p, 0, int(lengths[p])) for p in pieces]
        room = fill(sequence, window - sum(length for _, _, length in sequence))
        while room and planned:
            rest.extend((p, 0, int(lengths[p])) for p in planned.pop())
            room = fill(sequence, room)
        if room:
            rest.extendleft(reversed(sequence))
        else:
            done.append(sequence)
    left = sum(length for _, _, length in rest)
    for size in [window] * (left // window) + powers_of_two(left % window):
        sequence = []
        fill(sequence, size)
        done.append(sequence)
    return done


class Buffer:
    """Whole documents of one task until they are packed."""

    def __init__(self, window, task, matrix):
        self.window, self.task, self.matrix = window, task, matrix
        self.sequences = 0
        self.clear()

    def clear(self):
        self.docs, self.ids, self.tokens = [], [], 0

    def add(self, doc_id, ids):
        self.docs.append(doc_id)
        self.ids.append(ids)
        self.tokens += len(ids)

    def pack(self):
        """Record batches of placed pieces."""
        window, pieces = self.window, []
        for doc, ids in enumerate(self.ids):
            full = len(ids) // window * window
            for start in range(0, full, window):
                pieces.append([(doc, start, window)])
            if full < len(ids):
                pieces.append((doc, full, len(ids) - full))
        short = [p for p in pieces if isinstance(p, tuple)]
        sequences = [p for p in pieces if isinstance(p, list)]
        for sequence in plan([p[2] for p in short], window, self.matrix) if short else []:
            sequences.append([(short[p][0], short[p][1] + start, n) for p, start, n in sequence])
        rows, held = [], 0
        for sequence in sequences:
            number, offset = self.task << 40 | self.sequences, 0
            self.sequences += 1
            total = sum(n for _, _, n in sequence)
            for doc, start, n in sequence:
                ids = self.ids[doc][start:start + n].astype("<u4").tobytes()
                rows.append((self.docs[doc], start, n, len(self.ids[doc]), number, offset, total, ids))
                offset += n
            held += total
            if held >= EMIT_IDS:
                yield batch_of(rows)
                rows, held = [], 0
        if rows:
            yield batch_of(rows)
        self.clear()


def batch_of(rows):
    names = ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "sequence_tokens")
    columns = list(zip(*rows))
    arrays = [pa.array(c, pa.int64()) for c in columns[:-1]] + [pa.array(columns[-1], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, [*names, "ids"])


def pack(docs, tokenizer, end_id, window=4096, keeps_space=False,
         bins=BINS, most_parts=MOST_PARTS):
    """Pieces of all documents, placed in sequences of at most `window` ids.

    One row per piece: `doc_id`, `start` (ids of its document before it), `length`,
    `doc_tokens` (all ids of its document, `end_id` included), `sequence_id`, `offset` in
    the sequence, `sequence_tokens`, `ids` (little-endian unsigned 32-bit). Each id of
    each document is in exactly one piece. A sequence is a full window, except for the
    last of a buffer, which are powers of two long: nothing is padded.

    A null or empty text is the end id alone; a null `doc_id` stays null; repeated rows
    are packed once each; a very long document fills windows of its own; no rows
    give no rows; other columns are ignored.
    """
    def packed(batches):
        encode = encoder(tokenizer, keeps_space)
        buffer = Buffer(window, TaskContext.get().partitionId(), combinations(bins, most_parts))
        for batch in batches:
            for part in slices(batch):
                ids, at = encode.encode(part.column(1))
                for row, doc_id in enumerate(part.column(0).to_pylist()):
                    buffer.add(doc_id, np.append(ids[at[row]:at[row + 1]], ids.dtype.type(end_id)))
                if buffer.tokens > BUFFER_TOKENS or len(buffer.docs) > BUFFER_DOCS:
                    yield from buffer.pack()
        if buffer.docs:
            yield from buffer.pack()

    return texts_of(docs).mapInArrow(packed, PIECES)


def digest(pieces):
    """The placed pieces with the crc32 of their ids instead of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")

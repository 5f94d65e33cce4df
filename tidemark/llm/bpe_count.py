"""Token counts by byte-pair merging with a heap and a linked list.

The count of a text is its number of initial symbols less the number of merges; token
ids are never made. The symbols of a chunk form a doubly linked list; a heap holds the
adjacent pairs that the vocabulary can merge, and the pair of lowest rank, leftmost among
equals, is merged until none is left. A character outside the vocabulary counts as
its UTF-8 bytes.

A merge never crosses a place where a word ends and the next space begins, because no
piece of such a vocabulary holds a space behind another character (checked when it is
loaded). So texts are cut there, each task counts a chunk once and looks up its repeats;
chunks not met again for a while are forgotten, so memory does not grow.
"""

import builtins
import heapq
import re
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.llm.shared import slices, texts_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACE = "▁"
KNOWN_CHUNKS = 600_000
LONG_CHUNK = 64
CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*")


class MergeRanks:
    """Ranks of the pieces of a sentencepiece BPE model with byte fallback.

    `ranks`: piece -> rank, lower merges first. The model must not change its input
    (identity normalisation, one space put before the text), which `load` checks.
    """

    def __init__(self, ranks):
        crossing = [p for p in ranks if SPACE in p.lstrip(SPACE)]
        if crossing:
            raise ValueError(f"pieces that merge across a space: {crossing[:3]}")
        self.ranks = ranks
        self.known, self.older = {}, {}

    @classmethod
    def load(cls, path):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = " a  Éﬁ\n\tb "
        if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("the model normalises its input")
        plain = [i for i in range(model.get_piece_size()) if not (
            model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        return cls({model.id_to_piece(i): -model.get_score(i) for i in plain})

    def weight(self, symbol):
        """Tokens that one unmerged character makes."""
        return 1 if symbol in self.ranks else len(symbol.encode())

    def count(self, chunk):
        """Tokens of a chunk: its symbols less its merges."""
        ranks = self.ranks
        symbols = list(chunk)
        n = len(symbols)
        total = 0
        for symbol in symbols:
            total += 1 if symbol in ranks else len(symbol.encode())
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in ranks:
                heap.append((ranks[pair], i, pair))
        heapq.heapify(heap)
        while heap:
            rank, i, pair = heapq.heappop(heap)
            j = after[i]
            left = symbols[i]
            if not left or j >= n or left + symbols[j] != pair:
                continue  # one of the two has been merged since
            total -= self.weight(left) + self.weight(symbols[j]) - 1
            symbols[i], symbols[j] = pair, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                wider = pair + symbols[k]
                if wider in ranks:
                    heapq.heappush(heap, (ranks[wider], i, wider))
            h = before[i]
            if h >= 0:
                wider = symbols[h] + pair
                if wider in ranks:
                    heapq.heappush(heap, (ranks[wider], h, wider))
        return total

    def counts(self, chunks):
        """Counts of distinct chunks, each given without its first space."""
        if len(self.known) > KNOWN_CHUNKS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        held = list(map(known.get, chunks))
        for i, n in enumerate(held):
            if n is None:
                chunk = chunks[i]
                n = held[i] = older[chunk] if chunk in older else self.count(SPACE + chunk)
                if len(chunk) <= LONG_CHUNK:
                    known[chunk] = n
        return held

    def of_texts(self, texts):
        """Tokens of every text of an Arrow string array."""
        texts = texts.cast(pa.string())
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        chunks = lists.flatten().dictionary_encode()
        runs = pc.match_substring_regex(texts, f"  |^ | $|{SPACE}").to_numpy(zero_copy_only=False)
        counts = np.array(self.counts(
            chunks.dictionary.to_numpy(zero_copy_only=False).tolist()), np.int64)
        ends = np.append(0, np.cumsum(counts[chunks.indices.to_numpy()]))
        found = ends[offsets[1:]] - ends[offsets[:-1]]
        for i in np.flatnonzero(runs).tolist():  # several spaces in a row merge with each other
            found[i] = sum(self.counts([
                c[1:] for c in CHUNK.findall(SPACE + texts[i].as_py().replace(" ", SPACE))]))
        found[pc.equal(texts, "").to_numpy(zero_copy_only=False)] = 0
        return found


def merge_ranks(path):
    """The ranks of this worker process; one table for each model."""
    made = builtins.__dict__.setdefault("_tidemark_merge_ranks", {})
    if path not in made:
        made[path] = MergeRanks.load(path)
    return made[path]


def count_tokens(docs, model):
    """`doc_id`, `n_bytes` (UTF-8) and `n_tokens` of every whole text, one row per row of `docs`.

    A null or empty text has no bytes and no tokens, a null `doc_id` stays null, repeated
    rows are counted once each, texts of any length are counted whole; other columns
    are ignored. There is no shuffle.
    """
    def counted(batches):
        ranks = merge_ranks(model)
        for batch in batches:
            for part in slices(batch):
                texts = part.column(1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pc.binary_length(texts).cast(pa.int64()),
                     pa.array(ranks.of_texts(texts), pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"])

    return texts_of(docs).mapInArrow(counted, "doc_id bigint, n_bytes bigint, n_tokens bigint")


def flag_long(counts, limit):
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)

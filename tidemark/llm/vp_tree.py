"""Nearest neighbours by cosine with one vantage-point tree per shard.

Each task deals its vectors to shards of at most `SHARD` rows, and each shard
builds its tree: a node's vantage point splits the rest at the median distance, and both
halves remember the range of their distances to it. A query may leave a half out when

    factor * lower bound of the distance to anything in it > distance of its k-th best,

the bound following from the triangle inequality for the Euclidean distance of unit
vectors, which orders like the cosine. Factor 1 is exact; a larger factor prunes more and
may miss. Queries travel in blocks through the trees, so distances are matrix products.

Trees and blocks are written to the shared folder once. A task reads some of both and takes its
blocks through its trees one after the other, keeping the best so far, so neither is copied for
the other and what leaves a task is `k` rows a query.
"""

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.llm.shared import bounded_batches
from tidemark.llm.vectors import comparable, matrix, packed, unit, unpacked
from tidemark.sources.shared_folder import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARD = 16384
BLOCK = 16384
#: Components of a shard or block at most, whatever the dimension.
NUMBERS = 1 << 21
LEAF = 2048
#: Products that are held at once.
PRODUCTS = 1 << 20
#: A task gets this many shards and blocks of full size, more shards where there would be more than
#: `PARTS` parts of them: every part may give `k` rows for every query.
TOGETHER = 4
PARTS = 32
ROUNDING = 1e-7


def scaled(rows):
    """Rows times powers of two, which is exact, and their lengths; summed from the first
    component to the last."""
    rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])
    return rows, np.sqrt(np.cumsum(rows * rows, axis=1)[:, -1])


def cosine(a, b):
    """Row by row, from scaled rows."""
    (a, a_length), (b, b_length) = scaled(a), scaled(b)
    return np.cumsum(a * b, axis=1)[:, -1] / (a_length * b_length)


def slack(dim):
    """Products of unit vectors in single precision err by less than half of it; what may be among
    the nearest by them gets its full score."""
    return (dim + 8) * 2.0 ** -23


def kth_best(near, k):
    """For each row a value that `k` of its entries reach: of groups of columns only the largest count
    where there are enough."""
    groups = near.shape[1] // 16
    if groups >= k:
        near = near[:, :16 * groups].reshape(len(near), 16, groups).max(axis=1)
    return np.partition(near, -k, axis=1)[:, -k]


def nothing_found(queries, k):
    """(ids, scores) of a search that has not begun."""
    return np.full((queries, k), np.iinfo(np.int64).max), np.full((queries, k), -np.inf)


class VantageTree:
    """Nodes as rows (first, last, split, inner low, inner high, outer low, outer high):
    the node holds vectors first..last, the vantage point first, its inner half up to
    `split`. A leaf has split 0."""

    def __init__(self, ids, vectors, nodes):
        self.ids, self.nodes = ids, nodes
        self.vectors = vectors
        self.units = unit(vectors) if len(ids) else vectors
        self.single = self.units.astype("f4")
        self.scaled, self.lengths = scaled(vectors) if len(ids) else (vectors, np.empty(0))
        self.by_id = np.argsort(ids)

    @classmethod
    def build(cls, ids, vectors):
        order = np.argsort(ids)
        units = unit(vectors)
        nodes, waiting = [], [(0, len(ids))]
        while waiting:
            first, last = waiting.pop()
            here = order[first:last]
            if last - first <= LEAF:
                nodes.append((first, last, 0, 0.0, 0.0, 0.0, 0.0))
                continue
            d = np.sqrt(np.maximum(0, 2 - 2 * units[here] @ units[here[0]]))
            d[0] = 0
            rank = np.argsort(d, kind="stable")
            order[first:last], d = here[rank], d[rank]
            split = first + (last - first) // 2
            cut = split - first
            nodes.append((first, last, split, d[0], d[cut - 1], d[cut], d[-1]))
            waiting += [(first, split), (split, last)]
        return cls(ids[order], vectors[order], np.array(nodes, float))

    def to_row(self):
        return self.ids.astype("<i8").tobytes(), packed(self.vectors), self.nodes.tobytes()

    @classmethod
    def from_row(cls, ids, vectors, nodes, dim):
        return cls(np.frombuffer(ids, "<i8"), unpacked(vectors, dim),
                   np.frombuffer(nodes, float).reshape(-1, 7))

    def places(self, ids):
        """Where the tree holds these ids, -1 for others."""
        at = np.searchsorted(self.ids, ids, sorter=self.by_id)
        place = self.by_id[np.minimum(at, len(self.ids) - 1)]
        return np.where(self.ids[place] == ids, place, -1)

    def search(self, query_ids, queries, k, factor=1.0, found=None):
        """(ids, scores) of the k nearest to each query that are not its own id, best first, ties to
        the smaller id; missing ones have score -inf. `found` has those of other trees, and is
        brought up to date."""
        named, best = found or nothing_found(len(queries), k)
        if not len(self.ids) or not len(queries):
            return named, best
        units = unit(queries)
        single = units.astype("f4")
        full, lengths = scaled(queries)
        own = self.places(query_ids)
        dim = queries.shape[1]
        widest = max(int(last - first) for first, last, split, *_ in self.nodes if not split)
        products = np.empty(max(PRODUCTS, widest), "f4")
        by_range = {(int(n[0]), int(n[1])): (at, n) for at, n in enumerate(self.nodes)}
        away_from = np.sqrt(np.maximum(0, 2 - 2 * units @ self.units[self.nodes[:, 0].astype(int)].T))

        def reach(active):
            """Distance of the k-th best."""
            worst = best[active, -1]
            return np.sqrt(np.maximum(0, 2 - 2 * worst))

        def score(of, at):
            """Full scores of pairs."""
            scores = np.empty(len(of))
            step = max(1, PRODUCTS // dim)
            for first in range(0, len(of), step):
                a, b = of[first:first + step], at[first:first + step]
                dots = np.cumsum(full[a] * self.scaled[b], axis=1)[:, -1]
                scores[first:first + step] = dots / (lengths[a] * self.lengths[b])
            return scores

        def take(of, ids, scores):
            """Merge what was found for some queries into their best."""
            touched = np.unique(of)
            of = np.concatenate([np.repeat(touched, k), of])
            ids = np.concatenate([named[touched].ravel(), ids])
            scores = np.concatenate([best[touched].ravel(), scores])
            order = np.lexsort((ids, -scores, of))
            kept = order[np.searchsorted(of[order], touched)[:, None] + np.arange(k)]
            named[touched], best[touched] = ids[kept], scores[kept]

        def leaf(active, first, last):
            near = products[:len(active) * (last - first)].reshape(len(active), -1)
            np.matmul(single[active], self.single[first:last].T, out=near)
            mine = own[active]
            inside = np.flatnonzero((mine >= first) & (mine < last))
            near[inside, mine[inside] - first] = -np.inf
            floor = best[active, -1]
            begun = floor > -np.inf
            if last - first > k and not begun.all():
                floor[~begun] = kth_best(near[~begun], k)
            floor = np.maximum(floor - slack(dim), -2).astype("f4")
            rows = np.flatnonzero(near.max(axis=1) >= floor)
            of, at = np.divmod(np.flatnonzero(near[rows] >= floor[rows, None]), last - first)
            of, at = active[rows[of]], first + at
            scores = score(of, at)
            better = scores >= best[of, -1]
            if better.any():
                take(of[better], self.ids[at[better]], scores[better])

        # Not by recursion: a function that holds itself would keep all arrays for a while.
        waiting = [(np.arange(len(queries)), np.zeros(len(queries)), 0, len(self.ids))]
        while waiting:
            active, bound, first, last = waiting.pop()
            active = active[factor * bound <= reach(active)]
            if not len(active):
                continue
            node, (first, last, split, *ranges) = by_range[first, last]
            first, last, split = int(first), int(last), int(split)
            if not split:
                step = max(1, PRODUCTS // (last - first))
                for at in range(0, len(active), step):
                    leaf(active[at:at + step], first, last)
                continue
            d = away_from[active, node]
            halves = ((first, split, *ranges[:2]), (split, last, *ranges[2:]))
            inner_first = d <= (ranges[1] + ranges[2]) / 2
            for near, own_side in ((0, inner_first), (1, ~inner_first)):
                now, away = active[own_side], d[own_side]
                for a, b, low, high in (halves[1 - near], halves[near]):
                    bound = np.maximum(0, np.maximum(low - away, away - high)) - ROUNDING
                    waiting.append((now, bound, a, b))
        return named, best


SHARDS = "dim int, ids binary, vectors binary, nodes binary"
BLOCKS = "q_dim int, q_block bigint, q_ids binary, q_vectors binary"


def parcels(batches, most):
    """(dimension, ids, matrix) of the vectors in Arrow batches, at most `most` in one, nor more than
    `NUMBERS` components; no more than four times that wait."""
    waiting = {}

    def size(dim):
        return len(waiting[dim][0]) * dim

    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            part = batch.filter(pa.array(dims == dim))
            ids, rows = part.column("vec_id").to_numpy(), matrix(part.column("v"), dim)
            if dim in waiting:
                ids, rows = (np.concatenate(x) for x in zip(waiting[dim], (ids, rows)))
            full = max(1, min(most, NUMBERS // dim))
            while len(ids) >= full:
                yield dim, ids[:full], rows[:full]
                ids, rows = ids[full:], rows[full:]
            waiting[dim] = ids, rows
        while sum(map(size, waiting)) > 4 * NUMBERS:
            largest = max(waiting, key=size)
            yield largest, *waiting.pop(largest)
    for dim, (ids, rows) in waiting.items():
        if len(ids):
            yield dim, ids, rows


def build_index(vectors, most):
    """One row per shard with its tree, written to the shared folder; every comparable vector is in
    one, with others of its dimension."""
    def trees(batches):
        for dim, ids, rows in parcels(batches, most):
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()),
                 *(pa.array([x], pa.binary()) for x in VantageTree.build(ids, rows).to_row())],
                ["dim", "ids", "vectors", "nodes"])

    return stored(vectors.select("dim", "vec_id", "v").mapInArrow(trees, SHARDS), "vp-trees")


def query_blocks(queries, most, parts):
    """One row per block of queries, written to the shared folder; `q_block` tells blocks apart."""
    def gathered(batches):
        for dim, ids, rows in parcels(batches, most):
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([ids[0]], pa.int64()),
                 pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                 pa.array([packed(rows)], pa.binary())],
                ["q_dim", "q_block", "q_ids", "q_vectors"])

    return stored(queries.select("dim", "vec_id", "v").coalesce(parts).mapInArrow(gathered, BLOCKS),
                  "vp-queries")


def nearest(table, queries, k=5, factor=1.0, vector="embedding"):
    """`query_id`, `rank`, `vec_id`, `score`: the `k` nearest rows of `table` to every row of
    `queries` (a condition on `vec_id`), the query's own id excepted.

    Ties go to the smaller id. Vectors that cannot be compared take no part, on either
    side; vectors of different dimensions do not meet; a table with fewer candidates
    gives them all, an empty one no rows; other columns are ignored.
    """
    bounded_batches(table.sparkSession)
    vectors = comparable(table, vector)
    n, asked = table.where(F.col("vec_id").isNotNull()).count(), table.where(queries).count()
    parts, q_parts = min(PARTS, -(-n // (TOGETHER * SHARD))), -(-asked // (TOGETHER * BLOCK))
    index = build_index(vectors, SHARD).coalesce(max(1, parts))
    wanted = query_blocks(vectors.where(queries), BLOCK, max(1, q_parts)).coalesce(max(1, q_parts))
    # A part of one meets a part of the other in a task; nothing is shuffled or broadcast for it.
    pairs = index.hint("shuffle_replicate_nl").join(wanted, F.col("q_dim") == F.col("dim"))

    def searched(batches):
        blocks, last, tree = {}, None, None
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                if (dim, row["ids"]) != last:
                    last = dim, row["ids"]
                    tree = VantageTree.from_row(row["ids"], row["vectors"], row["nodes"], dim)
                ids = np.frombuffer(row["q_ids"], "<i8")
                found = blocks.setdefault(row["q_block"], (ids, nothing_found(len(ids), k)))[1]
                tree.search(ids, unpacked(row["q_vectors"], dim), k, factor, found)
        for ids, (named, best) in blocks.values():
            of, at = np.nonzero(best > -np.inf)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[of], pa.int64()), pa.array(named[of, at], pa.int64()),
                 pa.array(best[of, at], pa.float64())],
                ["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(searched, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

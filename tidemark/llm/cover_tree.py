"""All pairs of vectors above a cosine threshold by dual traversal of cover trees.

Unit vectors with cosine >= t are at most r = sqrt(2 - 2t) apart. Vectors are dealt to cells
by their nearest pivot, large cells to blocks by a hash, and each block becomes a cover
tree: the children of a node are centres that cover its members within half its radius,
and so on down; every node keeps the largest distance of a member to its centre. Pairs of blocks
are traversed together. With d the distance of two centres and a, b their radii, a pair
of nodes is dropped if d - a - b > r, linked as a whole if d + a + b <= r, and
otherwise opened; pairs of single vectors are decided by their cosine.

Equal vectors are one vector with a weight throughout. A traversal returns a number of links
per vector and which vectors it has connected, never the pairs, so a group of m near
copies leaves O(m) rows. The pivots are a bounded sample: they decide which blocks can be
skipped, not the result.
"""

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shared import bounded_batches, bounded_sample
from tidemark.llm.vectors import comparable, matrix, packed, unit, unpacked
from tidemark.sources.shared_folder import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

THRESHOLD = 0.95
BLOCK = 6144
#: Cells grow with the table up to this many; beyond, cells have more blocks.
MOST_CELLS = 512
ROUNDING = 1e-6
CHUNK = 512


class CoverTree:
    """Vectors in tree order; nodes as rows (first, last, radius, first child, children).

    A node holds the vectors first..last and its centre is the first of them, which is
    the centre of its first child too: levels are nested. A leaf has no children, and
    all its vectors are its centre.
    """

    def __init__(self, ids, weights, vectors, nodes):
        self.ids, self.weights, self.vectors = ids, weights, vectors
        self.units = unit(vectors)
        self.first, self.last = nodes[:, 0].astype(int), nodes[:, 1].astype(int)
        self.radius, self.nodes = nodes[:, 2], nodes
        self.child, self.children = nodes[:, 3].astype(int), nodes[:, 4].astype(int)
        self.summed = np.append(0, np.cumsum(weights))

    @classmethod
    def build(cls, ids, weights, vectors):
        order = np.argsort(ids)
        units = unit(vectors)
        nodes = [[0, len(ids), 0.0, 0, 0]]
        at = 0
        while at < len(nodes):
            first, last = nodes[at][:2]
            here = order[first:last]
            away = distances(units[here], units[here[:1]])[:, 0]
            away[0] = 0
            radius = float(away.max())
            nodes[at][2] = radius
            if last - first > 1 and radius > ROUNDING:
                groups = halve(units, here, away, radius / 2)
                order[first:last] = np.concatenate(groups)
                nodes[at][3:] = [len(nodes), len(groups)]
                for group in groups:
                    nodes.append([first, first + len(group), 0.0, 0, 0])
                    first += len(group)
            elif last - first > 1:  # equal but for rounding: still single vectors
                nodes[at][3:] = [len(nodes), last - first]
                nodes += [[i, i + 1, 0.0, 0, 0] for i in range(first, last)]
            at += 1
        return cls(ids[order], weights[order], vectors[order], np.array(nodes, float))

    def to_row(self):
        return (self.ids.astype("<i8").tobytes(), self.weights.astype("<i8").tobytes(),
                packed(self.vectors), self.nodes.tobytes())

    @classmethod
    def from_row(cls, ids, weights, vectors, nodes, dim):
        return cls(np.frombuffer(ids, "<i8"), np.frombuffer(weights, "<i8"),
                   unpacked(vectors, dim), np.frombuffer(nodes, float).reshape(-1, 5))


def distances(a, b):
    return np.sqrt(np.maximum(0, 2 - 2 * (a @ b.T)))


def halve(units, members, away, radius):
    """Members in groups within `radius` of the first of each group."""
    groups = [members[away <= radius]]
    left = members[away > radius]
    while len(left):
        near = distances(units[left], units[left[:1]])[:, 0] <= radius
        near[0] = True
        groups.append(left[near])
        left = left[~near]
    return groups


class Links:
    """Number of links and connected sets of the vectors of one or two trees."""

    def __init__(self, n):
        self.count = np.zeros(n, np.int64)
        self.root = np.arange(n)

    def connect(self, a, b):
        """Connect a[i] with b[i] for every i."""
        root = self.root
        while True:
            ra, rb = root[a], root[b]
            if (ra == rb).all():
                return
            low, high = np.minimum(ra, rb), np.maximum(ra, rb)
            np.minimum.at(root, high, low)
            while True:
                next_root = root[root]
                if (next_root == root).all():
                    break
                root[:] = next_root


def traverse(a, b, threshold):
    """The `Links` between the vectors of two trees, or inside one if they are the same;
    the vectors of `b` come after those of `a`."""
    same = a is b
    r = math.sqrt(2 - 2 * threshold)
    shift = 0 if same else len(a.ids)
    links = Links(len(a.ids) + (0 if same else len(b.ids)))

    def whole(i, j):
        """All of node i with all of node j."""
        ai, bj = slice(a.first[i], a.last[i]), slice(b.first[j] + shift, b.last[j] + shift)
        in_i = a.summed[a.last[i]] - a.summed[a.first[i]]
        if same and i == j:
            links.count[ai] += in_i - a.weights[ai]
        else:
            links.count[ai] += b.summed[b.last[j]] - b.summed[b.first[j]]
            links.count[bj] += in_i
        members = np.concatenate([np.arange(ai.start, ai.stop), np.arange(bj.start, bj.stop)])
        links.connect(members, np.full(len(members), members[0]))

    def singles(pi, pj):
        """Pairs of single vectors, by place."""
        linked = np.einsum("ij,ij->i", a.units[pi], b.units[pj]) >= threshold
        pi, pj = pi[linked], pj[linked]
        np.add.at(links.count, pi, b.weights[pj])
        np.add.at(links.count, pj + shift, a.weights[pi])
        links.connect(pi, pj + shift)

    def parts(tree, node):
        if not tree.children[node]:
            return np.array([node])
        return np.arange(tree.child[node], tree.child[node] + tree.children[node])

    waiting = [(0, 0)]
    while waiting:
        i, j = waiting.pop()
        inside = same and i == j
        if inside and 2 * a.radius[i] <= r - ROUNDING:
            whole(i, i)
            continue
        left, right = parts(a, i), parts(b, j)
        if inside and len(left) == 1:
            continue  # one vector alone
        alone_b = b.last[right] - b.first[right] == 1
        for some in range(0, len(left), CHUNK):
            li = left[some:some + CHUNK]
            d = distances(a.units[a.first[li]], b.units[b.first[right]])
            near = d <= r + a.radius[li][:, None] + b.radius[right] + ROUNDING
            if inside:
                near &= li[:, None] < right
            x, y = np.nonzero(near)
            if not len(x):
                continue
            ni, nj = li[x], right[y]
            single = (a.last[ni] - a.first[ni] == 1) & alone_b[y]
            singles(a.first[ni[single]], b.first[nj[single]])
            ni, nj, d = ni[~single], nj[~single], d[x, y][~single]
            all_near = d + a.radius[ni] + b.radius[nj] <= r - ROUNDING
            for p, q in zip(ni[all_near].tolist(), nj[all_near].tolist()):
                whole(p, q)
            waiting += zip(ni[~all_near].tolist(), nj[~all_near].tolist())
        if inside:
            waiting += [(p, p) for p in left.tolist()]
    return links


TREES = ("dim int, cell int, block int, radius double, ids binary, weights binary, "
         "vectors binary, nodes binary")


def nearest_pivot(vectors, pivots):
    """`vectors` with the `cell` of their nearest pivot and the distance to it."""
    def dealt(batches):
        units = {dim: unit(np.array(rows)) for dim, rows in pivots.items()}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                d = distances(unit(matrix(part.column("v"), dim)), units[dim])
                cell = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(cell, pa.int32()),
                     pa.array(d[np.arange(len(cell)), cell])],
                    [*part.schema.names, "cell", "away"])

    return vectors.mapInArrow(
        dealt, "vec_id bigint, v array<double>, dim int, weight bigint, cell int, away double")


def build_trees(vectors):
    """One row per block with its tree, and for each pair of cells that may hold links
    a row (`dim`, `cell`, `other`).

    To the driver come at most `MOST_CELLS` pivots a dimension and one row per cell.
    """
    spark = vectors.sparkSession
    sizes = {r["dim"]: r["n"] for r in vectors.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    pivots = {}
    for dim, n in sizes.items():
        cells = max(1, min(MOST_CELLS, n // BLOCK))
        sample = bounded_sample(vectors.where(F.col("dim") == dim), F.col("vec_id"), cells)
        pivots[dim] = [r["v"] for r in sample.select("v").collect()]
    celled = stored(nearest_pivot(vectors, pivots), "cover-cells")
    cells = celled.groupBy("dim", "cell").agg(
        F.count("*").alias("n"), F.max("away").alias("radius")).collect()
    blocks = spark.createDataFrame(
        [(c["dim"], c["cell"], -(-c["n"] // BLOCK)) for c in cells],
        "dim int, cell int, blocks int")
    dealt = celled.join(F.broadcast(blocks), ["dim", "cell"]).withColumn(
        "block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))

    def tree(key, rows):
        dim = key[0].as_py()
        built = CoverTree.build(rows.column("vec_id").to_numpy(), rows.column("weight").to_numpy(),
                                matrix(rows.column("v"), dim))
        columns = [[key[0].as_py()], [key[1].as_py()], [key[2].as_py()],
                   [float(built.radius[0])], *[[x] for x in built.to_row()]]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64()] + [pa.binary()] * 4
        names = [field.split()[0] for field in TREES.split(", ")]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})

    trees = dealt.select("dim", "cell", "block", "vec_id", "weight", "v").groupBy(
        "dim", "cell", "block").applyInArrow(tree, TREES)
    return trees, cells, pivots


def reachable(cells, pivots, threshold):
    """(dim, cell, other) with cell <= other whose members may be linked."""
    r = math.sqrt(2 - 2 * threshold)
    found = []
    for dim, rows in pivots.items():
        own = {c["cell"]: c["radius"] for c in cells if c["dim"] == dim}
        d = distances(unit(np.array(rows)), unit(np.array(rows)))
        found += [(dim, x, y) for x in own for y in own
                  if x <= y and (x == y or d[x, y] <= r + own[x] + own[y] + ROUNDING)]
    return found


def links_between(trees, near, threshold):
    """(`vec_id`, `n`, `root`): links of vectors found by one traversal, and a vector that it
    connected each with. A vector has a row for each pair of blocks in which it has links."""
    spark = trees.sparkSession
    near = spark.createDataFrame(near, "dim int, cell int, other int")  # at most MOST_CELLS^2 / 2
    index = trees.select("dim", "cell", "block")
    mates = index.toDF("dim", "other", "other_block")
    pairs = (index.join(F.broadcast(near), ["dim", "cell"]).join(mates, ["dim", "other"])
             .where((F.col("cell") < F.col("other")) | (F.col("block") <= F.col("other_block"))))
    named = trees.select(*[F.col(c).alias(f"x_{c}") if c not in ("dim", "cell", "block") else c
                           for c in trees.columns])
    others = trees.select("dim", F.col("cell").alias("other"), F.col("block").alias("other_block"),
                          *[F.col(c).alias(f"y_{c}") for c in trees.columns[3:]])
    both = pairs.join(named, ["dim", "cell", "block"]).join(others, ["dim", "other", "other_block"])

    def traversed(batches):
        for batch in batches:
            for row in batch.to_pylist():
                get = lambda side: CoverTree.from_row(*[
                    row[f"{side}_{n}"] for n in ("ids", "weights", "vectors", "nodes")], row["dim"])
                a = get("x")
                same = (row["cell"], row["block"]) == (row["other"], row["other_block"])
                b = a if same else get("y")
                links = traverse(a, b, threshold)
                ids = a.ids if same else np.concatenate([a.ids, b.ids])
                some = np.flatnonzero(links.count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[some]), pa.array(links.count[some]),
                     pa.array(ids[links.root[some]])], ["vec_id", "n", "root"])

    return both.mapInArrow(traversed, "vec_id bigint, n bigint, root bigint")


def similar_vectors(table, threshold=THRESHOLD, vector="embedding"):
    """`vec_id`, `n_links`, `component_id`, `kept` of every row of `table`.

    `n_links`: other vectors with a cosine of at least `threshold`; `component_id`: the
    smallest id reached by links; `kept`: that is its own. Vectors that are null, empty,
    zero or hold null or non-finite components have no links; vectors of different
    dimensions have none with each other; rows without id have no row; repeated ids
    have one row, for their smallest vector. An empty table gives no rows.
    """
    bounded_batches(table.sparkSession)
    ids = table.where(F.col("vec_id").isNotNull()).select("vec_id").distinct()
    keys = [F.xxhash64(F.lit(seed), "v").alias(f"key{seed}") for seed in (1, 2)]
    vectors = stored(comparable(table, vector).select("vec_id", "v", "dim", *keys), "cover-vectors")
    copies = vectors.groupBy("key1", "key2").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("weight"))
    distinct = stored(vectors.join(
        copies.select(F.col("first").alias("vec_id"), "weight"), "vec_id").select(
            "vec_id", "v", "dim", "weight"), "cover-distinct")
    members = vectors.select("vec_id", "key1", "key2").join(copies, ["key1", "key2"]).select(
        "vec_id", "first", "weight")
    trees, cells, pivots = build_trees(distinct)
    trees = stored(trees, "cover-trees")
    found = stored(links_between(trees, reachable(cells, pivots, threshold), threshold),
                   "cover-links")
    counted = found.groupBy(F.col("vec_id").alias("first")).agg(F.sum("n").alias("n"))
    classes = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")),
                         "cover-classes").withColumnRenamed("node", "first")
    linked = (members.join(counted, "first", "left").join(classes, "first", "left")
              .select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                      F.coalesce("component", "first").alias("component_id")))
    component = F.coalesce("component_id", "vec_id")
    return ids.join(linked, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"), (component == F.col("vec_id")).alias("kept"))

"""Nearest neighbours and similarity joins against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import cover_tree, vp_tree
from tidemark.llm import components as steps
from tidemark.llm.components import components, with_further_edges
from tidemark.llm.vectors import packed, unit, unpacked

ROWS = "vec_id bigint, embedding array<float>, label int"


@pytest.fixture(scope="module")
def clustered(spark):
    """Vectors in tight groups, copies among them, and far ones."""
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(12, 16))
    rows = [c + draw.normal(scale=s, size=16) for c in centres for s in [0.02] * 20 + [0.2] * 15]
    rows += list(draw.normal(size=(150, 16)))
    rows += [rows[0]] * 40 + [rows[300]] * 3
    rows = np.array(rows, "f4")
    return spark.createDataFrame(
        [(i, r.tolist(), 0) for i, r in enumerate(rows)], ROWS), rows.astype(float)


AWKWARD = [(1, None, 0), (2, [0.0, 0.0], 0), (3, [1.0, None], 0), (4, [float("nan"), 1.0], 0),
           (5, [float("inf"), 1.0], 0), (6, [], 0), (7, [1.0, 0.0], None), (8, [2.0, 0.0], 1),
           (8, [2.0, 0.0], 1), (9, [1.0, 0.0, 0.0], 1), (10, [0.0, 1.0], 1),
           (None, [1.0, 0.0], 1), (50, [3.0, 0.01], 2), (100, [1.0, 0.0], 2)]


def cosines(rows):
    u = unit(rows)
    return u @ u.T


def brute_nearest(ids, rows, queries, k):
    c = cosines(rows)
    out = {}
    for q in queries:
        at = ids.index(q)
        order = sorted((i for i in range(len(ids)) if i != at),
                       key=lambda i: (-round(c[at, i], 12), ids[i]))
        out[q] = [ids[i] for i in order[:k]]
    return out


@pytest.mark.parametrize("shard", [4096, 100])
def test_factor_one_is_exact(clustered, monkeypatch, shard):
    monkeypatch.setattr(vp_tree, "SHARD", shard)
    monkeypatch.setattr(vp_tree, "BLOCK", 7)
    df, rows = clustered
    found = vp_tree.nearest(df.withColumn("rank", df.vec_id), "vec_id % 5 = 0", k=5).collect()
    expected = brute_nearest(list(range(len(rows))), rows, range(0, len(rows), 5), 5)
    by_query = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        by_query.setdefault(r["query_id"], []).append(r["vec_id"])
        a, b = rows[r["query_id"]], rows[r["vec_id"]]
        assert r["score"] == pytest.approx(a @ b / np.sqrt((a @ a) * (b @ b)), abs=1e-14)
    assert by_query == expected


def test_near_ties_go_by_the_full_score(spark):
    """Ten cosines that differ by less than the products of unit vectors tell apart."""
    query = [1.0, 0.0]
    rows = [(0, query, 0)] + [(90 + i, [1.0, 0.3 - 4e-14 * i], 0) for i in range(1, 11)]
    rows += [(200 + i, [1.0, 0.3 - 4e-13], 0) for i in range(300)]  # copies of the best
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    found = vp_tree.nearest(df, "vec_id = 0", k=4).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == [100, 200, 201, 202]
    for row in found:
        vector = np.array([dict((r[0], r[1]) for r in rows)[row["vec_id"]]])
        assert row["score"] == vp_tree.cosine(np.array([query]), vector)[0]
    plain = spark.createDataFrame(rows[:11], df.schema)
    found = vp_tree.nearest(plain, "vec_id = 0", k=3).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == [100, 99, 98]


def test_larger_factors_prune_more_and_recall_less(clustered, monkeypatch):
    _, rows = clustered
    monkeypatch.setattr(vp_tree, "LEAF", 8)
    tree = vp_tree.VantageTree.build(np.arange(len(rows)), rows)
    exact = tree.search(np.arange(len(rows)), rows, 5, 1.0)[0]
    recall = []
    for factor in (1.0, 1.2, 100.0):
        named = tree.search(np.arange(len(rows)), rows, 5, factor)[0]
        recall.append(np.mean([len(set(a) & set(b)) / 5 for a, b in zip(exact, named)]))
    assert recall[0] == 1.0 and recall[0] >= recall[1] >= recall[2]
    assert recall[1] >= 0.9 and recall[2] < 1.0


def test_several_parts_meet_and_nothing_is_copied_for_it(clustered, monkeypatch):
    """Only what was found is shuffled: no block of queries is repeated for a shard."""
    for name, most in {"SHARD": 30, "BLOCK": 16, "LEAF": 8, "TOGETHER": 2, "PARTS": 3, "PRODUCTS": 64}.items():
        monkeypatch.setattr(vp_tree, name, most, raising=False)
    df, rows = clustered
    neighbours = vp_tree.nearest(df, "vec_id % 3 = 0", k=7)
    plan = neighbours._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "CartesianProduct" in plan and "Generate" not in plan
    found = {}
    for r in neighbours.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert found == brute_nearest(list(range(len(rows))), rows, range(0, len(rows), 3), 7)


def test_a_search_goes_on_in_the_next_tree(monkeypatch):
    """Scores that single precision does not tell apart, spread over trees, and ties by id."""
    monkeypatch.setattr(vp_tree, "LEAF", 8)
    angles = 0.5 + 1e-9 * np.random.default_rng(2).permutation(120)
    rows = np.stack([np.cos(angles), np.sin(angles)], axis=1)
    rows[::10] = rows[0]
    query, found = np.array([[1.0, 0.0]]), vp_tree.nothing_found(1, 9)
    for first in range(0, 120, 40):
        ids = np.arange(first, first + 40)
        vp_tree.VantageTree.build(ids, rows[ids]).search(np.array([3]), query, 9, 1.0, found)
    scores = vp_tree.cosine(np.repeat(query, 120, axis=0), rows)
    best = [i for i in np.lexsort((np.arange(120), -scores)) if i != 3][:9]
    assert found[0][0].tolist() == best and found[1][0].tolist() == scores[best].tolist()


def test_parcels_hold_every_vector_once(monkeypatch):
    monkeypatch.setattr(vp_tree, "NUMBERS", 24)
    vectors = [(i, [float(i)] * dim) for i, dim in enumerate([2, 3, 40, 2, 5, 2, 1, 3] * 6)]
    batches = [pa.RecordBatch.from_pydict(
        {"dim": pa.array([len(v) for _, v in part], pa.int32()), "vec_id": [i for i, _ in part],
         "v": [v for _, v in part]}) for part in (vectors[:17], vectors[17:18], vectors[18:])]
    parcels = list(vp_tree.parcels(iter(batches), 4))
    assert sorted(i for _, ids, _ in parcels for i in ids.tolist()) == list(range(48))
    for dim, ids, rows in parcels:
        assert len(ids) == 1 or len(ids) <= 4 and rows.size <= 24
        assert [(i, v) for i, v in zip(ids.tolist(), rows.tolist())] == [vectors[i] for i in ids]
        assert rows.shape == (len(ids), dim)


def test_awkward_vectors_have_no_neighbours(spark):
    df = spark.createDataFrame(AWKWARD, ROWS)
    found = vp_tree.nearest(df, "vec_id % 50 = 0", k=5).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in found] == [
        (50, 1, 7), (50, 2, 8), (50, 3, 100), (50, 4, 10),
        (100, 1, 7), (100, 2, 8), (100, 3, 50), (100, 4, 10)]


def test_nothing_to_search(spark):
    empty = spark.createDataFrame([], ROWS)
    assert vp_tree.nearest(empty, "true").collect() == []
    assert cover_tree.similar_vectors(empty).collect() == []
    one = spark.createDataFrame([(0, [1.0], 0)], ROWS)
    assert vp_tree.nearest(one, "true").collect() == []


def brute_links(rows, threshold):
    linked = cosines(rows) >= threshold
    np.fill_diagonal(linked, False)
    root = np.arange(len(rows))
    while True:
        least = np.array([min([root[i], *root[linked[i]]]) for i in range(len(rows))])
        if (least == root).all():
            return linked.sum(1), root
        root = least


@pytest.mark.parametrize("block,threshold", [(6144, 0.95), (60, 0.95), (60, 0.99), (60, 0.5)])
def test_links_equal_brute_force(clustered, monkeypatch, block, threshold):
    monkeypatch.setattr(cover_tree, "BLOCK", block)
    df, rows = clustered
    found = sorted(cover_tree.similar_vectors(df.withColumn("n", df.vec_id), threshold).collect())
    n, root = brute_links(rows, threshold)
    assert [r["vec_id"] for r in found] == list(range(len(rows)))
    assert [r["n_links"] for r in found] == n.tolist()
    assert [r["component_id"] for r in found] == root.tolist()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


def test_awkward_vectors_have_no_links(spark):
    found = cover_tree.similar_vectors(spark.createDataFrame(AWKWARD, ROWS)).collect()
    linked = {7, 8, 50, 100}
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found} == {
        i: (3, 7, i == 7) if i in linked else (0, i, True)
        for i in {r[0] for r in AWKWARD if r[0] is not None}}
    assert len(found) == 12


def test_levels_are_nested_and_cover():
    draw = np.random.default_rng(1)
    rows = np.concatenate([draw.normal(size=(100, 6)), np.ones((5, 6)) + 1e-3 * draw.normal(size=(5, 6))])
    tree = cover_tree.CoverTree.build(np.arange(105), np.ones(105, int), rows)
    d = cover_tree.distances(tree.units, tree.units)
    for node in range(len(tree.first)):
        first, last = tree.first[node], tree.last[node]
        assert d[first, first:last].max() <= tree.radius[node] + 1e-7
        for child in range(tree.child[node], tree.child[node] + tree.children[node]):
            assert first <= tree.first[child] and tree.last[child] <= last
            assert tree.radius[child] <= tree.radius[node] / 2 + 1e-7
        if tree.children[node]:
            assert tree.first[tree.child[node]] == first


def test_huge_and_tiny_components():
    rows = np.array([[1e300, 1e300], [1e-300, 1e-300], [3.0, 4.0]])
    assert np.allclose(np.linalg.norm(unit(rows), axis=1), 1)
    assert vp_tree.cosine(rows[:2], rows[1::-1]) == pytest.approx([1.0, 1.0])
    assert (unpacked(packed(rows), 2) == rows).all()


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components(spark, edges):
    root = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r["node"]: r["component"] for r in found} == root and len(found) == len(root)


@pytest.fixture
def written(monkeypatch):
    """How many rows each table has that the components write."""
    rows, own = [], steps.stored

    def counting(table, label):
        found = own(table, label)
        rows.append(found.count())
        return found
    monkeypatch.setattr(steps, "stored", counting)
    return rows


def test_stars_need_no_round(spark, written):
    stars = spark.range(10, 60).selectExpr("id % 10 AS a", "id AS b")
    assert {(r["node"], r["component"]) for r in components(stars).collect()} == {
        (n, n % 10) for n in range(60)}
    assert written == [50, 60]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=20),
       st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=10))
def test_further_edges_by_brute_force(spark, edges, further):
    def smaller(found):
        return {r["node"]: r["component"] for r in found.collect() if r["node"] != r["component"]}
    first, more = (spark.createDataFrame(e, "a bigint, b bigint") for e in (edges, further))
    found = with_further_edges(components(first), more)
    assert found.count() == len(smaller(found))
    assert smaller(found) == smaller(components(first.union(more)))


def test_further_edges_go_through_components_only(spark, written):
    known = components(spark.range(10, 1000).selectExpr("id % 10 AS a", "id AS b"))
    written.clear()
    more = spark.createDataFrame([(998, 999), (13, 1003), (8, 9)], "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in with_further_edges(known, more).collect()}
    assert found == {n: min(n % 10, 8) for n in range(9, 1000) if n > 9 or n % 10 == 9} | {1003: 3}
    assert max(written[:-1]) <= 6


def test_long_chains(spark):
    chain = spark.range(1, 200).selectExpr("id - 1 AS a", "id AS b")
    assert {r["component"] for r in components(chain).collect()} == {0}

"""Connected components of an edge table by alternating stars.

Each round points every node's neighbours at its smallest neighbour, first the larger ones
and then the smaller ones, until every edge leads straight to the smallest node of its
component. Then each node is smaller than all its neighbours or has a single one, which is smaller;
the minima that a round begins with tell that, so no round is run only to see that nothing changes.
Rounds grow with the logarithm of the number of edges; edges never leave
the executors. The edges of a round are written to the shared folder, so a lost executor
repeats one round and plans stay short.
"""

from pyspark.sql import functions as F

from tidemark.sources.shared_folder import stored


def smallest_neighbours(edges):
    """Of every node `u` of `edges` (`u` > `v`): `m`, the least of it and its neighbours, and `open`, if
    it has a smaller neighbour and others beside that."""
    both = edges.select("u", "v").union(edges.selectExpr("v as u", "u as v"))
    least, most = F.min("v"), F.max("v")
    return both.groupBy("u").agg(F.least(least, F.col("u")).alias("m"),
                                 ((least < F.col("u")) & (least < most)).alias("open"))


def star_round(edges, least, label):
    """Minima are written before they are joined: then Spark can split a node that a large
    part of all edges meets in."""
    large = stored(edges.join(least.selectExpr("u as v", "m"), "v").selectExpr("u", "m as v"), label)
    smallest = stored(large.groupBy("u").agg(F.min("v").alias("m")), label)
    rest = large.join(smallest, "u").where("v != m").selectExpr("v as u", "m as v").distinct()
    return smallest.selectExpr("u", "m as v").union(rest)


def components(edges, label="components"):
    """(`node`, `component`) for every node of `edges` (`a`, `b`), written to the shared folder: the
    smallest node it reaches.

    Loops, repeated and reversed edges are allowed; edges with a null end are no edges.
    Nodes that only have loops are not listed, nor are nodes without edges.
    """
    a, b = F.col("a"), F.col("b")
    edges = stored(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")),
                   label)
    while True:
        least = stored(smallest_neighbours(edges), label)
        if least.where("open").isEmpty():
            return least.selectExpr("u as node", "m as component")
        edges = stored(star_round(edges, least, label), label)


def with_further_edges(known, edges, label="components"):
    """(`node`, `component`) for every node that reaches a smaller one, by the edges that the components
    `known` are of or by further `edges` (`a`, `b`).

    Only the components that these edges connect are gone through, as one node each.
    """
    moved = known.where("node <> component")
    for side in ("a", "b"):
        own = moved.selectExpr(f"node as {side}", "component")
        edges = edges.join(own, side, "left").withColumn(side, F.coalesce("component", side)).drop("component")
    merged = components(edges, label).where("node <> component")
    further = merged.selectExpr("node as component", "component as smaller")
    return stored(moved.join(further, "component", "left").select(
        "node", F.coalesce("smaller", "component").alias("component")).union(merged), label)

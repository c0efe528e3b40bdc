"""Connected components of an edge table, by contraction."""

from pyspark.sql import functions as F

from unitgrid.session import discard, materialize


def components(edges):
    """(node, component) for every node of `edges` (a, b long); the component is one of its nodes.

    Each round every node follows its least neighbour (twice), and edges are carried over to the followed nodes, until none is
    left. Node numbers should be hashes: then the rounds grow with the logarithm of the longest path. The state of a
    round is a table in the shared folder; no node's neighbours are gathered, only their minimum.
    """
    left, rounds, used = edges.select("a", "b"), [], []
    while True:
        left = materialize(left.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        used.append(left)
        if left.isEmpty():
            break
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p"))
        near = materialize(near, "near")
        step = near.join(near.select(F.col("a").alias("p"), F.col("p").alias("q")), "p").select("a", F.col("q").alias("p"))
        step = materialize(step, "step")
        used += [near, step]
        rounds.append(step)
        left = (left.join(step, "a").select(F.col("p").alias("pa"), "b")
                .join(step.select(F.col("a").alias("b"), F.col("p").alias("pb")), "b").select(F.col("pa").alias("a"), F.col("pb").alias("b")))
    if not rounds:
        discard(*used)
        return edges.sparkSession.createDataFrame([], "node long, component long")
    label = rounds.pop()
    while rounds:
        below = rounds.pop()
        label = (below.join(label.select(F.col("a").alias("p"), F.col("p").alias("q")), "p", "left")
                 .select("a", F.coalesce("q", "p").alias("p")))
    found = materialize(label.select(F.col("a").alias("node"), F.col("p").alias("component")), "components")
    discard(*used)
    return found

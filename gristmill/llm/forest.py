"""Borůvka-style contraction: a spanning forest of a graph of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.session import durable


def _empty(df: DataFrame) -> bool:
    return not df.take(1)


def _roots(hooks: DataFrame) -> DataFrame:
    """``a, root`` of every node of a pointer forest ``a -> p``; a root points at itself.

    Each round doubles the distance that a pointer spans, so a path of n nodes
    takes log2(n) rounds.
    """
    while True:
        up = hooks.select(F.col("a").alias("p"), F.col("p").alias("pp"))
        jumped = durable(hooks.join(up, "p", "left").select("a", F.coalesce("pp", "p").alias("p"), (F.coalesce("pp", "p") != F.col("p")).alias("moved")))
        hooks = jumped.select("a", "p")
        if _empty(jumped.where("moved")):
            return hooks.select("a", F.col("p").alias("root"))


def spanning_forest(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Contract ``edges (u, v)`` and return ``(labels, forest)``.

    ``labels`` has ``node, root`` for every node of an edge that joins two
    nodes; ``forest`` has the edges that were chosen, ``u, v``: one fewer than
    the nodes of each tree.  In each round every tree picks its least edge (by
    a hash of its ends, then by the ends themselves, so no two edges tie), the
    trees hook along the picks, and the graph is contracted; the number of trees
    at least halves, so the rounds are logarithmic.  The picks are an aggregate
    with a partial step: a node with a third of all edges is no hot spot.  Null
    ends, loops and repeated edges are ignored.  Every round's labels and edges
    are written to the shared folder.
    """
    e = edges.where("u is not null and v is not null and u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    e = durable(e.select("u", "v", F.xxhash64("u", "v").alias("w"), F.col("u").alias("a"), F.col("v").alias("b")))
    labels = durable(e.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("root", F.col("node")))
    forest = None
    while not _empty(e):
        both = e.unionByName(e.select("u", "v", "w", F.col("b").alias("a"), F.col("a").alias("b")))
        picks = durable(both.groupBy("a").agg(F.min(F.struct("w", "u", "v", "b")).alias("m")).select("a", F.col("m.b").alias("b"), "m.u", "m.v"))
        chosen = picks.select("u", "v").distinct()
        forest = durable(chosen if forest is None else forest.unionByName(chosen))
        back = picks.select(F.col("a").alias("b"), F.col("b").alias("bb"))
        mutual = (F.col("bb") == F.col("a")) & (F.col("a") < F.col("b"))
        hooks = picks.join(back, "b", "left").select("a", F.when(mutual, F.col("a")).otherwise(F.col("b")).alias("p"))
        roots = _roots(hooks)
        up = roots.select(F.col("a").alias("root"), F.col("root").alias("up"))
        labels = durable(labels.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")))
        ra, rb = roots.select("a", F.col("root").alias("ra")), roots.select(F.col("a").alias("b"), F.col("root").alias("rb"))
        moved = e.join(ra, "a").join(rb, "b").where("ra <> rb")
        e = durable(moved.groupBy(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).agg(F.min(F.struct("w", "u", "v")).alias("m")).select("m.u", "m.v", "m.w", "a", "b"))
    return labels, (forest if forest is not None else e.select("u", "v"))

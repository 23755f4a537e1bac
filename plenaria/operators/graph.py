"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, functions as F

from plenaria.session import stored


def _stars(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with ``least``, the smallest of u and all its neighbours.

    The smallest is an aggregation that combines before the shuffle; it goes back to the edges by a
    join of one row per node, which adaptive execution splits where a node has very many edges.
    """
    least = edges.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_v")).select("_u", F.least("_u", "_v").alias("least"))
    return edges.join(least, F.col("u") == F.col("_u")).select("u", "v", "least")


def _mark(edges: DataFrame) -> Row:
    """Number of edges and a digest of them all, to see when nothing changes any more."""
    return edges.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "node", a: str = "a", b: str = "b",
                         out: str = "component") -> DataFrame:
    """Smallest node of each component as its label.

    Two steps alternate. The first links every larger neighbour of a node with the smallest node
    around it, the second links a node and its smaller neighbours with the smallest of these. Both
    keep the components and make edges point to smaller nodes, until each component is a star around
    its smallest node; the number of rounds grows with the logarithm of its size. Edges that have
    become equal leave in each step. Isolated nodes keep their own label.
    """
    current = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    before, mark = None, _mark(current)
    while mark.n and mark != before:
        both = current.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        large = _stars(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v").distinct()
        # every edge points to a smaller node now, so the neighbours of u are the smaller ones
        small = _stars(stored(large))
        ends = F.array(F.struct(F.col("v").alias("u"), F.col("least").alias("v")), F.struct("u", F.col("least").alias("v")))
        current = stored(small.select(F.inline(ends)).where("u <> v").distinct())
        before, mark = mark, _mark(current)
    labels = current.select(F.col("u").alias("_n"), F.col("v").alias("_label"))
    known = nodes.select(F.col(node).alias("_node")).distinct()
    return known.join(labels, F.col("_node") == F.col("_n"), "left").select(F.col("_node").alias(node), F.coalesce("_label", "_node").alias(out))

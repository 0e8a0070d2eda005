"""Connected components over a table of links, in DataFrame operations only.

Alternating large-star and small-star steps (Kiveris et al., 2014) on edges from the larger to the smaller
node. Each step is one aggregation by node and one join; nothing is collected per node, so a hub with any
number of neighbours is a plain reduction. Every round is written to the shared folder, which cuts the
lineage; the driver sees one counter per round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.scratch import discard, materialise


def own_exchange(column: Column) -> Column:
    """The same long under an expression the planner doesn't see through: a join on it gets an exchange of its
    own on this side too, and so AQE can split hot keys of the other side instead of sending them to one task."""
    return column.bitwiseXOR(F.lit(0).cast("long"))


def row_digest() -> tuple[Column, Column]:
    """128 bits of a row's doc_id (null or not) and text: the key of a row where doc_id may be null or repeat."""
    text = F.coalesce("text", F.lit(""))
    return F.xxhash64("doc_id", text), F.xxhash64(F.lit(1), "doc_id", text)


def _targets(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m")).select(own_exchange(F.col("u")).alias("k"), "m")


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node moves to that node's least neighbour. A node's least neighbour is its least
    smaller one, or itself: an edge (u, v) becomes (u, least of v's)."""
    least = _targets(edges)
    return edges.join(least, edges["v"] == least["k"], "left").select("u", F.coalesce("m", "v").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours and itself move to the least of them."""
    least = _targets(edges)
    both = edges.join(least, edges["u"] == least["k"])
    moved = F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
    return both.select(moved.alias("e")).select("e.u", "e.v").where("u > v").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its least node) for every node in a link between two different, non-null nodes."""
    first = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    now = materialise(first, "links")
    while True:
        # Stars only: no target has a target of its own, and no node has two.
        step = materialise(_small_star(_large_star(now)), "links")
        discard(now)
        now = step
        nodes = now.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.lit(True).alias("is_source"))
        many = now.groupBy("v").agg(F.lit(True).alias("is_target")).join(nodes, F.col("v") == F.col("u"), "full").agg(F.count_if((F.col("n") > 1) | (F.col("is_source") & F.col("is_target"))).alias("open"))
        if not many.first()["open"]:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

"""Connected components of an undirected graph by alternating large-star and small-star steps.

Both steps are one aggregate and one join over the edge list, so no adjacency list is ever held
by one task; a node with very many neighbours is a skewed join side, which adaptive execution
splits.  Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import drop, written


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` to ``(node, root)``: root is the least node of the component; lone nodes have no row.

    Self-loops, repeated edges and nulls are ignored; an empty graph gives no rows.
    """
    state = written(_smaller(edges.where("a is not null and b is not null and a <> b").select("a", "b")).distinct(), "edges")
    while True:
        after = written(_small_star(_large_star(state)), "edges")
        # both tables hold different rows each: of the same size they are equal if none is missing
        if after.count() == state.count() and not after.join(state, ["a", "b"], "left_anti").limit(1).count():
            drop(state)
            found = after.select(F.col("a").alias("node"), F.col("b").alias("root"))
            found.scratch_path = after.scratch_path  # the caller may drop it
            return found
        drop(state)
        state = after


def _smaller(edges: DataFrame) -> DataFrame:
    """Each edge from its larger to its smaller end."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = _smaller(edges).toDF("u", "v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return _smaller(linked.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b")).distinct()

"""Connected components of a link table, by joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.llm.common import materialise


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``v``, ``label``: for each linked vertex the smallest vertex that it can reach.

    Randomised contraction: in every round each vertex is given to the first vertex
    around it, itself included, in an order that a hash draws anew, and the links are
    contracted to the vertices that others were given to. A link is stored once, and
    links that fall together or into one vertex vanish, so that the table shrinks by a
    constant factor a round whatever the shape of the graph (a path, a star, a clique).
    The vertices' ways are then followed from the last round back to the first.

    A hub is met by partial aggregates and by joins of plain exchanges with one row on
    the other side, which adaptive execution may split. Each round is written to a shared table.
    Null ends, self links and repeated links are ignored; no links, no rows.
    """
    one = links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    edges = materialise(one.where("a != b").distinct())
    given: list[DataFrame] = []
    while not edges.isEmpty():
        turn = F.lit(len(given))
        first = lambda c: F.struct(F.xxhash64(c, turn).alias("h"), F.col(c).alias("to"))  # noqa: E731, B023
        ends = edges.select(F.col("a").alias("v"), first("b").alias("n")).unionByName(edges.select(F.col("b").alias("v"), first("a").alias("n")))
        least = ends.groupBy("v").agg(F.min("n").alias("n"))
        own = F.struct(F.xxhash64("v", turn).alias("h"), F.col("v").alias("to"))
        given.append(materialise(least.select("v", F.least("n", own)["to"].alias("to"))))
        # The table of vertices is met by each end in turn: one row a link comes out of either join.
        left = edges.join(given[-1].select(F.col("v").alias("a"), F.col("to").alias("x")), "a").select("x", "b")
        both = left.join(given[-1].select(F.col("v").alias("b"), F.col("to").alias("y")), "b")
        edges = materialise(both.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if not given:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("label"))
    ways = given.pop()
    while given:
        on = ways.select(F.col("v").alias("to"), F.col("to").alias("end"))
        ways = materialise(given.pop().join(on, "to", "left").select("v", F.coalesce("end", "to").alias("to")))
    least = ways.groupBy("to").agg(F.min("v").alias("label"))
    return materialise(ways.join(least.hint("rebalance"), "to").select("v", "label"))

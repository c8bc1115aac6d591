"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.stages import staged


def components(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, root): the smallest node that each node of ``links`` (a, b) is
    connected with.  Nodes are any orderable type; null nodes are ignored.

    Alternates two steps until nothing changes: every node's larger
    neighbours are linked to its smallest neighbour, then its smaller ones
    are.  Both keep connectivity, and links never multiply: a round writes at
    most as many links as it reads, so a hub needs no special case.  Each
    round is a table on the shared folder, so lineage stays short.
    """
    edges = staged(links.select("a", "b").where("a <> b")
                   .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                   "links")
    for _ in range(max_rounds):
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = staged(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .distinct(), "links-large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = staged(large.join(low, "a").where("b <> m")
                       .select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .union(low.select("a", F.col("m").alias("b"))).distinct(), "links-small")
        if _same(edges, small):
            return small.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                small.select("b", "b").distinct())
        edges = small
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")


def _same(x: DataFrame, y: DataFrame) -> bool:
    """Whether two tables of distinct links are equal, by count and checksum."""
    def sums(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return sums(x) == sums(y)

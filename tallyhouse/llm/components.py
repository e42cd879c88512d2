"""Connected components of a graph given as edges, by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.plans.shared import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the least node around."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lesser neighbours are tied to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Columns ``node`` and ``root``, the least node it can reach, for all nodes with an edge.

    ``edges`` has two ``bigint`` columns ``a`` and ``b``; direction, repeats and loops do not
    matter, and loops alone make no node. Large-star and small-star rounds (Kiveris et al.,
    SoCC 2014) end in stars after a number of rounds that grows with the logarithm of the
    nodes; each round is written to the shared folder, so lost executors cost one round.
    """
    current = written(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    mark = None
    while True:
        row = current.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"),
        ).first()
        if (row["n"], row["sum"]) == mark or not row["n"]:
            break
        mark = (row["n"], row["sum"])
        current = written(_small_star(_large_star(current)), "edges")
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

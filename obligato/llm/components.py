"""Connected components of a large graph by repeated contraction."""

from pyspark.sql import DataFrame, functions as F

from obligato.llm.common import materialized


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node in edges (u, v: long).

    Each round every node points to its smallest neighbour or itself and the edges are redrawn
    between the nodes pointed to; a round at least halves each component, so rounds grow with the
    logarithm of its size. Only minima are gathered per node, before the shuffle already, so a node with
    very many neighbours is no burden. Each round is checkpointed. Loops, repeated edges and no edges are fine.
    """
    rounds = []
    edges = edges.where("u <> v").select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e"))
    edges = materialized(edges.select("e.u", "e.v").distinct())
    while not edges.isEmpty():
        to = materialized(edges.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("to")))
        rounds.append(to)
        left, right = to.select("u", F.col("to").alias("a")), to.select(F.col("u").alias("v"), F.col("to").alias("b"))
        edges = materialized(edges.join(left, "u").join(right, "v").where("a <> b").select(
            F.col("a").alias("u"), F.col("b").alias("v")).distinct())
    if not rounds:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    found = rounds[0].select(F.col("u").alias("node"), F.col("to").alias("component"))
    for to in rounds[1:]:
        found = found.join(to.withColumnRenamed("u", "component"), "component", "left").select(
            "node", F.coalesce("to", "component").alias("component"))
    return found

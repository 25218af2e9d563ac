"""Connected components of a graph given by its edges, as DataFrame joins with written rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.session import shared_path


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in (a, b): the least node that it is connected with.

    Each round every node points to its least neighbour. Two steps along these pointers never lead
    upwards, so they only close in pairs, and the lesser of a pair is the least node of its tree: all
    of the tree is contracted into it. Every tree has two nodes or more, so at least half of the nodes
    go in each round, whatever their order; the rounds end when no edge is left. What a round leaves
    is written to the shared folder.
    """
    spark = edges.sparkSession
    base = shared_path(spark, "components", unique=True)

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    def step(name: str, pointers: DataFrame) -> DataFrame:
        return pointers.select(F.col("node").alias(name), F.col("label").alias(f"{name}_next"))

    one_way = edges.where("a <> b").select("a", "b")
    both = written(one_way.unionByName(one_way.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges-0")
    rounds: list[DataFrame] = []
    while not both.isEmpty():
        k = len(rounds) + 1
        least = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")), f"least-{k}")
        # The lesser of a pair that points to each other is the root.
        back = least.select(F.col("node").alias("least"), F.col("least").alias("back"))
        root = (F.col("back") == F.col("node")) & (F.col("node") < F.col("least"))
        roots = written(least.join(back, "least").select("node", F.when(root, F.col("node")).otherwise(F.col("least")).alias("label")),
                        f"roots-{k}-0")
        jumps, moving = 0, True
        while moving:  # three steps become one
            jumps += 1
            far = roots.join(step("label", roots), "label").join(step("label_next", roots), "label_next")
            far = written(far.select("node", F.col("label_next_next").alias("label"),
                                     (F.col("label_next") != F.col("label_next_next")).alias("moving")), f"roots-{k}-{jumps}")
            moving = not far.where("moving").isEmpty()
            roots = far.select("node", "label")
        rounds.append(roots)
        both = written(both.join(step("a", roots), "a").join(step("b", roots), "b").where("a_next <> b_next")
                       .select(F.col("a_next").alias("a"), F.col("b_next").alias("b")).distinct(), f"edges-{k}")
    if not rounds:
        return both.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = rounds.pop()
    while rounds:  # each round's nodes by way of the next one's
        roots = rounds.pop()
        labels = roots.join(step("label", labels), "label", "left").select("node", F.coalesce("label_next", "label").alias("label"))
        labels = written(labels, f"labels-{len(rounds)}")
    return labels

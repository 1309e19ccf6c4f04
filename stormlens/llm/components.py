"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormlens.llm.storage import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of every node (large: the greater ones, small: the lesser ones and
    the node itself) with the least among the node and its neighbours."""
    if large:
        around = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        out = around.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        around = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = around.groupBy("u").agg(F.min("v").alias("m"))
        joined = around.join(least, "u")
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(joined.select("u", "m"))
    return out.filter("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the two-column edge table; root is the component's least
    node. The hot spots of a star (a node with very many neighbours) are met by aggregates
    with partial sums and by joins that Spark can split. Every round is written to the shared
    folder, so lineage stays short."""
    now = materialise(edges.toDF("a", "b").filter("a <> b")
                      .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        now = materialise(_star(_star(now, True), False), "edges")
        check = now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if tuple(check) == state:
            break
        state = tuple(check)
    tops = now.select(F.col("b").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(tops).distinct()

"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.tables import stored


def _star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours go to its smallest one, then each node with all its
    smaller ones to the smallest of them. Only minima are gathered for a node, so a node
    with very many links is no single task's work."""
    hi, lo = F.col("hi"), F.col("lo")
    ways = F.array(F.struct(hi.alias("node"), lo.alias("next")), F.struct(lo.alias("node"), hi.alias("next")))
    both = edges.select(F.inline(ways))
    least = both.groupBy("node").agg(F.min("next").alias("root"))
    large = (
        both.where("next > node")
        .join(least, "node")
        .select(F.col("next").alias("hi"), F.least("node", "root").alias("lo"))
        .distinct()
    )
    least = large.groupBy("hi").agg(F.min("lo").alias("root"))
    met = F.array(F.struct(hi, F.col("root").alias("lo")), F.struct(lo.alias("hi"), F.col("root").alias("lo")))
    return large.join(least, "hi").select(F.inline(met)).where("hi <> lo").distinct()


def components(links: DataFrame, a: str, b: str, passes: int | None = None) -> DataFrame:
    """``(node, component)`` for every node that has a link; the component is its smallest node.

    Links may be repeated, in any direction, or lead to their own start; nulls are dropped.
    After a number of ``passes`` nodes with the same label are connected, but some connected
    ones may still have different labels; None goes on until they have not.
    """
    edges = (
        links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") > F.col("lo")))
        .distinct()
    )
    edges = stored(edges, "edges")
    if passes is not None:
        for _ in range(passes):
            edges = stored(_star(edges), "edges")
        labels = edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("component"))
        roots = edges.select(F.col("lo").alias("node")).distinct()
        roots = roots.join(labels.select("node"), "node", "left_anti")
        return labels.unionByName(roots.withColumn("component", F.col("node")))
    mark = [F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))]
    before = edges.agg(*mark).first()
    while True:
        edges = stored(_star(edges), "edges")
        now = edges.agg(*mark).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("lo").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)

"""Connected components by smallest-label propagation, and what is derived from them.

A round contracts the graph: every vertex points to the smallest vertex around it, pointers are doubled, edges are
rewritten between the vertices pointed to and made distinct. Each round is written to the shared folder and read
back, so plans stay short and lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch


def components(vertices: DataFrame, edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(id, component): the smallest id connected to each vertex. Edges (a, b) to no vertex, loops and nulls are ignored."""
    scratch = scratch or Scratch(vertices.sparkSession)
    ids = vertices.where("id IS NOT NULL").select("id").distinct()
    known = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    known = known.join(ids.withColumnRenamed("id", "a"), "a", "left_semi").join(ids.withColumnRenamed("id", "b"), "b", "left_semi")
    left = scratch.keep(known.select("a", "b"))
    maps: list[DataFrame] = []
    while not left.isEmpty():
        both = left.select(F.col("a").alias("v"), F.col("b").alias("w")).union(left.select("b", "a"))
        point = scratch.keep(both.groupBy("v").agg(F.least(F.min("w"), F.col("v")).alias("p")))
        up = point.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        to = scratch.keep(point.join(up, "p").select("v", F.col("pp").alias("to")))
        maps.append(to)
        a, b = to.select(F.col("v").alias("a"), F.col("to").alias("x")), to.select(F.col("v").alias("b"), F.col("to").alias("y"))
        moved = left.join(a, "a").join(b, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        then = scratch.keep(moved.distinct())
        scratch.drop(left)
        left = then
    total = None
    for to in reversed(maps):
        if total is None:
            total = to
        else:
            later = total.select(F.col("v").alias("to"), F.col("to").alias("end"))
            total = to.join(later, "to", "left").select("v", F.coalesce("end", "to").alias("to"))
    if total is None:
        return ids.select("id", F.col("id").alias("component"))
    labels = scratch.keep(total)
    least = labels.groupBy("to").agg(F.least(F.min("v"), F.first("to")).alias("component"))
    named = labels.join(least, "to").select(F.col("v").alias("id"), "component")
    return ids.join(named, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def group_members(labels: DataFrame) -> DataFrame:
    """(component, members): every id of a component in code-point order."""
    return labels.groupBy("component").agg(F.sort_array(F.collect_set("id")).alias("members"))

"""Consolidating pairwise matches into groups.

Method: deterministic Borůvka hooking. In each round every component selects its smallest outgoing edge; edges are
ordered by (smaller label, larger label), so the selected edges form trees with one two-cycle each, which is cut at
its smaller label. The trees collapse by pointer doubling; the edges are relabelled to the roots, loops go, repeated
edges are one edge, until none remain. At least half of the components disappear per round.

A component's labels are the labels of its former components, so the map of a round is as large as the components
it began with, and the final labels are the maps composed from the last to the first. The smallest member is found
once at the end. Hubs do no harm: selecting and relabelling are aggregations and joins on a unique side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, ship


def _roots(chosen: DataFrame, scratch: Scratch) -> DataFrame:
    """(v, root) from the edges (v, lo, hi) that components chose."""
    to = F.when(F.col("v") == F.col("lo"), F.col("hi")).otherwise(F.col("lo"))
    hook = chosen.select("v", to.alias("p"))
    back = hook.select(F.col("v").alias("p"), F.col("p").alias("pp"))
    own = (F.col("pp") == F.col("v")) & (F.col("v") < F.col("p"))
    now = scratch.keep(hook.join(back, "p").select("v", F.when(own, F.col("v")).otherwise(F.col("p")).alias("p")))
    while True:
        up = now.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        then = scratch.keep(now.join(up, "p").select("v", F.col("pp").alias("p"), (F.col("p") != F.col("pp")).alias("moved")))
        scratch.drop(now)
        now = then
        if now.where("moved").isEmpty():
            return now.select("v", F.col("p").alias("root"))


def connected_sets(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(id, group_id) of every vertex with an edge to another; group_id is the smallest id of its connected set.

    edges: a, b of one type; other columns are ignored. Edges with a null end and loops connect nothing; repeats and
    directions do not matter. No edges give no rows.
    """
    ship(edges.sparkSession)
    scratch = scratch or Scratch(edges.sparkSession)
    left = scratch.keep(edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct())
    maps = []
    while not left.isEmpty():
        edge = F.struct("lo", "hi")
        ends = left.select(F.col("lo").alias("v"), edge.alias("e")).union(left.select(F.col("hi"), edge))
        chosen = ends.groupBy("v").agg(F.min("e").alias("e")).select("v", "e.lo", "e.hi")
        to = _roots(chosen, scratch)
        maps.append(to)
        lo, hi = to.select(F.col("v").alias("lo"), F.col("root").alias("x")), to.select(F.col("v").alias("hi"), F.col("root").alias("y"))
        moved = left.join(lo, "lo").join(hi, "hi").where("x <> y")
        then = scratch.keep(moved.select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")).distinct())
        scratch.drop(left)
        left = then
    if not maps:
        return left.select(F.col("lo").alias("id"), F.col("hi").alias("group_id"))
    total = maps.pop()
    while maps:
        earlier = maps.pop()
        later = total.select(F.col("v").alias("root"), F.col("root").alias("end"))
        total = earlier.join(later, "root", "left").select("v", F.coalesce("end", "root").alias("root"))
    named = scratch.keep(total)
    least = named.groupBy("root").agg(F.min("v").alias("group_id"))
    return named.join(least, "root").select(F.col("v").alias("id"), "group_id")


def row_links(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """(a, b): links of rows and matched pairs, both of whose ends are rows."""
    ids = rows.where("id IS NOT NULL").select("id").distinct()
    links = rows.select(F.col("id").alias("a"), F.explode("links").alias("b"))
    both = links.unionByName(matches.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))).where("a <> b")
    both = both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return both.join(ids.select(F.col("id").alias("a")), "a", "left_semi").join(ids.select(F.col("id").alias("b")), "b", "left_semi")


def row_groups(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """(id, group_id) of every row connected to another over links and matched pairs, at any similarity.

    rows: id, links; matches: id_a, id_b. Ends that are no row, nulls, loops and repeats connect nothing.
    """
    return connected_sets(row_links(rows, matches))

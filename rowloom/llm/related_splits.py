"""Splits that keep related records together.

Method: distributed union-find with local forests merged hierarchically, then greedy largest-first assignment.

1. Each task runs union-find over the edges it reads and keeps one edge from each vertex to its tree's root.
2. The forests are merged level by level: a level deals the edges by the hash of their vertices to a `fan_in`-th as
   many tasks, each of which runs union-find again. Levels end when a task would hold more than `task_edges` edges.
   Unless one task then holds everything in one forest, what is still not joined is finished by
   `groups.connected_sets` over the forests, so no task and no driver ever holds all of an unbounded graph.
3. Sets are dealt to splits largest first, each to the split furthest below its target. Sets of the same size and
   scope are interchangeable, so the driver deals counts per size (at most sqrt(2 rows) sizes exist, each with and
   without a row that must go to test), and each set gets its split from its rank among the sets of its size.
"""

from __future__ import annotations

import math
from bisect import bisect_right

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch, ship
from .groups import connected_sets

FAN_IN, TASK_EDGES = 4, 1_000_000
TEST, GAME_SPECIFIC = "test", "game_specific"


class Forest:
    """Union-find with path halving; the root of a tree is its smallest vertex."""

    def __init__(self):
        self.up: dict[str, str] = {}

    def find(self, v: str) -> str:
        up = self.up
        if v not in up:
            up[v] = v
            return v
        while (p := up[v]) != v:
            up[v] = v = up[p]
        return v

    def union(self, a: str, b: str) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def edges(self) -> tuple[list[str], list[str]]:
        vs = [v for v in self.up if self.find(v) != v]
        return vs, [self.find(v) for v in vs]


def local_forests(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """(a, b, part): in place of each task's edges, an edge from every vertex to the root of its tree there. A task
    that comes to hold more than `task_edges` vertices writes its forest out and begins another, the next part."""

    def table(forest: Forest, part: int) -> pd.DataFrame:
        a, b = forest.edges()
        return pd.DataFrame({"a": a, "b": b}, dtype="object").assign(part=part)

    def run(batches):
        forest, part = Forest(), 0
        for batch in batches:
            for a, b in zip(batch["a"], batch["b"]):
                forest.union(a, b)
            if len(forest.up) > task_edges:
                yield table(forest, part)
                forest, part = Forest(), part + 1
        yield table(forest, part)

    return edges.select("a", "b").mapInPandas(run, "a string, b string, part int")


def merged_forests(edges: DataFrame, scratch: Scratch, fan_in: int = FAN_IN, task_edges: int = TASK_EDGES) -> tuple[DataFrame, bool]:
    """Forest edges (a, b) after local forests and their hierarchical merges, which have the edges' components; and
    whether the last level was one forest, so that each b is the smallest vertex of its component."""
    now = scratch.keep(local_forests(edges, task_edges))
    tasks = now.rdd.getNumPartitions()
    n = now.count()
    tasks = max(1, min(tasks, math.ceil(4 * n / task_edges)))
    while n:
        then = scratch.keep(local_forests(now.repartition(tasks, "b"), task_edges))
        scratch.drop(now)
        now = then
        n, parts = now.agg(F.count("*"), F.max("part")).first()
        if tasks == 1 or n * fan_in > task_edges * tasks:
            return now, tasks == 1 and not parts
        tasks = math.ceil(tasks / fan_in)
    return now, True


def relation_edges(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): what ties rows together. A group_key ties the rows that carry it and the row it names; group_members
    tie a row to the rows they name. Lists that several rows repeat are taken apart once."""
    ids = rows.where("id IS NOT NULL").select("id").distinct()
    keys = rows.where("id IS NOT NULL AND trim(group_key) <> ''").select(F.col("id").alias("a"), F.col("group_key").alias("b"))
    # Lists are one list where their SHA-256 is the same.
    listed = rows.where("id IS NOT NULL AND size(group_members) > 0").select("id", "group_members", F.unhex(F.sha2(F.to_json("group_members"), 256)).alias("h"))
    lists = listed.groupBy("h").agg(F.first("group_members").alias("group_members"))
    one = lists.select("h", F.explode("group_members").alias("b")).where("b IS NOT NULL").distinct()
    named = one.join(ids.select(F.col("id").alias("b")), "b", "left_semi")
    # A list ties its carriers to each other only over a row it names: all carriers hang on one of its named rows.
    anchor = named.groupBy("h").agg(F.min("b").alias("b"))
    carriers = listed.select("id", "h").distinct().join(anchor, "h").select(F.col("id").alias("a"), "b")
    within = named.join(anchor.withColumnRenamed("b", "a"), "h").select("a", "b")
    return scratch.keep(keys.unionByName(carriers).unionByName(within).where("a <> b"))


def related_sets(rows: DataFrame, fan_in: int = FAN_IN, task_edges: int = TASK_EDGES, scratch: Scratch | None = None) -> DataFrame:
    """(id, set_id) of every row; set_id is the smallest row id of its set, the row's own if nothing is related.

    rows: id, group_key, group_members. Nulls, blanks and member ids that are no row relate nothing; a group_key that
    is no row's id relates the rows that carry it. Rows without an id are left out; a repeated row counts once.
    """
    ship(rows.sparkSession)
    scratch = scratch or Scratch(rows.sparkSession)
    ids = rows.where("id IS NOT NULL").select("id").distinct()
    edges = relation_edges(rows, scratch)
    forest, whole = merged_forests(edges, scratch, fan_in, task_edges)
    if not whole:
        forest = connected_sets(forest, scratch).select(F.col("id").alias("a"), F.col("group_id").alias("b"))
    tied = ids.join(forest.select(F.col("a").alias("id"), F.col("b").alias("root")), "id", "left")
    tied = scratch.keep(tied.select("id", F.coalesce("root", "id").alias("root")))
    # A root may be a group_key that is no row: the set is named after its smallest row.
    names = tied.groupBy("root").agg(F.min("id").alias("set_id"))
    return tied.join(names, "root").select("id", "set_id")


def torn_sets(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(set_id, id): every row of a set whose rows have two or more different splits; null splits do not count."""
    splits = rows.where("id IS NOT NULL").select("id", "split").distinct()
    spread = sets.join(splits, "id").groupBy("set_id").agg(F.min("split").alias("lo"), F.max("split").alias("hi")).where("lo <> hi")
    return sets.join(spread.select("set_id"), "set_id", "left_semi").select("set_id", "id")


def deal(sizes: list[tuple[int, bool, int]], shares: dict[str, float], rows: int) -> dict[tuple[int, bool], list[tuple[str, int]]]:
    """For each (size, to_test) the splits and numbers of its sets, in the order of their ranks.

    Greedy, largest first: every set goes to the split furthest below its target. Sets that must go to test are dealt
    first. Within one size the splits that are furthest below by less than one set take turns, so they are dealt the
    same number at once, until the next split's level is met.
    """
    total = sum(shares.values()) or 1.0
    want = {s: rows * p / total for s, p in sorted(shares.items())}
    out: dict[tuple[int, bool], list[tuple[str, int]]] = {}
    for size, fixed, n in sorted(sizes, key=lambda x: (not x[1], -x[0])):
        runs = out.setdefault((size, fixed), [])
        if fixed and TEST in want:
            runs.append((TEST, n))
            want[TEST] -= n * size
            continue
        while n:
            order = sorted(want, key=lambda s: (-want[s], s))
            near = [s for s in order if want[order[0]] - want[s] < size]
            below = want[order[len(near)]] if len(near) < len(order) else -math.inf
            room = (want[near[-1]] - below) // size
            each = max(1, int(min(n // len(near), room)))
            for split in near[:n]:
                runs.append((split, each))
                want[split] -= each * size
                n -= each
    return out


def assigned_splits(rows: DataFrame, plan: DataFrame, sets: DataFrame | None = None, salts: int = 64) -> DataFrame:
    """(id, set_id, split): a split for every row, near the plan's shares, no set in two splits.

    plan: split, proportion; rows with a null or a proportion below zero are ignored, an empty plan is refused.
    Sets with a game_specific row go to test.
    """
    scratch = Scratch(rows.sparkSession)
    shares = {r.split: r.p for r in plan.where("split IS NOT NULL AND proportion >= 0").groupBy("split").agg(F.sum("proportion").alias("p")).collect()}
    if not shares:
        raise ValueError("the split plan names no split")
    sets = scratch.keep(related_sets(rows) if sets is None else sets)
    special = rows.where(F.col("scope") == GAME_SPECIFIC).select("id").distinct().withColumn("special", F.lit(1))
    of_set = sets.join(special, "id", "left").groupBy("set_id").agg(F.count("*").alias("size"), F.count("special").alias("special"))
    known = scratch.keep(of_set.select("set_id", "size", (F.col("special") > 0).alias("fixed"), F.pmod(F.xxhash64("set_id"), F.lit(salts)).alias("salt")))
    # Ranks within a size: offsets of its salts, then a row number in each, so no task ranks all sets of one size.
    per = scratch.keep(known.groupBy("size", "fixed", "salt").agg(F.count("*").alias("n")))
    before = Window.partitionBy("size", "fixed").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offset = per.select("size", "fixed", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("at"))
    counts = {(r["size"], r["fixed"]): r["n"] for r in per.groupBy("size", "fixed").agg(F.sum("n").alias("n")).collect()}
    runs = deal([(s, f, n) for (s, f), n in counts.items()], shares, sum(s * n for (s, _), n in counts.items()))
    ends = {}
    for key, dealt in runs.items():
        at, ends[key] = 0, ([], [])
        for split, n in dealt:
            ends[key][0].append(at)
            ends[key][1].append(split)
            at += n
    return _placed(known, offset, ends, sets)


def _placed(known: DataFrame, offset: DataFrame, starts: dict[tuple[int, bool], tuple[list[int], list[str]]], sets: DataFrame) -> DataFrame:
    """The split of every set by its rank among those of its size: `starts` has the ranks at which a split begins."""
    order = Window.partitionBy("size", "fixed", "salt").orderBy("set_id")
    ranked = known.withColumn("nth", F.row_number().over(order)).join(offset, ["size", "fixed", "salt"])

    @F.pandas_udf("string")
    def split_of(size: pd.Series, fixed: pd.Series, rank: pd.Series) -> pd.Series:
        out = []
        for s, f, r in zip(size, fixed, rank):
            at, names = starts[int(s), bool(f)]
            out.append(names[bisect_right(at, r) - 1])
        return pd.Series(out, dtype="object")

    splits = ranked.select("set_id", split_of("size", "fixed", F.col("at") + F.col("nth") - 1).alias("split"))
    return sets.join(splits, "set_id").select("id", "set_id", "split")

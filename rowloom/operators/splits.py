"""Scenario edges, groups and the split rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import in_share
from ..session import Scratch
from .components import components

SPLITS = ("train", "val", "test")


def link_edges(records: DataFrame, ids: DataFrame) -> DataFrame:
    """(a, b): links of `records` (id, links) to known ids."""
    links = records.select(F.col("id").alias("a"), F.explode("links").alias("b")).where("b IS NOT NULL").distinct()
    return links.join(ids.select(F.col("id").alias("b")).distinct(), "b", "left_semi").select("a", "b")


def dangling_links(records: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, link): links to ids that no record has; they are ignored, with a warning."""
    links = records.select("id", F.explode("links").alias("link")).where("link IS NOT NULL").distinct()
    return links.join(ids.select(F.col("id").alias("link")).distinct(), "link", "left_anti").select("id", "link")


def configured_edges(groups: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (a, b) of configured groups (group_no, members), and (group_no, unknown) of those that name an unknown id;
    one unknown id refuses its whole group."""
    named = groups.select("group_no", F.posexplode("members").alias("pos", "id"))
    seen = named.join(ids.select("id").distinct().withColumn("known", F.lit(True)), "id", "left")
    state = seen.groupBy("group_no").agg(
        F.sort_array(F.collect_list(F.when(F.col("known").isNull(), F.col("id")))).alias("unknown"), F.min("id").alias("first")
    )
    good = state.where(F.size("unknown") == 0)
    edges = seen.join(good.select("group_no", "first"), "group_no").where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    return edges, state.where(F.size("unknown") > 0).select("group_no", "unknown")


def scenario_groups(records: DataFrame, *edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(id, group_key): the smallest id of each record's scenario, over links and any further edges (a, b)."""
    ids = records.select("id")
    both = link_edges(records, ids)
    for e in edges:
        both = both.unionByName(e.select("a", "b"))
    return components(ids, both, scratch).select("id", F.col("component").alias("group_key"))


def assign_splits(rows: DataFrame, val_share: float, seed: object = 0) -> DataFrame:
    """Rows (id, scope, group_key, has_target) with `split`: game_specific rows are the test set; a group with a row
    that has no target, or drawn by the hash of its key, is validation; every other is training."""
    held = rows.groupBy("group_key").agg(F.bool_or(~F.col("has_target")).alias("held"))
    drawn = in_share(F.col("group_key"), seed, val_share)
    split = F.when(F.col("scope") == "game_specific", "test").when(F.col("held") | drawn, "val").otherwise("train")
    return rows.join(held, "group_key").withColumn("split", split).drop("held")


def straddling_groups(rows: DataFrame) -> DataFrame:
    """(group_key, splits): groups whose rows are in two or more splits."""
    seen = rows.where("split IS NOT NULL AND group_key IS NOT NULL").groupBy("group_key").agg(F.sort_array(F.collect_set("split")).alias("splits"))
    return seen.where(F.size("splits") > 1)


def split_sizes(rows: DataFrame) -> DataFrame:
    """(split, n, first_id, last_id)."""
    return rows.where("split IS NOT NULL").groupBy("split").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def moved_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """(id, was, now): rows whose split differs between two runs."""
    pair = before.select("id", F.col("split").alias("was")).join(after.select("id", F.col("split").alias("now")), "id")
    return pair.where("was <> now")

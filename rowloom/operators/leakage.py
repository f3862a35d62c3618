"""Rows that a model was trained on, rows related to these, and what remains to be scored.

`trained` knows a training row by id or by input. The relatives are a fixed chain of joins, not a fixpoint:
siblings of trained rows today, rows tied to anything that belonged to a trained scenario when it was trained, rows
whose text is near a training text, and the siblings of all of these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .similarity import similar_classes


def trained(rows: DataFrame, train_ids: DataFrame, train_keys: DataFrame | None = None) -> DataFrame:
    """(id) of rows (id, fingerprint) whose id or fingerprint is among the training rows'."""
    by_id = rows.select("id").join(train_ids.select("id").distinct(), "id", "left_semi")
    if train_keys is None:
        return by_id.distinct()
    by_key = rows.join(train_keys.select("fingerprint").distinct(), "fingerprint", "left_semi").select("id")
    return by_id.union(by_key).distinct()


def _siblings(rows: DataFrame, some: DataFrame) -> DataFrame:
    groups = rows.join(some, "id", "left_semi").select("group_key").where("group_key IS NOT NULL").distinct()
    return rows.join(groups, "group_key", "left_semi").select("id")


def scenario_ids(rows: DataFrame) -> DataFrame:
    """(id): every id that rows belong to: their own, their members and their links."""
    named = rows.select(F.explode(F.array_union(F.coalesce("links", F.array()), F.coalesce("group_members", F.array()))).alias("id"))
    return rows.select("id").union(named).where("id IS NOT NULL").distinct()


def training_relatives(
    rows: DataFrame, trained_ids: DataFrame, historical: DataFrame, train_texts: DataFrame | None = None, threshold: float | None = None
) -> DataFrame:
    """(id): rows that are related to a training row without being one.

    rows: id, group_key, links, group_members, text; historical: id, all ids of trained scenarios; train_texts: text.
    No threshold or no texts leave the similarity step out.
    """
    others = rows.join(trained_ids, "id", "left_anti")
    related = _siblings(rows, trained_ids)
    named = others.select("id", F.explode(F.concat(F.array("id"), F.coalesce("links", F.array()), F.coalesce("group_members", F.array()))).alias("other"))
    related = related.union(named.join(historical.select(F.col("id").alias("other")).distinct(), "other", "left_semi").select("id"))
    if threshold is not None and train_texts is not None:
        keyed = others.select(F.concat(F.lit("r"), "id").alias("id"), "text", F.lit(0).alias("side"))
        seen = train_texts.select("text").distinct().select(F.concat(F.lit("t"), F.sha2("text", 256)).alias("id"), "text", F.lit(1).alias("side"))
        members, linked = similar_classes(keyed.unionByName(seen), threshold, sides=True)
        # Classes that a training text is in or linked to; no pair is made.
        trained = members.where("side = 1").select("content").distinct()
        both = linked.select(F.col("ca").alias("content"), F.col("cb").alias("at")).union(linked.select("cb", "ca"))
        near = both.join(trained, "content", "left_semi").select(F.col("at").alias("content")).union(trained)
        related = related.union(members.where("side = 0").join(near, "content", "left_semi").select(F.expr("substring(id, 2)")))
    related = related.distinct()
    return related.union(_siblings(rows, related)).distinct().join(trained_ids, "id", "left_anti")


def held_out(rows: DataFrame, trained_ids: DataFrame, related: DataFrame) -> DataFrame:
    """Rows that are neither trained on nor related."""
    return rows.join(trained_ids.select("id").union(related.select("id")).distinct(), "id", "left_anti")


def excluded(rows: DataFrame, trained_ids: DataFrame, related: DataFrame) -> DataFrame:
    """(reason, id): every excluded row with its reason; a row that was trained on is not listed as related."""
    a = rows.join(trained_ids, "id", "left_semi").select(F.lit("trained").alias("reason"), "id")
    b = rows.join(trained_ids, "id", "left_anti").join(related, "id", "left_semi").select(F.lit("related").alias("reason"), "id")
    return a.union(b)


def exclusions(rows: DataFrame, trained_ids: DataFrame, related: DataFrame) -> DataFrame:
    """(reason, n, first_id, last_id): how many rows are excluded for each reason, and the ends of their order by code point."""
    return excluded(rows, trained_ids, related).groupBy("reason").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))

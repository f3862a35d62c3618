"""Rows whose texts look the same but are stored with different characters.

Method: see `plainform`: quick-check properties isolate the unstable segments of a text, only those are
normalised (each with the one character before it) and spliced into the unchanged rest. Two texts look the same
when their plain forms are equal. Groups in which every text is stored alike are dropped before any pairing, so
exact copies cost nothing, however many there are.
"""

from __future__ import annotations

import json

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, ship
from .common import load_object, visible
from .plainform import plain, plain_column

ACTIONS = ("player_action", "observed_event")
FIELDS = ("similarity_text", "input")
EXPAND_LIMIT = 1000


def _digest(*parts: str) -> bytes:
    return xxhash.xxh3_128_digest("\x00".join(parts).encode("utf-8", "surrogatepass"))


def _value(v, form) -> str:
    return "s" + form(v) if isinstance(v, str) else "j" + json.dumps(v, sort_keys=True)


def input_forms(text: str | None) -> tuple[bytes, bytes] | None:
    """Digests of how an input looks and of how its scene and action are stored; None without scene and action."""
    o = load_object(text)
    acts = [a for a in ACTIONS if a in o]
    if "scene" not in o and not acts:
        return None
    state = json.dumps(o["runtime_state"], sort_keys=True) if "runtime_state" in o else "absent"
    said = [o.get("scene"), *(o[a] for a in acts)]
    looks = _digest("input", *acts, state, *(_value(v, plain) for v in said))
    return looks, _digest(*(_value(v, str) for v in said))


def looks_of(rows: DataFrame) -> DataFrame:
    """(field, looks, stored, id): one row per text of a row; digests of its plain form and of its characters."""

    def run(batches):
        for b in batches:
            out = []
            for i, t, j in zip(b["id"], b["similarity_text"], b["input_json"]):
                if t is not None:
                    out.append((FIELDS[0], _digest("text", plain(t)), _digest(t), i))
                if forms := input_forms(j):
                    out.append((FIELDS[1], *forms, i))
            yield pd.DataFrame(out, columns=["field", "looks", "stored", "id"])

    seen = visible(F.col("similarity_text"))
    picked = rows.where("id IS NOT NULL").select("id", F.when(seen, F.col("similarity_text")).alias("similarity_text"), "input_json")
    return picked.mapInPandas(run, "field string, looks binary, stored binary, id string")


def same_looking_pairs(rows: DataFrame, expand_limit: int = EXPAND_LIMIT) -> DataFrame:
    """(field, id_a, id_b): two rows whose texts of that field have one plain form but different characters.

    rows: id, similarity_text, input_json. Null and blank similarity_text, inputs that are no JSON object and rows
    without an id take no part. A repeated row counts once. Pairs are formed between different stored forms only. More
    than `expand_limit` rows with one and the same stored text are exact copies: their smallest id stands for them in pairs
    with other forms, and each other one is paired with the smallest id of every form that looks like theirs.
    """
    ship(rows.sparkSession)
    scratch = Scratch(rows.sparkSession)
    looks = scratch.keep(looks_of(rows))
    varied = looks.groupBy("field", "looks").agg(F.min("stored").alias("lo"), F.max("stored").alias("hi")).where("lo <> hi")
    some = looks.join(varied.select("field", "looks"), ["field", "looks"], "left_semi").distinct()
    form = ["field", "looks", "stored"]
    forms = some.groupBy(*form).agg(F.count("*").alias("n"), F.min("id").alias("rep"))
    large = scratch.keep(forms.where(F.col("n") > expand_limit).select(*form, "rep"))
    if large.isEmpty():
        return _differing(some, some, "id_a < id_b").select("field", "id_a", "id_b").distinct()
    standing = some.join(large, form, "left").where("rep IS NULL OR rep = id").drop("rep")
    rest = some.join(large, form).where("id <> rep").drop("rep")
    met = _differing(standing, standing, "id_a < id_b").unionByName(_differing(rest, forms.withColumnRenamed("rep", "id"), "true"))
    return met.select("field", F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).where("id_a <> id_b").distinct()


def _differing(xs: DataFrame, ys: DataFrame, where: str) -> DataFrame:
    """(field, id_a, id_b): a row of xs and one of ys that look the same and are stored differently."""
    a = xs.select("field", "looks", F.col("stored").alias("sa"), F.col("id").alias("id_a"))
    b = ys.select("field", "looks", F.col("stored").alias("sb"), F.col("id").alias("id_b"))
    return a.join(b, ["field", "looks"]).where(f"sa <> sb AND {where}").select("field", "id_a", "id_b")


def plain_texts(rows: DataFrame) -> DataFrame:
    """(id, plain_text, changed): every similarity_text in its one form; null stays null, a blank text is ''."""
    ship(rows.sparkSession)
    made = rows.select("id", "similarity_text", plain_column(F.col("similarity_text")).alias("plain_text"))
    return made.select("id", "plain_text", (~F.col("plain_text").eqNullSafe(F.col("similarity_text"))).alias("changed"))

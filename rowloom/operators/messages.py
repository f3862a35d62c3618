"""Texts of decisions and chats, encoding with masked prompts, padding and length rules."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import tokens

IGNORED = -100
# Fixed value: the note that goes with a decision the game has no request for.
ATTRIBUTE_NOTE = "single attribute check"
# What a difficulty means, in the words of the system message.
DIFFICULTY_WORDS = {"success": "a normal check, rolled under the full value", "hard": "under half the value", "extreme": "under a fifth of the value"}


def _quoted(col: Column) -> Column:
    """A JSON string literal with other than ASCII characters kept."""
    one = F.to_json(F.struct(col.alias("x")))
    return F.substring(one, F.lit(6), F.length(one) - F.lit(6))


def target_text(decision: Column) -> Column:
    """One line of JSON with keys in fixed order and a blank behind each comma and colon; null for null."""
    check = lambda c: F.concat(F.lit('{"kind": '), _quoted(c["kind"]), F.lit(', "name": '), _quoted(c["name"]), F.lit(', "difficulty": '), _quoted(c["difficulty"]), F.lit("}"))
    checks = F.array_join(F.transform(decision["checks"], check), ", ")
    return F.when(decision.isNotNull(), F.concat(F.lit('{"roll_required": '), decision["roll_required"].cast("string"), F.lit(', "checks": ['), checks, F.lit("]}")))


@F.pandas_udf(T.StringType())
def user_message(texts: pd.Series) -> pd.Series:
    """The input as one line of JSON in its own key order; null for null and for text that is no JSON."""

    def one(text):
        try:
            return json.dumps(json.loads(text), ensure_ascii=False)
        except (ValueError, RecursionError):
            return None

    return texts.map(one, na_action="ignore")


def system_message(skills: list[str], attributes: list[str], difficulties: list[str] = list(DIFFICULTY_WORDS)) -> str:
    """States the task, the reply's form and the names of the catalogue; an unknown difficulty is refused."""
    unknown = [d for d in difficulties if d not in DIFFICULTY_WORDS]
    if unknown or not difficulties:
        raise ValueError(f"no words for the difficulties {unknown}")
    levels = "; ".join(f"{d}: {DIFFICULTY_WORDS[d]}" for d in difficulties)
    return "\n".join(
        [
            "Choose the dice check for one moment of a game.",
            "Input: a JSON object with a scene and either player_action or observed_event, at times with runtime_state.",
            f"Difficulties: {levels}.",
            'Reply with one JSON object: {"roll_required": false, "checks": []} or {"roll_required": true, "checks": [{"kind", "name", "difficulty"}]}.',
            "Attributes: " + ", ".join(attributes),
            "Skills: " + ", ".join(skills),
        ]
    )


def chat(system: str, user: Column, target: Column) -> Column:
    """array<struct<role, content>>: system, user and, where there is a target, assistant."""
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    turns = F.array(turn("system", F.lit(system)), turn("user", user), turn("assistant", target))
    return F.filter(turns, lambda t: t["content"].isNotNull())


def game_request(decision: Column) -> dict[str, Column]:
    """skill, difficulty and note: a skill check is a request, an attribute check a note, no roll neither."""
    rolls = F.coalesce(decision["roll_required"], F.lit(False))
    check = F.get(decision["checks"], F.lit(0))
    is_skill = rolls & (check["kind"] == "skill")
    return {
        "skill": F.when(is_skill, check["name"]),
        "difficulty": F.when(is_skill, check["difficulty"]),
        "note": F.when(rolls & (check["kind"] == "attribute"), F.lit(ATTRIBUTE_NOTE)),
    }


def encoded(rows: DataFrame, encode: Callable[[list[str]], list[list[int]]], longest: int) -> DataFrame:
    """(id, ids, labels, fits): prompt and target as numbers, the prompt masked in the labels.

    rows: id, prompt, target. `encode` turns texts into numbers and is called once per batch and column in the workers.
    """

    def run(batches):
        for b in batches:
            prompts, targets = encode(b["prompt"].fillna("").tolist()), encode(b["target"].fillna("").tolist())
            ids = [p + t for p, t in zip(prompts, targets)]
            labels = [[IGNORED] * len(p) + t for p, t in zip(prompts, targets)]
            yield pd.DataFrame({"id": b["id"], "ids": ids, "labels": labels, "fits": [len(i) <= longest for i in ids]})

    return rows.select("id", "prompt", "target").mapInPandas(run, "id string, ids array<int>, labels array<int>, fits boolean")


def encoding_problems(
    rows: DataFrame, encode: Callable[[list[str]], list[list[int]]], decode: Callable[[list[list[int]]], list[str]], longest: int, context: int | None = None
) -> DataFrame:
    """(id, n, masked, problem): tokens of the whole conversation and of its prompt, and why it cannot be trained on; '' if it can.

    rows: id, prompt, whole, target, as the texts that a template renders. The prompt must be the beginning of the whole, as a
    text and as tokens, so that masking leaves out exactly the prompt; the target must come back from the other tokens.
    """

    def run(batches):
        for b in batches:
            prompts, wholes, targets = (b[c].fillna("").tolist() for c in ("prompt", "whole", "target"))
            heads, ids = encode(prompts), encode(wholes)
            said = decode([i[len(h) :] for h, i in zip(heads, ids)])
            told = []
            for p, w, t, h, i, s in zip(prompts, wholes, targets, heads, ids, said):
                rules = (
                    (w.startswith(p), "the prompt is rendered differently with the answer"),
                    (i[: len(h)] == h, "the prompt's tokens are no prefix"),
                    (t in s, "the target cannot be recovered"),
                    (len(i) <= longest, "too many tokens"),
                    (context is None or len(i) <= context, "beyond the context"),
                )
                told.append(next((why for holds, why in rules if not holds), ""))
            yield pd.DataFrame({"id": b["id"], "n": [len(i) for i in ids], "masked": [len(h) for h in heads], "problem": told})

    return rows.select("id", "prompt", "whole", "target").mapInPandas(run, "id string, n long, masked long, problem string")


def padded(batches: DataFrame, pad: int = 0) -> DataFrame:
    """Rows (batch, id, ids, labels) padded to the widest of their batch, with an attention mask."""
    width = batches.groupBy("batch").agg(F.max(F.size("ids")).alias("width"))
    wide = batches.join(width, "batch")
    gap = F.col("width") - F.size("ids")
    fill = lambda col, value: F.concat(F.col(col), F.array_repeat(F.lit(value), gap)).alias(col)
    mask = F.concat(F.transform("ids", lambda _: F.lit(1)), F.array_repeat(F.lit(0), gap)).alias("mask")
    return wide.select("batch", "id", fill("ids", pad), fill("labels", IGNORED), mask)


def length_stats(texts: DataFrame, *by: str) -> DataFrame:
    """(by, rows, longest, mean): tokens of `text`; 0 without rows, the mean to 1 place."""
    counted = texts.withColumn("n", F.size(tokens(F.col("text"))))
    return counted.groupBy(*by).agg(F.count("*").alias("rows"), F.coalesce(F.max("n"), F.lit(0)).alias("longest"), F.bround(F.avg("n"), 1).alias("mean"))


def too_long(texts: DataFrame, context: int, reply: int) -> DataFrame:
    """(id, tokens): texts whose tokens and the reply's exceed the context."""
    return texts.select("id", F.size(tokens(F.col("text"))).alias("tokens")).where(F.col("tokens") + reply > context)

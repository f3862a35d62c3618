"""Batched prediction by an injected model, strict parsing of replies, and validation of queries.

A predictor is a factory without arguments whose result has `reply(queries: list[dict]) -> list[str]` and maybe
`length_problem(query: dict) -> str | None`, why a query does not fit its context. It is made in the worker, when the
first valid query of a task arrives, so tasks without one load nothing.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.strictjson import Refused, decode
from ..session import ship
from .labels import Catalog
from .messages import game_request

ACTIONS = ("player_action", "observed_event")
STATE_DEPTH = 100
CHECK = "struct<kind: string, name: string, difficulty: string>"
DECISION = f"struct<roll_required: boolean, checks: array<{CHECK}>>"
PREDICTION = f"id string, valid boolean, decision {DECISION}, errors array<string>, raw_output string"
BAD_QUERY = "bad query: "


def _text_problem(value) -> str | None:
    try:
        value.encode("utf-8")
    except UnicodeEncodeError:
        return "holds an unpaired surrogate"
    return None


def _leaf_problem(value) -> str | None:
    match value:
        case None | bool():
            return None
        case str():
            return _text_problem(value)
        case float():
            return None if math.isfinite(value) else "is no finite number"
        case int():
            digits = sys.get_int_max_str_digits()
            return f"is an integer too long to write, of more than {digits} digits" if digits and abs(value) >= 10**digits else None
    return f"holds a {type(value).__name__}, which is not JSON"


def data_problem(value, where: str = "value", limit: int = STATE_DEPTH) -> str | None:
    """Why a Python value is not finite JSON data of bounded depth, naming the place; None if it is.

    Objects and lists are entered one by one: `open_ones` is the path down to the place that is looked at.
    """
    if not isinstance(value, (dict, list)):
        return f"{where} {bad}" if (bad := _leaf_problem(value)) else None
    open_ones = [(value, where, _members(value, where))]
    while open_ones:
        *_, (_, _, members) = open_ones
        member = next(members, None)
        if member is None:
            open_ones.pop()
            continue
        key_problem, inner, at = member
        if key_problem:
            return key_problem
        if not isinstance(inner, (dict, list)):
            if bad := _leaf_problem(inner):
                return f"{at} {bad}"
        elif any(inner is outer for outer, *_ in open_ones):
            return f"{at} contains itself"
        elif len(open_ones) >= limit:
            return f"{at} is nested more than {limit} levels deep"
        else:
            open_ones.append((inner, at, _members(inner, at)))
    return None


def _members(value: dict | list, at: str) -> Iterator[tuple[str | None, object, str]]:
    """(what is wrong with the key, member, its place) of an object or a list."""
    if isinstance(value, list):
        yield from ((None, v, f"{at}[{i}]") for i, v in enumerate(value))
        return
    for k, v in value.items():
        bad = "that is no string" if not isinstance(k, str) else _text_problem(k)
        yield f"{at} has a key {bad if bad is None or bad.startswith('that') else 'that ' + bad}" if bad else None, v, f"{at}.{k}"


def query_errors(query) -> list[str]:
    """Every reason why a query is not {scene, one action, runtime_state?}."""
    if not isinstance(query, dict):
        return ["the query is no object"]
    acts = [a for a in ACTIONS if a in query]
    out = [] if len(acts) == 1 else ["exactly one of player_action and observed_event is needed"]
    for key in ["scene", *(acts if len(acts) == 1 else [])]:
        v = query.get(key)
        if not isinstance(v, str) or not v.strip():
            out.append(f"{key} must be a text that is not blank")
        elif bad := _text_problem(v):
            out.append(f"{key} {bad}")
    if "runtime_state" in query:
        state = query["runtime_state"]
        bad = data_problem(state, "runtime_state") if isinstance(state, dict) else "runtime_state must be an object"
        out += [bad] if bad else []
    unknown = sorted(str(k) for k in query if k not in ("scene", "runtime_state", *ACTIONS))
    return out + ([f"unknown fields {unknown}"] if unknown else [])


def checked_queries(rows: DataFrame) -> DataFrame:
    """(id, errors): all problems of each input_json; none for a valid one."""

    def run(batches: Iterator[pd.DataFrame]):
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "errors": [_query(t)[1] for t in b["input_json"]]})

    ship(rows.sparkSession)
    return rows.select("id", "input_json").mapInPandas(run, "id string, errors array<string>")


def _query(text: str | None) -> tuple[dict | None, list[str]]:
    try:
        query = decode(text or "")
    except Refused as e:
        return None, [str(e)]
    errors = query_errors(query)
    return (None if errors else query), errors


def parse_reply(text: str | None, catalog: Catalog) -> tuple[dict | None, list[str]]:
    """(decision, []) of a reply that is exactly one decision with labels of the catalogue; else (None, reasons)."""
    try:
        said = decode((text or "").strip())
    except Refused as e:
        return None, [str(e)]
    if not isinstance(said, dict) or set(said) != {"roll_required", "checks"}:
        return None, ["an object with exactly roll_required and checks is needed"]
    rolls, checks = said["roll_required"], said["checks"]
    wrong = [m for bad, m in ((not isinstance(rolls, bool), "roll_required must be true or false"), (not isinstance(checks, list), "checks must be a list")) if bad]
    if wrong:
        return None, wrong
    if len(checks) != int(rolls):
        return None, [f"{len(checks)} checks with roll_required {str(rolls).lower()}"]
    for c in checks:
        if not isinstance(c, dict) or set(c) != {"kind", "name", "difficulty"}:
            return None, ["a check has exactly kind, name and difficulty"]
        names = {"attribute": catalog.attributes, "skill": catalog.rollable}.get(c["kind"] if isinstance(c["kind"], str) else "", ())
        if c["name"] not in names or c["difficulty"] not in catalog.difficulties:
            return None, [f"no label of the catalogue: {json.dumps(c, ensure_ascii=False)[:200]}"]
    return {"roll_required": rolls, "checks": checks}, []


def predictions(rows: DataFrame, predictor: Callable[[], object], catalog: Catalog, batch_size: int = 8) -> DataFrame:
    """A prediction per row (id, input_json), with what the game is asked for (game_request, note): queries that are
    invalid or too long are answered without generating."""

    def run(batches: Iterator[pd.DataFrame]):
        model = None
        for b in batches:
            read = [_query(t) for t in b["input_json"]]
            refused = {i: errors for i, (q, errors) in enumerate(read) if q is None}
            if model is None and len(refused) < len(read):
                model = predictor()
            if fits := getattr(model, "length_problem", None):
                refused |= {i: [why] for i, (q, _) in enumerate(read) if q is not None and (why := fits(q))}
            valid = [i for i in range(len(read)) if i not in refused]
            replies: dict[int, str] = {}
            for lo in range(0, len(valid), batch_size):
                some = valid[lo : lo + batch_size]
                replies.update(zip(some, model.reply([read[i][0] for i in some])))
            out = []
            for i, row_id in enumerate(b["id"]):
                decision, reasons = parse_reply(replies[i], catalog) if i in replies else (None, [BAD_QUERY + e for e in refused[i]])
                out.append((row_id, decision is not None, decision, reasons, replies.get(i)))
            yield pd.DataFrame(out, columns=["id", "valid", "decision", "errors", "raw_output"])

    ship(rows.sparkSession)
    said = rows.select("id", "input_json").mapInPandas(run, PREDICTION)
    asked = game_request(F.col("decision"))
    request = F.when(asked["skill"].isNotNull(), F.struct(asked["skill"].alias("skill"), asked["difficulty"].alias("difficulty")))
    return said.withColumn("game_request", request).withColumn("note", asked["note"])


class FixedReply:
    """A stub model: the same reply to every query."""

    def __init__(self, reply: str = '{"roll_required": false, "checks": []}'):
        self._reply = reply

    def reply(self, queries: list[dict]) -> list[str]:
        return [self._reply for _ in queries]



"""Strict JSON: a text is one JSON value, without repeated keys, non-finite numbers, unpaired surrogates or more than
MAX_DEPTH levels.

`problem` settles the usual text inside the JVM: the variant parser refuses repeated keys and constants, and the
guards look at the text without its string literals. Only texts that a guard cannot settle (a literal is long,
escaped oddly, or nested) go to a decoder in Python, in Arrow batches.
"""

from __future__ import annotations

import json
import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_DEPTH = 200


class Refused(ValueError):
    """A text that is not strict JSON."""


def _object(pairs: list[tuple]) -> dict:
    out = dict(pairs)
    if len(out) < len(pairs):
        count: dict = {}
        for k, _ in pairs:
            count[k] = count.get(k, 0) + 1
        raise Refused(f"repeated key {min(k for k, n in count.items() if n > 1)!r}")
    return out


def _number(text: str) -> float:
    value = float(text)
    if not math.isfinite(value):
        raise Refused(f"number {text[:20]} is out of range")
    return value


def _constant(text: str):
    raise Refused(f"{text} is no JSON")


def _levels(text: str) -> int:
    """Deepest nesting of objects and lists of a valid JSON text."""
    deepest = depth = 0
    quoted = escaped = False
    for c in text:
        if quoted:
            if escaped:
                escaped = False
            elif c == "\\":
                escaped = True
            elif c == '"':
                quoted = False
        elif c == '"':
            quoted = True
        elif c in "[{":
            depth += 1
            deepest = max(deepest, depth)
        elif c in "]}":
            depth -= 1
    return deepest


def decode(text: str):
    """The value of a strict JSON text; Refused with the reason for any other."""
    try:
        value = json.loads(text, object_pairs_hook=_object, parse_float=_number, parse_constant=_constant)
    except Refused:
        raise
    except RecursionError:
        raise Refused(f"more than {MAX_DEPTH} levels") from None
    except ValueError as e:
        raise Refused(f"no JSON: {e}") from None
    if text.count("[") + text.count("{") > MAX_DEPTH and _levels(text) > MAX_DEPTH:
        raise Refused(f"more than {MAX_DEPTH} levels")
    if "\\u" in text:
        try:
            json.dumps(value, ensure_ascii=False).encode("utf-8")
        except UnicodeEncodeError:
            raise Refused("an unpaired surrogate") from None
    return value


@F.pandas_udf(T.StringType())
def _decoded_problem(texts: pd.Series) -> pd.Series:
    def one(text):
        if text is None:
            return None
        try:
            decode(text)
        except Refused as e:
            return str(e)
        return ""

    return texts.map(one, na_action="ignore")


def problem(col: Column) -> Column:
    """Why a text is not strict JSON, '' where it is, null for null."""
    bare = F.regexp_replace(col, r'"(?:[^"\\\x00-\x1f]|\\["\\/bfnrt])*"', '""')
    flat = F.length(F.regexp_replace(bare, r"[^\[{]", "")) <= 20
    plain_numbers = ~bare.rlike(r"[eE][+-]?\d{3}|\d{300}|\\")
    whole = bare.rlike(r"^\s*\{[^{}\[\]]*(?:[{\[][^{}\[\]]*[}\]][^{}\[\]]*)*\}\s*$")
    parsed = F.try_parse_json(col).isNotNull()
    settled = flat & plain_numbers & whole & parsed
    return F.when(col.isNull(), None).when(settled, "").otherwise(_decoded_problem(F.when(settled, None).otherwise(col)))


def is_strict(col: Column) -> Column:
    return F.coalesce(problem(col) == "", F.lit(False))

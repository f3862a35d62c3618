"""Repeated ids, names and inputs. The input key is JSON with sorted keys, white space collapsed, in lower case."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def input_key(value: dict) -> str:
    return " ".join(json.dumps(value, ensure_ascii=False, sort_keys=True).split()).lower()


@F.pandas_udf(T.StringType())
def _fingerprint(texts: pd.Series) -> pd.Series:
    def one(text):
        try:
            return hashlib.sha256(input_key(json.loads(text)).encode("utf-8", "surrogatepass")).hexdigest()
        except (ValueError, RecursionError):
            return None

    return texts.map(one, na_action="ignore")


def fingerprint(col: Column) -> Column:
    """SHA-256 of the input key of a JSON text; null for null and for text that is no JSON."""
    return _fingerprint(col)


def repeated(df: DataFrame, column: str) -> DataFrame:
    """(value, n): values that stand in two or more rows."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).where("n > 1")


def duplicate_inputs(rows: DataFrame) -> DataFrame:
    """(ids, n): ids in order of rows (id, input_json) with the same input key."""
    keyed = rows.select("id", fingerprint(F.col("input_json")).alias("key")).where("key IS NOT NULL AND id IS NOT NULL").distinct()
    return keyed.groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.count("*").alias("n")).where("n > 1").select("ids", "n")


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Every row with `first_*` columns of the row that comes first among those with its keys, and `place` from 1.

    The first row is found by an aggregate, so a key that many rows share needs no window over all of them.
    """
    first = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("first"))
    out = df.join(first, keys)
    same = F.struct(*order) == F.col("first")
    return out.select(*df.columns, *(F.col(f"first.{c}").alias(f"first_{c}") for c in order), same.alias("wins"))


def latest(df: DataFrame, key: str, at: str) -> DataFrame:
    """One row per key: the last by `at`; ties by all other columns."""
    rest = [c for c in df.columns if c not in (key, at)]
    best = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(at, *rest)).alias("row"))
    return best.select(key, *(F.col(f"row.{c}").alias(c) for c in [at, *rest]))



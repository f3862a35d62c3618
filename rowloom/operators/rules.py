"""Ordered rules: the first rule that a row breaks gives its outcome. A set of rules is one CASE expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


class Rules:
    """`add(bucket, reason, broken)` in order of precedence; `outcome(otherwise)` is struct<bucket, reason>."""

    def __init__(self):
        self.cases: list[tuple[str, Column, Column]] = []

    def add(self, bucket: str, reason: str | Column, broken: Column) -> Rules:
        self.cases.append((bucket, F.lit(reason) if isinstance(reason, str) else reason, broken))
        return self

    def outcome(self, otherwise: str, reason: Column | None = None) -> Column:
        result = F.struct(F.lit(otherwise).alias("bucket"), (F.lit("") if reason is None else reason).alias("reason"))
        for bucket, why, broken in reversed(self.cases):
            result = F.when(F.coalesce(broken, F.lit(False)), F.struct(F.lit(bucket).alias("bucket"), why.alias("reason"))).otherwise(result)
        return result

    def all_broken(self) -> Column:
        """The reasons of every broken rule, in order."""
        return F.array_compact(F.array(*(F.when(F.coalesce(b, F.lit(False)), r) for _, r, b in self.cases)))

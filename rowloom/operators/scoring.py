"""Scores of decisions against references, and metrics. A field that does not apply to a row is null."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("format_valid", "roll_required", "check", "difficulty", "exact")


def scores(reference: Column, decision: Column) -> dict[str, Column]:
    """reference: struct<roll_required, options: array<array<check>>>; decision: struct<roll_required, checks> or null."""
    valid = decision.isNotNull()
    rolls = reference["roll_required"]
    single = F.transform(F.filter(reference["options"], lambda o: F.size(o) == 1), lambda o: F.get(o, F.lit(0)))
    said = F.get(decision["checks"], F.lit(0))
    same = F.filter(single, lambda o: (o["kind"] == said["kind"]) & (o["name"] == said["name"]))
    graded = F.when(F.size(same) > 0, same).otherwise(single)
    level = F.exists(graded, lambda o: o["difficulty"] == said["difficulty"])
    whole = F.exists(same, lambda o: o["difficulty"] == said["difficulty"])

    def if_rolled(col: Column) -> Column:
        return F.when(rolls, F.coalesce(said.isNotNull() & col, F.lit(False)))

    return {
        "format_valid": valid,
        "roll_required": valid & F.coalesce(decision["roll_required"] == rolls, F.lit(False)),
        "check": if_rolled(F.size(same) > 0),
        "difficulty": if_rolled(level),
        "exact": F.when(rolls, F.coalesce(said.isNotNull() & whole, F.lit(False))).otherwise(valid & ~F.coalesce(decision["roll_required"], F.lit(True))),
    }


def scored(rows: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and the five scores of rows with `reference` and `decision`."""
    made = scores(F.col("reference"), F.col("decision"))
    return rows.select(*keep, *(made[f].alias(f) for f in FIELDS))


def summarized(df: DataFrame, *by: str) -> DataFrame:
    """(by, field, correct, total, rate): per score its true and its non-null values; the rate has 4 places, null without any."""
    sums = df.groupBy(*by).agg(*(F.count_if(F.col(f)).alias(f"c_{f}") for f in FIELDS), *(F.count(f).alias(f"t_{f}") for f in FIELDS))
    parts = [sums.select(*by, F.lit(f).alias("field"), F.col(f"c_{f}").alias("correct"), F.col(f"t_{f}").alias("total")) for f in FIELDS]
    rate = F.when(F.col("total") > 0, F.bround(F.col("correct") / F.col("total"), 4))
    return reduce(DataFrame.unionByName, parts).withColumn("rate", rate)

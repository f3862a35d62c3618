"""Row-wise checks over a stream of prepared rows, and late deliveries of the same row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rules import Rules


def checked(stream: DataFrame, rules: Rules) -> DataFrame:
    """The stream with `reason`: the first rule that a row breaks, '' for none. Works on snapshots and streams alike."""
    return stream.withColumn("reason", rules.outcome("ok")["reason"])


def first_deliveries(stream: DataFrame, key: str, at: str, patience: str) -> DataFrame:
    """Each key once while its copies arrive within `patience` of each other; state is dropped behind the watermark."""
    return stream.where(F.col(key).isNotNull()).withWatermark(at, patience).dropDuplicatesWithinWatermark([key])

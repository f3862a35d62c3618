"""Comparison of two revisions of data, and digests of content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def changed(before: DataFrame, after: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, was, now, change): keys that were added, removed or changed."""
    a = before.select(key, F.col(digest).alias("was"), F.lit(1).alias("in_a"))
    b = after.select(key, F.col(digest).alias("now"), F.lit(1).alias("in_b"))
    both = a.join(b, key, "full_outer")
    change = F.when(F.col("in_a").isNull(), "added").when(F.col("in_b").isNull(), "removed").when(~F.col("was").eqNullSafe(F.col("now")), "changed")
    return both.withColumn("change", change).where("change IS NOT NULL").select(key, "was", "now", "change")


def stale(recorded: DataFrame, now: DataFrame, key: str, digest: str) -> DataFrame:
    """Recorded keys whose digest now differs or is missing."""
    pair = recorded.select(key, F.col(digest).alias("was")).join(now.select(key, F.col(digest).alias("now")), key, "left")
    return pair.where(~F.col("was").eqNullSafe(F.col("now")))


def digests(df: DataFrame, by: str, content: str) -> DataFrame:
    """(by, n, digest): per key the number of rows and an order-independent digest: the sum of row hashes."""
    part = F.conv(F.substring(F.sha2(F.coalesce(F.col(content), F.lit("")), 256), 1, 12), 16, 10).cast("decimal(20,0)")
    return df.groupBy(by).agg(F.count("*").alias("n"), F.sum(part).cast("string").alias("digest"))


def file_digests(spark, path: str, recursive: bool = False) -> DataFrame:
    """(path, sha256): digests of the files below a path; files of 2 GB and more are beyond the scan's row limit."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"))

"""Coverage of labels and accuracy against ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import saved
from .ordered import tertiles


def coverage(rows: DataFrame, covered: Column, name: str) -> DataFrame:
    return rows.agg(F.round(F.avg(covered.cast("int")), 6).alias(name), F.count(F.lit(1)).alias("n"))


def accuracy(truth: DataFrame, predicted: DataFrame, key: str, unsure: str = "ambiguous") -> DataFrame:
    """Matches over pairs in which neither side is ``unsure``."""
    both = truth.select(key, F.col("outcome").alias("t")).join(predicted.select(key, F.col("outcome").alias("p")), key)
    sure = (F.col("t") != unsure) & (F.col("p") != unsure)
    out = both.agg(F.count_if(sure & (F.col("t") == F.col("p"))).alias("matches"), F.count_if(sure).alias("compared"), F.count(F.lit(1)).alias("n"))
    return out.withColumn("accuracy", F.round(F.col("matches") / F.nullif(F.col("compared"), F.lit(0)), 6))


def sample(rows: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """A repeatable sample of ``k`` rows."""
    return rows.orderBy(F.xxhash64(F.lit(seed), key), key).limit(k)


def stratified_sample(chats: DataFrame, size: str, key: str, counts: tuple[int, int, int] = (6, 8, 6), seed: int = 42) -> DataFrame:
    """A repeatable sample of so many short, middling and long chats, with their ``stratum``."""
    rows = saved(tertiles(chats, size, key), "strata")
    parts = [sample(rows.filter(F.col("stratum") == i), key, k, seed) for i, k in enumerate(counts)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])

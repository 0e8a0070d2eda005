"""Reconciliation: queries that return the rows that differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.functions.text import differs


def multiset_diff(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys and ``n``: how many more rows ``a`` has (negative: fewer). One aggregation; equal rows cancel before the shuffle."""
    signed = a.select(*keys, F.lit(1).cast("long").alias("__s")).unionByName(b.select(*keys, F.lit(-1).cast("long").alias("__s")))
    return signed.groupBy(*keys).agg(F.sum("__s").alias("n")).where("n <> 0")


def set_diff(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys and ``side``: only in a, or only in b; duplicates don't count, and null equals null."""
    sides = a.select(*keys, F.lit(1).alias("__s")).unionByName(b.select(*keys, F.lit(2).alias("__s")))
    # Grouping takes null for equal to null, and one aggregation finds both sides.
    seen = sides.groupBy(*keys).agg(F.bit_or("__s").alias("__s")).where("__s <> 3")
    return seen.select(*keys, F.when(F.col("__s") == 1, "a").otherwise("b").alias("side"))


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], left: str, right: str) -> DataFrame:
    """Keys whose values differ, or that one side lacks."""
    both = a.select(*keys, F.col(left).alias("__l")).join(b.select(*keys, F.col(right).alias("__r")), list(keys), "full_outer")
    return both.where(differs(F.col("__l"), F.col("__r"))).select(*keys, F.col("__l").alias(left), F.col("__r").alias(right if right != left else f"other_{right}"))


def covered(expected: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys and ``n``: how many rows there are of each expected or found key, 0 for expected ones without any."""
    counts = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return expected.join(counts, list(keys), "full_outer").select(*keys, F.coalesce("__n", F.lit(0)).alias("n"))


def scoped(df: DataFrame, scope: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are in ``scope``, however often they stand there."""
    return df.join(scope.select(*keys).distinct(), list(keys), "left_semi")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def dependency_violations(df: DataFrame, determinant: Sequence[str], dependent: str) -> DataFrame:
    """Determinants with more than one dependent value."""
    return df.groupBy(*determinant).agg(F.countDistinct(dependent).alias("n_values")).where("n_values > 1")


def not_covered(expected: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected keys of which there is no row."""
    return covered(expected, found, keys).where("n = 0")

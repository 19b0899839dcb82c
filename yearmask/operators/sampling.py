"""Deterministic samples by hash: the same for any order, partitioning or repetition of the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearmask.functions.hosts import depth, tld


def stratum(host: Column) -> Column:
    """K1: TLD, depth, length class and ``www``."""
    length = F.when(F.length(host) <= 15, "short").when(F.length(host) <= 30, "medium").otherwise("long")
    return F.concat_ws("|", tld(host), depth(host).cast("string"), length, F.when(host.startswith("www."), "www").otherwise("nonwww"))


def stratified(hosts: DataFrame, limit: int, cap: int = 32) -> DataFrame:
    """K1: at most ``cap`` hosts of smallest hash a stratum, taken round by round over the strata in hash order.

    The rank limit is pushed below the shuffle, so a large stratum sends ``cap`` rows a task at most.
    """
    rows = hosts.select("host").distinct().select("host", stratum(F.col("host")).alias("stratum"), F.sha2("host", 256).alias("score"))
    w = Window.partitionBy("stratum").orderBy("score")
    ranked = rows.withColumn("round", F.row_number().over(w)).where(F.col("round") <= cap)
    return ranked.orderBy("round", F.sha2("stratum", 256)).limit(limit).select("host", "stratum", "round")


def smallest_hashes(values: DataFrame, column: str, size: int, seed: str) -> DataFrame:
    """K2: the ``size`` distinct values of smallest seeded hash."""
    return values.select(column).distinct().withColumn("score", F.sha2(F.concat_ws("|", F.lit(seed), column), 256)).orderBy("score").limit(size)


def per_group(rows: DataFrame, group: str, value: str, k: int, seed: str) -> DataFrame:
    """K3: ``k`` distinct values of each group by seeded hash."""
    scored = rows.select(group, value).distinct().withColumn("score", F.sha2(F.concat_ws("|", F.lit(seed), value), 256))
    w = Window.partitionBy(group).orderBy("score")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(group, value, "rank")

"""Weighted counts of hosts and host-years (EED): exact decimals, distinct before validity, unmatched counted apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearmask.functions.hosts import normalize_host, strip, tld

WEIGHT = "decimal(9,6)"


def english_weights(model: DataFrame) -> DataFrame:
    """(tld, weight) from one JSON row of parallel arrays tld, lang and perc_of_tld, for ``eng``; fails if there are none."""
    rows = model.select(F.explode(F.arrays_zip("tld", "lang", "perc_of_tld")).alias("x")).where("x.lang = 'eng'")
    out = rows.select(F.lower(F.regexp_replace("x.tld", r"^\.", "")).alias("tld"), (F.col("x.perc_of_tld").cast("decimal(9,4)") * F.lit("0.01").cast("decimal(4,2)")).cast(WEIGHT).alias("weight"))
    if out.isEmpty():
        raise ValueError("the model has no English rows")
    return out


def eed(count: Column, weight: Column) -> Column:
    """The exact weighted count, as a decimal."""
    return F.sum(count.cast("decimal(18,0)") * F.coalesce(weight, F.lit(0)).cast(WEIGHT))


def by_tld(hosts: DataFrame, weights: DataFrame, host: str = "host") -> DataFrame:
    """G1: per TLD the distinct valid hosts, weight, EED and whether the model has the TLD."""
    valid = hosts.select(normalize_host(F.col(host)).alias("h")).where("h is not null").distinct()
    counts = valid.groupBy(tld(F.col("h")).alias("tld")).agg(F.count("*").alias("hosts"))
    joined = counts.join(weights, "tld", "left")
    return joined.select("tld", "hosts", (F.col("hosts").cast("decimal(18,0)") * F.coalesce("weight", F.lit(0)).cast(WEIGHT)).cast("double").alias("eed"), F.when(F.col("weight").isNotNull(), "matched").otherwise("unmatched").alias("model_status"))


def summary(values: DataFrame, weights: DataFrame, value: str = "value") -> DataFrame:
    """G1: one row of counts: unique non-empty values, valid, invalid, matched and unmatched hosts, coverage, EED."""
    unique = values.select(F.lower(strip(F.col(value))).alias("v")).where("v <> ''").distinct()
    rows = unique.select(normalize_host(F.col("v")).alias("h")).withColumn("tld", tld(F.col("h"))).join(weights, "tld", "left")
    total = rows.agg(F.count("*").alias("unique_nonempty"), F.count("h").alias("valid"), F.count("weight").alias("matched"), F.coalesce(F.sum(F.when(F.col("h").isNotNull(), F.coalesce("weight", F.lit(0)).cast(WEIGHT))), F.lit(0)).cast("double").alias("eed"))
    return total.select("unique_nonempty", "valid", (F.col("unique_nonempty") - F.col("valid")).alias("invalid"), "matched", (F.col("valid") - F.col("matched")).alias("unmatched"), F.coalesce(100 * F.try_divide("matched", "valid"), F.lit(0.0)).alias("coverage_percent"), "eed")


def report(rows: DataFrame, weights: DataFrame, sets: list[list[str]], host: str = "host") -> DataFrame:
    """EED and host-years over several groupings at once. rows: distinct (host, year, and the other columns)."""
    names = sorted({c for s in sets for c in s})
    weighed = rows.withColumn("tld", tld(F.col(host))).join(weights, "tld", "left").withColumn("w", F.coalesce("weight", F.lit(0)).cast(WEIGHT))
    grouped = weighed.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in names])
    return grouped.agg(F.grouping_id().cast("int").alias("level"), F.count("*").alias("host_years"), F.sum("w").cast("double").alias("eed"))


def growth(novel: Column, baseline: Column) -> Column:
    """The growth rate; 0 without a baseline."""
    return F.coalesce(F.try_divide(novel.cast("double"), baseline.cast("double")), F.lit(0.0))


def passes(novel: Column, baseline: Column, rate: str) -> Column:
    """Whether novel >= rate * baseline, exactly: by cross-multiplication of decimals."""
    return novel.cast("decimal(24,6)") >= baseline.cast("decimal(24,6)") * F.lit(rate).cast("decimal(6,4)")

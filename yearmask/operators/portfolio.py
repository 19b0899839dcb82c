"""Regions: decisions, priorities, and the greedy choice of a portfolio by what each adds to what is covered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearmask.operators.sketch import WIDTH, intersection

MIB = float(1024 * 1024)


def refine(complete: Column, novel: Column, fraction: Column, eed_per_mib: Column, observed: Column, confidence: Column, least_fraction: float = 0.01, least_eed: float = 1.0, enough: int = 100, sure: float = 0.9) -> Column:
    """Whether to split a region further: while it is promising, or too little of it has been seen to drop it."""
    promising = (fraction >= least_fraction) | (eed_per_mib >= least_eed)
    return ~complete & F.when(novel > 0, promising).otherwise((observed < enough) | (confidence < sure))


def worth_harvest(novel: Column, fraction: Column, eed_per_mib: Column, least_fraction: float = 0.01, least_eed: float = 1.0) -> Column:
    """Whether to read a region whole."""
    return (novel > 0) & (fraction >= least_fraction) & (eed_per_mib >= least_eed)


def priority(eed: Column, bytes_read: Column, confidence: Column, exploration: float = 1.0) -> Column:
    """EED a MiB plus what uncertainty is worth."""
    density = F.coalesce(F.try_divide(eed, bytes_read.cast("double")), F.lit(0.0)) * MIB
    return density + exploration * (1.0 - confidence) * F.greatest(F.lit(1.0), density)


def leaf_actions(regions: DataFrame, limit: int) -> DataFrame:
    """The leaves (region, parent, eed, bytes_read, confidence) of the region tree that come first."""
    parents = regions.where("parent is not null").select(F.col("parent").alias("region")).distinct()
    leaves = regions.join(parents, "region", "left_anti")
    return leaves.withColumn("priority", F.round(priority(F.col("eed"), F.col("bytes_read"), F.col("confidence")), 8)).orderBy(F.desc("priority"), "region").limit(limit)


#: fixed value: the share that counts as covered of a region whose overlap with what is covered nobody can tell
UNKNOWN_OVERLAP = 0.25
#: candidates of a round that are scored before any other, by what they could add at best
FIRST = 256


def greedy(regions: DataFrame, sketch: DataFrame, most: int, byte_budget: float, overhead: float = 0.0, unknown: float = UNKNOWN_OVERLAP, first: int = FIRST, scored: list[int] | None = None) -> list:
    """Regions (region, items, eed, bytes) picked one by one, each for the EED a byte that it adds to those
    picked before, within a number of regions and of bytes (``overhead`` comes to each region's).

    A region without a sketch of WIDTH minima overlaps to the share ``unknown`` with whatever is covered; once such a region
    is picked, no region overlaps less. Ties go to the smaller name.

    Evaluation is lazy: all that a region could add is its own EED, so the most promising ``first`` are scored, and then
    only those whose EED a byte is no less than the best rate found. Scoring joins sketches (region, seed, minimum) with the
    union sketch of what is covered, which has WIDTH rows however much that is. Only the winner and counts come to the
    driver; ``scored`` gets the number of regions that each round has scored.
    """
    picked: list = []
    spent, covered, blind = 0.0, 0.0, False
    union: DataFrame | None = None
    whole = sketch.groupBy("region").agg(F.count("*").alias("n")).where(F.col("n") == WIDTH).select("region", F.lit(True).alias("sketched"))
    costed = regions.where((F.col("bytes") > 0) & (F.col("eed") > 0)).withColumn("cost", F.col("bytes") + overhead).withColumn("bound", F.col("eed") / F.col("cost")).join(whole, "region", "left")

    def best_of(rest: DataFrame) -> tuple:
        """(how many were scored, the best of them or None)."""
        some = union is not None or blind
        known = F.coalesce("sketched", F.lit(False))
        if union is None:
            joined = rest.withColumn("shared", F.lit(0.0))
        else:
            near = sketch.join(rest.select("region"), "region", "left_semi").join(F.broadcast(union.withColumnRenamed("minimum", "u")), "seed")
            equal = near.groupBy("region").agg((F.count_if(F.col("minimum") == F.col("u")) / WIDTH).alias("j"))
            shared = F.when(F.col("items") > 0, intersection(F.col("items").cast("double"), F.lit(covered), F.coalesce("j", F.lit(0.0)))).otherwise(0.0)
            joined = rest.join(equal, "region", "left").withColumn("shared", shared)
        part = F.coalesce(F.least(F.lit(1.0), F.try_divide("shared", F.col("items").cast("double"))), F.lit(1.0))
        if union is None:
            part = F.lit(unknown if blind else 0.0)
        elif blind:
            part = F.greatest(part, F.lit(unknown))
        contained = F.when(known, part).otherwise(F.lit(unknown if some else 0.0))
        added = F.col("eed") * F.greatest(F.lit(0.0), 1.0 - contained)
        rated = joined.withColumn("added", F.round(added, 8)).withColumn("rate", F.round(added / F.col("cost"), 12))
        row = F.struct(-F.col("rate"), "region")
        got = rated.agg(F.count("*").alias("n"), F.min_by(F.struct(*rated.columns), row).alias("best"), F.min("bound").alias("low")).first()
        return got["n"], got["best"], got["low"]

    while len(picked) < most:
        rest = costed.where(~F.col("region").isin([p["region"] for p in picked])) if picked else costed
        rest = rest.where(F.col("cost") <= byte_budget - spent)
        n, winner, low = best_of(rest.orderBy(F.desc("bound"), "region").limit(first))
        if n == first:
            # those of the first that were scored have bounds of ``low`` and more; of the rest only these can still win
            least = max(0.0, winner["rate"]) * (1 - 1e-9)
            more, other, _ = best_of(rest.where((F.col("bound") <= low) & (F.col("bound") >= least)))
            n += more
            if other is not None and (-other["rate"], other["region"]) < (-winner["rate"], winner["region"]):
                winner = other
        if scored is not None:
            scored.append(n)
        if winner is None or winner["added"] <= 0:
            break
        picked.append(winner)
        spent += winner["cost"]
        if winner["sketched"] is None:
            blind = blind or winner["items"] > 0
            continue
        if winner["items"] <= 0:
            continue
        covered = max(covered, covered + winner["items"] - winner["shared"])
        own = sketch.where(F.col("region") == F.lit(winner["region"])).select("seed", "minimum")
        rows = (own if union is None else union.unionByName(own)).groupBy("seed").agg(F.min("minimum").alias("minimum")).collect()  # WIDTH rows at most
        union = regions.sparkSession.createDataFrame(rows, "seed int, minimum long")
    return picked


def admission(level: Column, direct_entry: Column, direct_prior: Column, volume: Column, enumerable: Column, confidence: Column, year_from: Column, year_to: Column) -> Column:
    """Why a proposal is turned down, by the first rule that it breaks; null if it is admitted. Floors depend on the
    role: direct evidence, gateways (collections and their lists), or sources."""
    gateway = level.isin("COLLECTION", "METASOURCE")
    volume_floor = F.when(direct_entry, 1).when(gateway, 10).otherwise(1000)
    enumerable_floor = F.when(gateway & ~direct_entry, 0.3).otherwise(0.5)
    return F.coalesce(
        F.when((direct_prior > 0) & ~direct_entry, F.lit("direct_prior_not_authoritative")), F.when(volume.isNull(), F.lit("volume_missing")), F.when(volume < volume_floor, F.lit("volume_below_floor")),
        F.when(enumerable < enumerable_floor, F.lit("not_enumerable")), F.when(confidence < 0.2, F.lit("low_confidence")), F.when((year_from.isNull() | year_to.isNull()) & ~direct_entry, F.lit("years_missing")),
        F.when((year_to < 1996) | (year_from > 2001), F.lit("years_off_target")),
    )

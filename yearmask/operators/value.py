"""Value models: yields, posteriors, saturation, rankings. Columns and aggregates only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearmask.operators.ordered import BLOCK, in_blocks, previous

#: fixed values: prior host-years a request by kind, prior strength, retry penalty
PRIORS = (("EXACT", 0.25), ("RANGE", 0.5), ("DOMAIN", 1.0), ("RDAP", 0.5))
PRIOR_STRENGTH, RETRY_PENALTY = 4.0, 0.25


def ratio(a: Column, b: Column) -> Column:
    """A share that is 0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def prior(kind: Column) -> Column:
    out = F.lit(0.0)
    for k, v in PRIORS:
        out = F.when(kind == k, F.lit(v)).otherwise(out)
    return out


def posterior(kind: Column, novel: Column, requests: Column, attempts: Column) -> Column:
    """Posterior host-years a request."""
    return (novel + PRIOR_STRENGTH * prior(kind)) / (F.greatest(requests, attempts) + PRIOR_STRENGTH)


def task_value(weight: Column, yielded: Column, attempt: Column) -> Column:
    """Weighted yield with a penalty for retries."""
    return weight * yielded / (1.0 + RETRY_PENALTY * attempt)


def mixing_fraction(base: Column, exact: Column, ranged: Column, requests: Column, authoritative: Column) -> Column:
    """The configured share, blended into the learned one as requests come in; floor .05, ceiling .95, 50 requests."""
    target = F.when(exact + ranged <= 0, base).otherwise(ranged / (exact + ranged))
    target = F.least(F.lit(0.95), F.greatest(F.lit(0.05), target))
    sure = F.least(F.lit(1.0), requests / 50.0)
    return F.when((base == 0) | ~authoritative, base).otherwise((1.0 - sure) * base + sure * target)


def scout_priority(level: Column, volume: Column, direct: Column, overlap: Column, temporal: Column, enumerable: Column, access: Column, adapter: Column, confidence: Column) -> Column:
    """The order of cheap scouting, from priors."""
    hint = F.when(volume.isNull() & (direct >= 0.5), 100_000).otherwise(volume)
    scale = F.when(level == "METASOURCE", 1.6).when(level == "COLLECTION", 1.25).otherwise(1.0)
    quality = (1.0 + temporal + enumerable + direct) / 4.0
    return scale * F.log1p(F.greatest(F.lit(1), F.coalesce(hint, F.lit(1))).cast("double")) * F.greatest(F.lit(0.01), 1.0 - overlap) * quality * (1.0 + 4.0 * direct) * F.greatest(F.lit(0.05), confidence) / F.greatest(F.lit(0.1), 1.0 + access + adapter)


def source_value(direct: Column, descendants: Column, uncertainty: Column, overlap: Column, cost: Column) -> Column:
    """D3: what a source is worth a second."""
    return F.greatest(F.lit(0.0), direct + descendants + uncertainty) * F.greatest(F.lit(0.0), 1.0 - overlap) / F.greatest(F.lit(1e-6), cost)


def unseen(observed: DataFrame, group: str, key: str) -> DataFrame:
    """Per group the observations, distinct keys, keys seen once and twice, the unseen share (Good-Turing) and
    the opportunity, which is that share of what was observed. Two levels: keys are counted before groups."""
    return unseen_of(observed.groupBy(group, key).agg(F.count("*").alias("c")), group, "c")


def unseen_of(counts: DataFrame, group: str, count: str, extra: list[Column] | None = None) -> DataFrame:
    """``unseen`` of keys that are counted already: a row for each group and key. ``extra`` are aggregates to go with it."""
    c = F.col(count)
    out = counts.groupBy(group).agg(F.sum(c).alias("observations"), F.count("*").alias("distinct_keys"), F.count_if(c == 1).alias("singletons"), F.count_if(c == 2).alias("doubletons"), *(extra or []))
    share = ratio(F.col("singletons"), F.col("observations"))
    return out.withColumn("unseen_fraction", share).withColumn("opportunity", share * F.greatest(F.lit(1), F.col("distinct_keys")))


def hurdle(rows: DataFrame, family: str, final: str, scout: str) -> DataFrame:
    """Per family the closed exposures, successes, Beta(1, 1) success probability and conversion of successes."""
    good = F.col(final) > 0
    out = rows.groupBy(family).agg(F.count("*").alias("n"), F.count_if(good).alias("successes"), F.sum(F.when(good, F.col(scout)).otherwise(0.0)).alias("scout_sum"), F.sum(F.when(good, F.col(final)).otherwise(0.0)).alias("final_sum"))
    return out.select(family, "n", "successes", ((F.col("successes") + 1.0) / (F.col("n") + 2.0)).alias("success_probability"), ratio(F.col("final_sum"), F.col("scout_sum")).alias("conversion"))


def saturation(measured: DataFrame, origin: str, eed: str, observed: str, least_sources: int = 32, least_observed: int = 1000, most_eed: float = 0.0) -> DataFrame:
    """Which origins are saturated, and why or why not."""
    out = measured.groupBy(origin).agg(F.count("*").alias("measured"), F.count_if(F.col(eed) > 0).alias("positive"), F.sum(observed).cast("long").alias("observations"), F.sum(eed).alias("novel_eed"))
    enough, seen, zero = F.col("measured") >= least_sources, F.col("observations") >= least_observed, (F.col("positive") == 0) & (F.col("novel_eed") <= most_eed)
    reason = F.when(enough & seen & zero, "suppress").when(~enough, "too_few_sources").when(F.col("positive") > 0, "positive_yield").when(~seen, "too_few_observations").otherwise("eed_above_threshold")
    return out.withColumn("suppress", enough & seen & zero).withColumn("reason", reason)


def recent_values(runs: DataFrame, key: str, order: list[str], value: Column, last: int = 8) -> DataFrame:
    """The last values of each key, oldest first. Ranks are limited before the shuffle."""
    w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    ranked = runs.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= last).withColumn("__v", value)
    return ranked.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("__rn")).alias("o"), F.col("__v").alias("v")))), lambda x: x.v).alias("values"))


def ewma(values: Column, alpha: float = 0.6) -> Column:
    """Exponentially weighted mean of an array, oldest first; 0 for an empty one."""
    rest = F.slice(values, F.lit(2), F.greatest(F.size(values) - 1, F.lit(0)))
    return F.when(F.size(values) > 0, F.aggregate(rest, F.get(values, F.lit(0)), lambda a, x: alpha * x + (1 - alpha) * a)).otherwise(0.0)


def deltas(samples: DataFrame, name: str, order: str, value: str) -> DataFrame:
    """Change of a counter from sample to sample by a number ``order``, and whether it was reset; the first sample
    has none. A counter with most of the samples is split by ranges of the order."""
    rows = previous(in_blocks(samples, F.col(order)), name, [order], value, "__previous")
    out = rows.withColumn("delta", F.col(value) - F.col("__previous")).withColumn("reset", F.col(value) < F.col("__previous"))
    return out.drop("__previous", BLOCK)


def ucb(rewards: DataFrame, name: str, episodes: str, rate: str, exploration: float = 0.5) -> DataFrame:
    """Each arm with its upper confidence bound, from totals over all arms (one row, joined to few)."""
    total = rewards.agg(F.sum(episodes).alias("__n"), F.greatest(F.lit(1.0), F.max(rate)).alias("__scale"))
    bonus = exploration * F.col("__scale") * F.sqrt(F.log(F.col("__n") + 1.0) / F.col(episodes))
    return rewards.join(F.broadcast(total)).withColumn("ucb", F.col(rate) + bonus).drop("__n", "__scale")


def cell_fractions(rows: DataFrame, sets: list[list[str]]) -> DataFrame:
    """Search statistics and their shares, by each grouping and in total."""
    names = sorted({c for s in sets for c in s})
    out = rows.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in names]).agg(
        F.count("*").alias("attempts"), F.sum("results").alias("results"), F.sum("duplicates").alias("duplicates"), F.sum("qualified").alias("qualified"), F.round(F.sum("cost"), 4).alias("cost")
    )
    return out.withColumn("duplicate_fraction", ratio(F.col("duplicates"), F.col("results"))).withColumn("qualified_fraction", F.least(F.lit(1.0), ratio(F.col("qualified"), F.col("results"))))


def cell_state(attempts: Column, results: Column, duplicate: Column, new_family: Column, qualified: Column, program: Column) -> Column:
    """Whether a search cell is saturated."""
    return F.when(results == 0, attempts >= program).when((attempts < 3) | (results < 30), False).otherwise(((duplicate >= 0.9) & (new_family <= 0.05)) | (qualified <= 0.01))


def cell_score(attempts: Column, duplicate: Column, eed: Column, cost: Column, qualified: Column, results: Column) -> Column:
    """Exploration, novelty and residual value of a search cell."""
    residual = F.when((cost > 0) & (eed > 0), eed / cost).when(results > 0, qualified / results).otherwise(0.5)
    return 1.0 / F.sqrt(1.0 + attempts) + 1.5 * (1.0 - duplicate) + residual


def greedy_diverse(scored: DataFrame, key: str, score: str, first: str, second: str, limit: int) -> list:
    """Picks of a batch, each round the best of all rows after penalties for repeats of two dimensions. One top-1
    query a round, and ``limit`` rounds: the table stays in Spark."""
    picked: list = []
    for _ in range(limit):
        penalty = F.lit(0.0)
        for r in picked:
            penalty = penalty + F.when(F.col(first) == r[first], 0.75).otherwise(0.0) + F.when(F.col(second) == r[second], 0.2).otherwise(0.0)
        rest = scored.where(~F.col(key).isin([r[key] for r in picked])) if picked else scored
        best = rest.withColumn("adjusted", F.col(score) - penalty).orderBy(F.desc("adjusted"), F.desc(score), F.desc(key)).limit(1).collect()
        if not best:
            break
        picked += best
    return picked

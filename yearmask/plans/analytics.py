"""Source analytics: yields, posteriors, saturation, rankings, sketches, graphs, search cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yearmask.functions import hosts as H
from yearmask.operators import eed as E
from yearmask.operators import evidence as V
from yearmask.operators import graph as G
from yearmask.operators import ordered as O
from yearmask.operators import sketch as M
from yearmask.operators import value as A
from yearmask.plans import derived as D
from yearmask.plans.registry import query


@query("g13_scout_measurement", f"""
WITH {D.LOG}, {D.WEIGHTS}, b AS (SELECT DISTINCT host, year FROM log WHERE lane = 'R'), p AS (SELECT source_id, host, year, count(*) AS c FROM log GROUP BY ALL),
k AS (SELECT source_id, host, sum(c) AS c FROM p GROUP BY ALL),
f AS (SELECT source_id, CAST(sum(c) AS BIGINT) AS observations, count(*) AS hosts, count(*) FILTER (WHERE c = 1) AS singletons, count(*) FILTER (WHERE c = 2) AS doubletons FROM k GROUP BY 1),
n AS (SELECT p.source_id, count(*) AS pairs, count(*) FILTER (WHERE b.host IS NULL) AS novel_pairs, CAST(coalesce(sum(weight) FILTER (WHERE b.host IS NULL), 0) AS DOUBLE) AS novel_pair_eed
  FROM p LEFT JOIN b ON p.host = b.host AND p.year = b.year LEFT JOIN weights ON weights.tld = list_extract(string_split(p.host, '.'), -1) GROUP BY 1)
SELECT source_id, observations, hosts, singletons, doubletons, pairs, novel_pairs, novel_pair_eed, singletons / observations AS unseen_fraction, singletons / observations * greatest(1, hosts) AS opportunity FROM f JOIN n USING (source_id)""")
def g13_scout_measurement(spark: SparkSession, sf: str) -> DataFrame:
    """What each source holds, what of it is new, and how much of it is still unseen."""
    # one scan: what follows is made of the counts of each source, host and year; a host-year has a row a source at most
    pairs = D.log(spark, sf).groupBy("source_id", "host", "year").agg(F.count("*").alias("c"), F.bool_or(F.col("lane") == "R").alias("r"))
    marked = pairs.withColumn("known", F.max("r").over(Window.partitionBy("host", "year")))
    hosts = marked.groupBy("source_id", "host").agg(F.sum("c").alias("c"), F.count("*").alias("pairs"), F.count_if(~F.col("known")).alias("novel_pairs"))
    weighed = hosts.withColumn("tld", H.tld(F.col("host"))).join(D.weights(spark, sf), "tld", "left")
    eed = F.col("novel_pairs").cast("decimal(18,0)") * F.coalesce("weight", F.lit(0)).cast(E.WEIGHT)
    extra = [F.sum("pairs").alias("pairs"), F.sum("novel_pairs").alias("novel_pairs"), F.sum(eed).cast("double").alias("novel_pair_eed")]
    return A.unseen_of(weighed, "source_id", "c", extra).withColumnRenamed("distinct_keys", "hosts")


@query("g15_year_hint_pairs", f"WITH {D.CAPTURES} SELECT DISTINCT host, coalesce(CASE WHEN seq % 3 = 0 THEN year END, 1998) AS year FROM captures WHERE host IS NOT NULL AND (seq % 3 <> 0 OR year BETWEEN 1996 AND 2001)")
def g15_year_hint_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without a year take the one known year of their list."""
    year = F.coalesce(F.when(F.col("seq") % 3 == 0, F.col("year")), F.lit(1998))
    return D.captures(spark, sf).where("host is not null").select("host", H.in_window(year).alias("year")).where("year is not null").distinct()


@query("g16_attempt_cost", f"WITH {D.RUNS} SELECT kind, count(*) AS attempts, sum(cost) AS cost, CAST(sum(requests) AS BIGINT) AS requests FROM runs GROUP BY kind")
def g16_attempt_cost(spark: SparkSession, sf: str) -> DataFrame:
    return D.runs(spark, sf).groupBy("kind").agg(F.count("*").alias("attempts"), F.sum("cost").alias("cost"), F.sum("requests").alias("requests"))


@query("g17_action_value", f"""
WITH {D.RUNS}, k AS (SELECT unnest(['click', 'view', 'error', 'never']) AS kind), c AS (SELECT kind, sum(cost) AS cost, CAST(sum(requests) AS BIGINT) AS requests FROM runs GROUP BY kind), r AS (SELECT kind, round(sum(eed), 4) AS eed FROM runs GROUP BY kind)
SELECT kind, coalesce(cost, 0) AS cost, coalesce(requests, 0) AS requests, coalesce(eed, 0) AS eed, coalesce(eed / nullif(requests, 0), 0) AS eed_per_request FROM k LEFT JOIN c USING (kind) LEFT JOIN r USING (kind)""")
def g17_action_value(spark: SparkSession, sf: str) -> DataFrame:
    """Cost and reward of every kind of action, also of kinds without either."""
    r = D.runs(spark, sf)
    kinds = spark.range(1).select(F.explode(F.array(*map(F.lit, ("click", "view", "error", "never")))).alias("kind"))
    cost = r.groupBy("kind").agg(F.sum("cost").alias("cost"), F.sum("requests").alias("requests"))
    reward = r.groupBy("kind").agg(F.round(F.sum("eed"), 4).alias("eed"))
    j = kinds.join(cost, "kind", "left").join(reward, "kind", "left").fillna(0, ["cost", "requests", "eed"])
    return j.withColumn("eed_per_request", A.ratio(F.col("eed"), F.col("requests")))


@query("g18_strategy_rewards", f"WITH {D.RUNS} SELECT kind AS strategy, count(*) AS episodes, sum(cost) AS cost, round(sum(eed), 4) AS reward, round(sum(eed) / sum(cost), 6) AS reward_per_cost FROM runs GROUP BY kind")
def g18_strategy_rewards(spark: SparkSession, sf: str) -> DataFrame:
    out = D.runs(spark, sf).groupBy(F.col("kind").alias("strategy")).agg(F.count("*").alias("episodes"), F.sum("cost").alias("cost"), F.sum("eed").alias("e"))
    return out.select("strategy", "episodes", "cost", F.round("e", 4).alias("reward"), F.round(A.ratio(F.col("e"), F.col("cost")), 6).alias("reward_per_cost"))


@query("g19_task_rewards", f"""
WITH {D.RUNS}, c AS (SELECT kind, count(*) AS tasks, sum(cost) AS cost FROM runs GROUP BY kind), r AS (SELECT kind, count(*) AS rewards, round(sum(eed), 4) AS credited FROM runs WHERE eed > 0 GROUP BY kind)
SELECT kind, tasks, cost, coalesce(rewards, 0) AS rewards, coalesce(credited, 0) AS credited FROM c LEFT JOIN r USING (kind)""")
def g19_task_rewards(spark: SparkSession, sf: str) -> DataFrame:
    """Costs and rewards are summed apart, so the join multiplies neither."""
    r = D.runs(spark, sf)
    c = r.groupBy("kind").agg(F.count("*").alias("tasks"), F.sum("cost").alias("cost"))
    w = r.where("eed > 0").groupBy("kind").agg(F.count("*").alias("rewards"), F.round(F.sum("eed"), 4).alias("credited"))
    return c.join(w, "kind", "left").fillna(0, ["rewards", "credited"])


@query("g20_family_hurdle", f"""
WITH {D.RUNS} SELECT source, count(*) AS n, count(*) FILTER (WHERE eed > 0) AS successes, (count(*) FILTER (WHERE eed > 0) + 1.0::DOUBLE) / (count(*) + 2.0::DOUBLE) AS success_probability,
  coalesce(sum(eed) FILTER (WHERE eed > 0) / sum(cost) FILTER (WHERE eed > 0), 0) AS conversion FROM runs GROUP BY source""")
def g20_family_hurdle(spark: SparkSession, sf: str) -> DataFrame:
    return A.hurdle(D.runs(spark, sf), "source", "eed", "cost")


@query("g21_saturation", f"""
WITH {D.LOG}, m AS (SELECT concat('p', l.lane, list_extract(string_split(host, '.'), -1)) AS origin, host, count(*) AS observed, CASE WHEN list_extract(string_split(host, '.'), -1) < 'bc' OR lane <> 'N' THEN 0.0 ELSE sum(n) END AS eed FROM log l GROUP BY 1, host, lane),
o AS (SELECT origin, count(*) AS measured, count(*) FILTER (WHERE eed > 0) AS positive, CAST(sum(observed) AS BIGINT) AS observations, CAST(sum(eed) AS DOUBLE) AS novel_eed FROM m GROUP BY origin)
SELECT *, measured >= 32 AND observations >= 100 AND positive = 0 AND novel_eed <= 0 AS suppress,
 CASE WHEN measured >= 32 AND observations >= 100 AND positive = 0 AND novel_eed <= 0 THEN 'suppress' WHEN measured < 32 THEN 'too_few_sources' WHEN positive > 0 THEN 'positive_yield' WHEN observations < 100 THEN 'too_few_observations' ELSE 'eed_above_threshold' END AS reason FROM o""")
def g21_saturation(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.log(spark, sf).withColumn("tld", H.tld(F.col("host")))
    m = rows.groupBy(F.concat(F.lit("p"), "lane", "tld").alias("origin"), "host", "lane", "tld").agg(F.count("*").alias("observed"), F.sum("n").alias("s"))
    m = m.withColumn("eed", F.when((F.col("tld") < "bc") | (F.col("lane") != "N"), 0.0).otherwise(F.col("s")))
    return A.saturation(m, "origin", "eed", "observed", least_observed=100)


_CELLS = """cells AS (SELECT p_type AS mechanism, p_brand AS institution, p_size % 4 AS period, p_size AS results, p_partkey % (p_size + 1) AS duplicates, p_partkey % 7 % (p_size + 1) AS qualified, p_partkey % 5 % (p_size + 1) AS families, p_retailprice AS cost FROM part)"""


def cells(spark: SparkSession, sf: str) -> DataFrame:
    p = D.table(spark, sf, "part")
    return p.select(F.col("p_type").alias("mechanism"), F.col("p_brand").alias("institution"), (F.col("p_size") % 4).alias("period"), F.col("p_size").cast("long").alias("results"), (F.col("p_partkey") % (F.col("p_size") + 1)).alias("duplicates"), (F.col("p_partkey") % 7 % (F.col("p_size") + 1)).alias("qualified"), (F.col("p_partkey") % 5 % (F.col("p_size") + 1)).alias("families"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_retailprice") * 2).otherwise(0.0).alias("eed"), F.col("p_retailprice").alias("cost"))


@query("g23_search_rollup", f"""
WITH {_CELLS}, g AS (SELECT mechanism, institution, period, count(*) AS attempts, CAST(sum(results) AS BIGINT) AS results, CAST(sum(duplicates) AS BIGINT) AS duplicates, CAST(sum(qualified) AS BIGINT) AS qualified, round(sum(cost), 4) AS cost
 FROM cells GROUP BY GROUPING SETS ((mechanism), (institution), (period), ()))
SELECT *, coalesce(duplicates / nullif(results, 0), 0) AS duplicate_fraction, least(1, coalesce(qualified / nullif(results, 0), 0)) AS qualified_fraction FROM g""")
def g23_search_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Search statistics by each dimension and in total, in one pass."""
    return A.cell_fractions(cells(spark, sf), [["mechanism"], ["institution"], ["period"], []])


@query("g24_shape_economics", f"WITH {_CELLS} SELECT mechanism, institution, period, count(*) AS episodes, CAST(sum(results) AS BIGINT) AS results, round(sum(cost), 4) AS cost, round(sum(qualified) / nullif(sum(cost), 0), 8) AS qualified_per_cost FROM cells GROUP BY ALL")
def g24_shape_economics(spark: SparkSession, sf: str) -> DataFrame:
    out = cells(spark, sf).groupBy("mechanism", "institution", "period").agg(F.count("*").alias("episodes"), F.sum("results").alias("results"), F.sum("cost").alias("c"), F.sum("qualified").alias("q"))
    return out.select("mechanism", "institution", "period", "episodes", "results", F.round("c", 4).alias("cost"), F.round(F.try_divide("q", "c"), 8).alias("qualified_per_cost"))


@query("g25_provider_summary", f"""
WITH {D.VALID}, s AS (SELECT host, count(DISTINCT provider) AS providers FROM valid GROUP BY host)
SELECT provider, count(DISTINCT raw) AS urls, count(DISTINCT host) AS datasets, count(DISTINCT CASE WHEN providers = 1 THEN host END) AS exclusive, count(DISTINCT CASE WHEN providers > 1 THEN host END) AS shared, round(avg(cost), 4) AS mean_cost FROM valid JOIN s USING (host) GROUP BY provider""")
def g25_provider_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct addresses and datasets of each provider, exclusive and shared. Rows are cut to one per provider and
    host first, so the distinct counts need no expansion of raw rows."""
    rows = D.valid_captures(spark, sf)
    distinct = rows.groupBy("provider", "host", "raw").agg(F.count("*").alias("n"), F.sum(F.col("cost").cast("decimal(28,6)")).alias("c"))
    pairs = distinct.groupBy("provider", "host").agg(F.count("*").alias("raws"), F.sum("n").alias("n"), F.sum("c").alias("c"))
    n = pairs.groupBy("host").agg(F.count("*").alias("providers"))
    j = pairs.join(n, "host")
    return j.groupBy("provider").agg(F.sum("raws").alias("urls"), F.count("*").alias("datasets"), F.count_if(F.col("providers") == 1).alias("exclusive"), F.count_if(F.col("providers") > 1).alias("shared"), F.round(F.sum("c").cast("double") / F.sum("n"), 4).alias("mean_cost"))


@query("g26_cell_saturation", f"""
WITH {_CELLS}, s AS (SELECT mechanism, institution, count(*) AS attempts, CAST(sum(results) AS BIGINT) AS results, coalesce(sum(duplicates) / nullif(sum(results), 0), 0) AS d, coalesce(sum(qualified) / nullif(sum(results), 0), 0) AS q, coalesce(sum(families) / nullif(sum(results), 0), 0) AS f FROM cells GROUP BY ALL)
SELECT mechanism, institution, CASE WHEN results = 0 THEN attempts >= 4 WHEN attempts < 3 OR results < 30 THEN FALSE ELSE (d >= 0.9 AND f <= 0.05) OR q <= 0.01 END AS saturated FROM s""")
def g26_cell_saturation(spark: SparkSession, sf: str) -> DataFrame:
    s = cells(spark, sf).groupBy("mechanism", "institution").agg(F.count("*").alias("a"), F.sum("results").alias("r"), A.ratio(F.sum("duplicates"), F.sum("results")).alias("d"), A.ratio(F.sum("qualified"), F.sum("results")).alias("q"), A.ratio(F.sum("families"), F.sum("results")).alias("f"))
    return s.select("mechanism", "institution", A.cell_state(F.col("a"), F.col("r"), F.col("d"), F.col("f"), F.col("q"), F.lit(4)).alias("saturated"))


@query("g27_recent_supply", f"""
WITH {D.RUNS}, r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY ts DESC, run_id DESC) AS rn FROM runs)
SELECT kind, count(*) AS episodes, count(*) FILTER (WHERE eed > 0) AS new_sources, CAST(coalesce(min(rn) FILTER (WHERE eed > 0) - 1, count(*)) AS BIGINT) AS zero_streak FROM r WHERE rn <= 12 GROUP BY kind""")
def g27_recent_supply(spark: SparkSession, sf: str) -> DataFrame:
    """The last twelve episodes of each kind, and how many of the newest found nothing."""
    w = Window.partitionBy("kind").orderBy(F.desc("ts"), F.desc("run_id"))
    last = D.runs(spark, sf).withColumn("rn", F.row_number().over(w)).where("rn <= 12")
    return last.groupBy("kind").agg(F.count("*").alias("episodes"), F.count_if(F.col("eed") > 0).alias("new_sources"), F.coalesce(F.min(F.when(F.col("eed") > 0, F.col("rn") - 1)).cast("long"), F.count("*")).alias("zero_streak"))


@query("g28_capped_count", f"WITH {D.VALID}, c AS (SELECT provider, source_id, count(DISTINCT host) AS n FROM valid GROUP BY ALL) SELECT provider, CAST(sum(least(n, 25)) AS BIGINT) AS effective FROM c GROUP BY provider")
def g28_capped_count(spark: SparkSession, sf: str) -> DataFrame:
    """Hosts of each provider, no origin counting for more than 25."""
    pairs = D.valid_captures(spark, sf).select("provider", "source_id", "host").distinct().groupBy("provider", "source_id").agg(F.count("*").alias("n"))
    return pairs.groupBy("provider").agg(F.sum(F.least("n", F.lit(25))).alias("effective"))


@query("g29_best_family", f"""
WITH {D.RUNS}, s AS (SELECT kind, source, round(sum(eed) / sum(cost), 6) AS rate FROM runs GROUP BY ALL) SELECT kind, source, rate FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY rate DESC, source) AS rn FROM s) WHERE rn = 1""")
def g29_best_family(spark: SparkSession, sf: str) -> DataFrame:
    s = D.runs(spark, sf).groupBy("kind", "source").agg(F.round(F.sum("eed") / F.sum("cost"), 6).alias("rate"))
    return V.first_by(s, ["kind"], [F.desc("rate"), "source"])


@query("g31_child_fanout", f"""
WITH {D.VALID}, h AS (SELECT DISTINCT host, string_split(host, '.') AS l FROM valid), p AS (SELECT host, array_to_string(l[2:], '.') AS parent FROM h WHERE len(l) >= 3 AND NOT (length(list_extract(l, -1)) = 2 AND len(l) < 4))
SELECT parent, count(*) AS children FROM p GROUP BY parent""")
def g31_child_fanout(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct children of each parent domain."""
    hosts = D.valid_captures(spark, sf).select("host").distinct().withColumn("parent", H.parent_domain(F.col("host"))).where("parent is not null")
    return hosts.groupBy("parent").agg(F.count("*").alias("children"))


@query("g31_fanout_sketch", f"""
WITH {D.VALID}, h AS (SELECT DISTINCT host, string_split(host, '.') AS l FROM valid), p AS (SELECT host, array_to_string(l[2:], '.') AS parent FROM h WHERE len(l) >= 3 AND NOT (length(list_extract(l, -1)) = 2 AND len(l) < 4))
SELECT parent, bit_or(1::BIGINT << CAST(CAST('0x' || substr(md5(host), 1, 15) AS BIGINT) % 63 AS INT)) AS sketch, CAST(bit_count(bit_or(1::BIGINT << CAST(CAST('0x' || substr(md5(host), 1, 15) AS BIGINT) % 63 AS INT))) AS BIGINT) AS children FROM p GROUP BY parent""")
def g31_fanout_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """The sketches of each year's hosts, kept apart and merged."""
    rows = D.valid_captures(spark, sf).select("year", "host", H.parent_domain(F.col("host")).alias("parent")).where("parent is not null")
    return M.merged_fanout(G.stored(M.fanout(rows, ["year", "parent"], "host"), "fanout"), ["parent"])


@query("k5_sketched_fanout", f"""
WITH {D.VALID}, h AS (SELECT DISTINCT host, string_split(host, '.') AS l FROM valid), p AS (SELECT host, array_to_string(l[2:], '.') AS parent FROM h WHERE len(l) >= 3 AND NOT (length(list_extract(l, -1)) = 2 AND len(l) < 4)),
c AS (SELECT parent, CAST(bit_count(bit_or(1::BIGINT << CAST(CAST('0x' || substr(md5(host), 1, 15) AS BIGINT) % 63 AS INT))) AS BIGINT) AS children FROM p GROUP BY parent) SELECT parent, children FROM c WHERE children >= 4 ORDER BY children DESC, parent LIMIT 50""")
def k5_sketched_fanout(spark: SparkSession, sf: str) -> DataFrame:
    """K5 over the sketches: parents with four children or more, most first."""
    return g31_fanout_sketch(spark, sf).where("children >= 4").select("parent", "children").orderBy(F.desc("children"), "parent").limit(50)


@query("g32_resource_summary", f"""
WITH {D.RUNS} SELECT kind AS state, count(*) AS samples, max(cost) AS highest, min(cost) AS lowest, avg(cost) AS mean FROM runs WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' GROUP BY kind""")
def g32_resource_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.runs(spark, sf).where("ts between timestamp '2024-01-05' and timestamp '2024-01-20'")
    return rows.groupBy(F.col("kind").alias("state")).agg(F.count("*").alias("samples"), F.max("cost").alias("highest"), F.min("cost").alias("lowest"), F.avg("cost").alias("mean"))


@query("g33_counters_and_gauges", f"WITH {D.RUNS} SELECT source AS name, CAST(sum(requests) AS BIGINT) AS counter, arg_max(cost, run_id) AS last, max(cost) AS highest, min(cost) AS lowest FROM runs GROUP BY source")
def g33_counters_and_gauges(spark: SparkSession, sf: str) -> DataFrame:
    return D.runs(spark, sf).groupBy(F.col("source").alias("name")).agg(F.sum("requests").alias("counter"), F.max_by("cost", "run_id").alias("last"), F.max("cost").alias("highest"), F.min("cost").alias("lowest"))


@query("g34_validation_window", f"""
WITH {D.RUNS} SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS attempts, round(sum(eed), 4) AS eed, round(sum(eed) / 24, 6) AS eed_per_hour, round(sum(eed) * 1000 / nullif(sum(requests), 0), 6) AS eed_per_1000_requests,
 round(count(*) FILTER (WHERE kind = 'error') / count(*), 6) AS error_fraction, count(*) FILTER (WHERE cost < 5) AS fast, count(*) FILTER (WHERE cost BETWEEN 5 AND 11) AS middling, count(*) FILTER (WHERE cost > 11) AS slow FROM runs GROUP BY 1""")
def g34_validation_window(spark: SparkSession, sf: str) -> DataFrame:
    """One conditional aggregate of rates, fractions and latency buckets a day."""
    c = F.col("cost")
    return D.runs(spark, sf).groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("attempts"), F.round(F.sum("eed"), 4).alias("eed"), F.round(F.sum("eed") / 24, 6).alias("eed_per_hour"), F.round(F.try_divide(F.sum("eed") * 1000, F.sum("requests")), 6).alias("eed_per_1000_requests"),
        F.round(F.count_if(F.col("kind") == "error") / F.count("*"), 6).alias("error_fraction"), F.count_if(c < 5).alias("fast"), F.count_if(c.between(5, 11)).alias("middling"), F.count_if(c > 11).alias("slow"),
    )


@query("g35_latency_percentiles", f"""
WITH {D.RUNS}, r AS (SELECT kind, cost, row_number() OVER (PARTITION BY kind ORDER BY cost) - 1 AS i, count(*) OVER (PARTITION BY kind) AS n FROM runs)
SELECT kind, max(cost) FILTER (WHERE i = floor((n - 1) * 0.5)) AS median, max(cost) FILTER (WHERE i = floor((n - 1) * 0.95)) AS p95, max(cost) AS highest FROM r GROUP BY kind""")
def g35_latency_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """Percentiles at index floor((n - 1) * q). Values are counted first, so the window sees distinct values only."""
    counts = D.runs(spark, sf).groupBy("kind", "cost").agg(F.count("*").alias("c"))
    total = counts.groupBy("kind").agg(F.sum("c").alias("n"))
    ranked = O.running_sum(O.in_blocks(counts, F.col("cost")), "kind", ["cost"], "c", "upto").join(total, "kind")
    at = {q: F.min(F.when(F.col("upto") > F.floor((F.col("n") - 1) * q), F.col("cost"))) for q in (0.5, 0.95)}
    return ranked.groupBy("kind").agg(at[0.5].alias("median"), at[0.95].alias("p95"), F.max("cost").alias("highest"))


@query("g36_batch_summary", f"WITH {D.RUNS} SELECT k % 10 AS batch, count(*) AS scheduled, count(*) FILTER (WHERE kind <> 'signup') AS executed, count(*) FILTER (WHERE kind = 'error') AS errors, CAST(sum(requests) AS BIGINT) AS pages FROM runs GROUP BY 1")
def g36_batch_summary(spark: SparkSession, sf: str) -> DataFrame:
    return D.runs(spark, sf).groupBy((F.col("k") % 10).alias("batch")).agg(F.count("*").alias("scheduled"), F.count_if(F.col("kind") != "signup").alias("executed"), F.count_if(F.col("kind") == "error").alias("errors"), F.sum("requests").alias("pages"))


@query("g39_source_yield", f"""
WITH {D.RUNS} SELECT source, round(sum(eed) / sum(cost) * 3600 * CASE WHEN count(*) FILTER (WHERE kind = 'error') * 4 > count(*) THEN 0.25 ELSE 1 END, 6) AS yield_per_hour FROM runs GROUP BY source""")
def g39_source_yield(spark: SparkSession, sf: str) -> DataFrame:
    """Yield an hour, saturated sources counted a quarter."""
    tired = F.count_if(F.col("kind") == "error") * 4 > F.count("*")
    return D.runs(spark, sf).groupBy("source").agg(F.round(F.sum("eed") / F.sum("cost") * 3600 * F.when(tired, 0.25).otherwise(1.0), 6).alias("yield_per_hour"))


@query("g40_provider_backlog", f"WITH {D.VALID} SELECT provider, count(*) FILTER (WHERE status = 'P' AND ts > TIMESTAMP '1998-01-01') AS claimed, count(*) FILTER (WHERE status = 'O' OR (status = 'P' AND ts <= TIMESTAMP '1998-01-01')) AS queued FROM valid GROUP BY provider")
def g40_provider_backlog(spark: SparkSession, sf: str) -> DataFrame:
    """Claimed work (lease not over) and queued work of each provider."""
    live = F.col("ts") > F.lit("1998-01-01").cast("timestamp")
    return D.valid_captures(spark, sf).groupBy("provider").agg(F.count_if((F.col("status") == "P") & live).alias("claimed"), F.count_if((F.col("status") == "O") | ((F.col("status") == "P") & ~live)).alias("queued"))


@query("g41_closed_runs", f"WITH {D.RUNS} SELECT source, count(*) AS runs, count(*) FILTER (WHERE eed <= 0) AS zero_runs, round(sum(eed), 4) AS eed, sum(requests + greatest(0, cost - 3)) AS cost FROM runs WHERE kind <> 'signup' GROUP BY source")
def g41_closed_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Roll-up of closed runs; runs without reward count."""
    rows = D.runs(spark, sf).where("kind <> 'signup'")
    return rows.groupBy("source").agg(F.count("*").alias("runs"), F.count_if(F.col("eed") <= 0).alias("zero_runs"), F.round(F.sum("eed"), 4).alias("eed"), F.sum(F.col("requests") + F.greatest(F.lit(0.0), F.col("cost") - 3)).alias("cost"))


@query("g42_learning_summary", f"WITH {D.RUNS}, s AS (SELECT source, sum(eed) AS eed FROM runs GROUP BY source) SELECT count(*) AS sources, count(*) FILTER (WHERE eed > 100) AS positive, round(sum(eed), 4) AS eed FROM s")
def g42_learning_summary(spark: SparkSession, sf: str) -> DataFrame:
    s = D.runs(spark, sf).groupBy("source").agg(F.sum("eed").alias("e"))
    return s.agg(F.count("*").alias("sources"), F.count_if(F.col("e") > 100).alias("positive"), F.round(F.sum("e"), 4).alias("eed"))


@query("w5_host_runs", f"""
WITH {D.VALID}, o AS (SELECT source_id, seq, host[1:2] AS h, CASE WHEN lag(host[1:2]) OVER (PARTITION BY source_id ORDER BY seq) IS DISTINCT FROM host[1:2] THEN 1 ELSE 0 END AS starts FROM valid),
g AS (SELECT *, sum(starts) OVER (PARTITION BY source_id ORDER BY seq) AS run FROM o) SELECT source_id, CAST(run AS BIGINT) AS run, min(h) AS head, count(*) AS n, min(seq) AS first_seq FROM g GROUP BY source_id, run""")
def w5_host_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of equal neighbours in each source's order; what comes again later is a run of its own."""
    rows = O.in_blocks(D.valid_captures(spark, sf).select("source_id", "seq", F.substring("host", 1, 2).alias("h")), F.col("seq"))
    near = O.previous(rows, "source_id", ["seq"], "h", "before")
    marked = O.running_sum(near.withColumn("starts", (~F.col("before").eqNullSafe(F.col("h"))).cast("int")), "source_id", ["seq"], "starts", "run")
    return marked.groupBy("source_id", "run").agg(F.min("h").alias("head"), F.count("*").alias("n"), F.min("seq").alias("first_seq"))


@query("w6_ewma", f"""
WITH RECURSIVE {D.RUNS}, r AS (SELECT source, eed / cost AS v, row_number() OVER (PARTITION BY source ORDER BY ts DESC, run_id DESC) AS rn FROM runs),
l AS (SELECT source, v, row_number() OVER (PARTITION BY source ORDER BY rn DESC) AS i FROM r WHERE rn <= 8),
e AS (SELECT source, i, v AS ewma FROM l WHERE i = 1 UNION ALL SELECT l.source, l.i, 0.6 * l.v + 0.4 * e.ewma FROM e JOIN l ON l.source = e.source AND l.i = e.i + 1)
SELECT source, round(arg_max(ewma, i), 8) AS ewma FROM e GROUP BY source""")
def w6_ewma(spark: SparkSession, sf: str) -> DataFrame:
    recent = A.recent_values(D.runs(spark, sf), "source", ["ts", "run_id"], F.col("eed") / F.col("cost"))
    return recent.select("source", F.round(A.ewma(F.col("values")), 8).alias("ewma"))


@query("w7_query_shapes", f"""
WITH {D.RUNS} SELECT source, run_id, CAST((row_number() OVER (PARTITION BY source ORDER BY ts, run_id) - 1) % 5 AS INT) AS shape, CAST((row_number() OVER (PARTITION BY source ORDER BY ts, run_id) - 1) % 3 AS INT) AS phrase FROM runs""")
def w7_query_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """Shape and phrase of each episode by its place within its cell."""
    rows = O.numbered(O.in_blocks(D.runs(spark, sf), O.seconds("ts")), "source", ["ts", "run_id"], "i")
    return rows.select("source", "run_id", F.pmod("i", F.lit(5)).cast("int").alias("shape"), F.pmod("i", F.lit(3)).cast("int").alias("phrase"))


@query("w8_counter_deltas", f"""
WITH {D.RUNS}, d AS (SELECT source, run_id, requests, requests - lag(requests) OVER (PARTITION BY source ORDER BY run_id) AS delta FROM runs) SELECT source, run_id, coalesce(delta, 0) AS delta, coalesce(delta < 0, FALSE) AS reset FROM d""")
def w8_counter_deltas(spark: SparkSession, sf: str) -> DataFrame:
    return A.deltas(D.runs(spark, sf), "source", "run_id", "requests").fillna(0, ["delta"]).fillna(False, ["reset"]).select("source", "run_id", "delta", "reset")


@query("w9_monotonic_deltas", f"""
WITH {D.RUNS}, d AS (SELECT source, kind, requests - lag(requests) OVER (PARTITION BY source ORDER BY run_id) AS delta FROM runs) SELECT source, kind, CAST(sum(delta) AS BIGINT) AS growth FROM d WHERE delta >= 0 GROUP BY source, kind""")
def w9_monotonic_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """Growth by source and kind; what fell is left out."""
    return A.deltas(D.runs(spark, sf), "source", "run_id", "requests").where("delta >= 0").groupBy("source", "kind").agg(F.sum("delta").alias("growth"))


@query("w10_report_delta", f"""
WITH {D.RUNS}, a AS (SELECT source, CAST(sum(requests) AS BIGINT) AS v FROM runs WHERE k < 50 GROUP BY source), b AS (SELECT source, CAST(sum(requests) AS BIGINT) AS v FROM runs WHERE k % 2 = 0 GROUP BY source)
SELECT coalesce(a.source, b.source) AS key, a.v AS before, b.v AS now FROM a FULL OUTER JOIN b ON a.source = b.source WHERE a.v IS DISTINCT FROM b.v""")
def w10_report_delta(spark: SparkSession, sf: str) -> DataFrame:
    """The leaves of two reports that differ."""
    r = D.runs(spark, sf)
    a = r.where("k < 50").groupBy(F.col("source").alias("key")).agg(F.sum("requests").alias("before"))
    b = r.where("k % 2 = 0").groupBy(F.col("source").alias("key")).agg(F.sum("requests").alias("now"))
    return a.join(b, "key", "full_outer").where(~F.col("before").eqNullSafe(F.col("now"))).select("key", "before", "now")


@query("w3_first_proposals", f"WITH {D.RUNS} SELECT source, run_id, kind FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ts, run_id) AS rn FROM runs) WHERE rn = 1")
def w3_first_proposals(spark: SparkSession, sf: str) -> DataFrame:
    return V.first_by(D.runs(spark, sf).select("source", "run_id", "kind", "ts"), ["source"], ["ts", "run_id"]).drop("ts")


_K4 = f"""WITH {D.VALID}, {D.WEIGHTS} SELECT seq, host, round(CAST(coalesce(weight, 0) AS DOUBLE) * ((seq % 20 + 4.0 * 0.25) / (seq % 30 + 4.0)) / (1.0 + 0.25 * (seq % 4)), 10) AS value
FROM valid LEFT JOIN weights ON weights.tld = {D.TLD_OF} ORDER BY value DESC, seq LIMIT 250"""


@query("k4_task_ranking", _K4)
def k4_task_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """Pending tasks by weighted posterior yield with a retry penalty."""
    rows = D.valid_captures(spark, sf).withColumn("tld", H.tld(F.col("host"))).join(D.weights(spark, sf), "tld", "left")
    s = F.col("seq")
    y = A.posterior(F.lit("EXACT"), s % 20, s % 30, F.lit(0))
    return rows.select("seq", "host", F.round(A.task_value(F.coalesce("weight", F.lit(0)).cast("double"), y, s % 4), 10).alias("value")).orderBy(F.desc("value"), "seq").limit(250)


@query("k5_fanout_ready", f"""
WITH {D.VALID}, h AS (SELECT DISTINCT host, string_split(host, '.') AS l FROM valid), p AS (SELECT array_to_string(l[2:], '.') AS parent FROM h WHERE len(l) >= 3 AND NOT (length(list_extract(l, -1)) = 2 AND len(l) < 4))
SELECT parent, count(*) AS children FROM p GROUP BY parent HAVING count(*) >= 2 ORDER BY children DESC, parent LIMIT 50""")
def k5_fanout_ready(spark: SparkSession, sf: str) -> DataFrame:
    """K5: parents with several children, most first."""
    return g31_child_fanout(spark, sf).where("children >= 2").orderBy(F.desc("children"), "parent").limit(50)


_D4 = """CASE WHEN p_size % 3 = 0 THEN 1.0 WHEN p_size % 3 = 1 THEN 1.25 ELSE 1.6 END * ln(1 + greatest(1, coalesce(CASE WHEN p_partkey % 4 = 0 THEN CASE WHEN p_size % 5 >= 3 THEN 100000 END ELSE p_partkey END, 1))) * greatest(0.01, 1.0 - p_size % 10 / 10)
 * (1.0 + 0.4 + 0.5 + p_size % 5 / 5) / 4.0 * (1.0 + 4.0 * (p_size % 5 / 5)) * greatest(0.05, p_partkey % 10 / 10) / greatest(0.1, 1.0 + 0.2 + 0.1)"""


@query("k7_scout_ranking", f"SELECT p_partkey AS source, round({_D4}, 8) AS priority FROM part WHERE p_brand NOT IN ('Brand#1', 'Brand#2') ORDER BY priority DESC, source LIMIT 200")
def k7_scout_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """Sources by scout priority, without suppressed families."""
    p, s = D.table(spark, sf, "part"), F.col("p_size")
    level = F.when(s % 3 == 0, "SOURCE").when(s % 3 == 1, "COLLECTION").otherwise("METASOURCE")
    direct = (s % 5) / 5
    volume = F.when(F.col("p_partkey") % 4 != 0, F.col("p_partkey"))
    suppressed = spark.createDataFrame([("Brand#1",), ("Brand#2",)], "p_brand string")
    priority = A.scout_priority(level, volume, direct, (s % 10) / 10, F.lit(0.4), F.lit(0.5), F.lit(0.2), F.lit(0.1), (F.col("p_partkey") % 10) / 10)
    return p.join(F.broadcast(suppressed), "p_brand", "left_anti").select(F.col("p_partkey").alias("source"), F.round(priority, 8).alias("priority")).orderBy(F.desc("priority"), "source").limit(200)


_LINKS = r"""
links AS (SELECT page_url, CASE WHEN href LIKE '/%' THEN base || href END AS url, anchor FROM (
  SELECT url AS page_url, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS base, regexp_extract(a, '(?i)href="([^"]*)"', 1) AS href, regexp_extract(a, '>([^<]*)$', 1) AS anchor
  FROM (SELECT url, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*href="[^"]*"[^>]*>[^<]*')) AS a FROM pages)) WHERE href LIKE '/%' AND href NOT LIKE '%#%' AND href NOT LIKE '%/.%' AND href NOT LIKE '//%'
 UNION ALL SELECT page_url, href, anchor FROM (SELECT url AS page_url, regexp_extract(a, '(?i)href="([^"]*)"', 1) AS href, regexp_extract(a, '>([^<]*)$', 1) AS anchor
  FROM (SELECT url, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*href="[^"]*"[^>]*>[^<]*')) AS a FROM pages)) WHERE regexp_matches(href, '^https?://'))"""


@query("p4_page_links", f"WITH {_LINKS} SELECT page_url, url, anchor, count(*) AS n FROM links GROUP BY ALL")
def p4_page_links(spark: SparkSession, sf: str) -> DataFrame:
    return G.page_links(D.table(spark, sf, "pages")).groupBy("page_url", "url", "anchor").agg(F.count("*").alias("n"))


@query("g30_link_summary", f"WITH {_LINKS} SELECT regexp_extract(url, '^https?://([^/?#:]+)', 1) AS host, count(DISTINCT page_url) AS referrers, count(*) AS observations FROM links GROUP BY 1")
def g30_link_summary(spark: SparkSession, sf: str) -> DataFrame:
    links = G.page_links(D.table(spark, sf, "pages"))
    return links.groupBy(H.url_host(F.col("url")).alias("host")).agg(F.countDistinct("page_url").alias("referrers"), F.count("*").alias("observations"))


_TERMS = ", ".join(f"'{t}'" for t in H.RESOURCE_TERMS)
_METAS = ", ".join(f"'{t}'" for t in H.META_TERMS)


@query("k8_promoted_links", rf"""
WITH {_LINKS}, h AS (SELECT *, list_distinct(regexp_split_to_array(lower(regexp_extract(url, '^[^/]*//[^/]*(.*)$', 1) || ' ' || anchor), '[^a-z0-9]+')) AS tokens FROM links),
s AS (SELECT url, count(DISTINCT page_url) AS referrers, count(*) AS observations, max(len(list_intersect(tokens, [{_TERMS}]))) AS r, max(len(list_intersect(tokens, [{_METAS}]))) AS m,
  bool_or(regexp_matches(lower(regexp_extract(url, '^[^?#]*')), '\.((cdx|cdxj|warc|arc|jsonl|csv|tsv|txt|list|urls|tar)(\.gz)?|xml\.gz|tgz|zip|7z|bz2|xz)$')) AS bulk FROM h GROUP BY url)
SELECT url, CAST(CASE WHEN bulk THEN 100 ELSE 0 END + least(20, referrers * 4) + least(20, r * 5) + least(15, m * 5) + least(10, observations) AS BIGINT) AS score FROM s WHERE bulk OR referrers >= 2 ORDER BY score DESC, url LIMIT 64""")
def k8_promoted_links(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses worth a look, by an integer score."""
    return G.promoted(G.link_summary(G.page_links(D.table(spark, sf, "pages")))).select("url", "score")


@query("k13_ucb", f"""
WITH {D.RUNS}, s AS (SELECT kind AS strategy, count(*) AS episodes, round(sum(eed) / sum(cost), 6) AS rate FROM runs GROUP BY kind), t AS (SELECT sum(episodes) AS n, greatest(1.0, max(rate)) AS scale FROM s)
SELECT strategy, episodes, rate, round(rate + 0.5 * scale * sqrt(ln(n + 1.0) / episodes), 8) AS ucb FROM s, t""")
def k13_ucb(spark: SparkSession, sf: str) -> DataFrame:
    s = D.runs(spark, sf).groupBy(F.col("kind").alias("strategy")).agg(F.count("*").alias("episodes"), F.round(F.sum("eed") / F.sum("cost"), 6).alias("rate"))
    return A.ucb(s, "strategy", "episodes", "rate").withColumn("ucb", F.round("ucb", 8))


@query("k17_top_families", f"""
WITH {D.VALID}, c AS (SELECT source_id, host[1:3] AS family, count(*) AS hits FROM valid GROUP BY ALL) SELECT source_id, family, hits FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY hits DESC, family) AS rn FROM c WHERE hits >= 2) WHERE rn <= 8""")
def k17_top_families(spark: SparkSession, sf: str) -> DataFrame:
    """Of each cell at most eight families with two hits or more."""
    c = D.valid_captures(spark, sf).groupBy("source_id", F.substring("host", 1, 3).alias("family")).agg(F.count("*").alias("hits")).where("hits >= 2")
    w = Window.partitionBy("source_id").orderBy(F.desc("hits"), "family")
    return c.withColumn("rn", F.row_number().over(w)).where("rn <= 8").drop("rn")


@query("k18_top_sources", f"WITH {D.RUNS} SELECT source, round(sum(eed) / sum(cost), 6) AS rate FROM runs GROUP BY source ORDER BY rate DESC, source LIMIT 20")
def k18_top_sources(spark: SparkSession, sf: str) -> DataFrame:
    return D.runs(spark, sf).groupBy("source").agg(F.round(F.sum("eed") / F.sum("cost"), 6).alias("rate")).orderBy(F.desc("rate"), "source").limit(20)


@query("k19_recent_failures", f"""
WITH {D.RUNS}, m AS (SELECT source, round(sum(eed), 4) AS eed FROM runs GROUP BY source) SELECT run_id, source, ts, eed FROM (SELECT run_id, source, ts FROM runs WHERE kind = 'error' ORDER BY ts DESC, run_id LIMIT 40) JOIN m USING (source)""")
def k19_recent_failures(spark: SparkSession, sf: str) -> DataFrame:
    """The newest failures with what their source has yielded."""
    r = D.runs(spark, sf)
    m = r.groupBy("source").agg(F.round(F.sum("eed"), 4).alias("eed"))
    return r.where("kind = 'error'").orderBy(F.desc("ts"), "run_id").limit(40).select("run_id", "source", "ts").join(m, "source")


@query("k20_recent_origins", f"WITH {D.RUNS} SELECT source AS origin, max(ts) AS last_seen FROM runs GROUP BY source ORDER BY last_seen DESC, origin LIMIT 16")
def k20_recent_origins(spark: SparkSession, sf: str) -> DataFrame:
    return D.runs(spark, sf).groupBy(F.col("source").alias("origin")).agg(F.max("ts").alias("last_seen")).orderBy(F.desc("last_seen"), "origin").limit(16)


_SKETCH = f"""WITH {D.LOG}, v AS (SELECT DISTINCT lane || (year % 3) AS grp, host FROM log), s AS (SELECT grp, seed, min((CAST('0x' || substr(md5(host), 1, 14) AS BIGINT) + seed * CAST('0x' || substr(md5(host), 15, 14) AS BIGINT)) % 72057594037927931) AS minimum FROM v, (SELECT unnest(range(64)) AS seed) GROUP BY grp, seed) """


def _sketch(spark: SparkSession, sf: str) -> DataFrame:
    return M.minhash(D.log(spark, sf).select(F.concat("lane", F.col("year") % 3).alias("grp"), "host"), "grp", "host")


@query("m1_minhash", _SKETCH + "SELECT grp, CAST(seed AS INT) AS seed, minimum FROM s")
def m1_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return _sketch(spark, sf)


@query("m2_sketch_union", _SKETCH + "SELECT grp[1:1] AS lane, CAST(seed AS INT) AS seed, min(minimum) AS minimum FROM s GROUP BY ALL")
def m2_sketch_union(spark: SparkSession, sf: str) -> DataFrame:
    return M.union(_sketch(spark, sf).withColumn("lane", F.substring("grp", 1, 1)), "lane")


@query("m3_jaccard", _SKETCH + 'SELECT a.grp AS "left", b.grp AS "right", count(*) / 64 AS jaccard FROM s a JOIN s b ON a.seed = b.seed AND a.minimum = b.minimum AND a.grp < b.grp GROUP BY 1, 2')
def m3_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return M.similarity(_sketch(spark, sf), "grp")


_GROUPS = f"""WITH {D.LOG}, v AS (SELECT DISTINCT unnest(['l' || lane || (year % 3), source_id, 'y' || year]) AS grp, host FROM log), s AS (SELECT grp, seed, min((CAST('0x' || substr(md5(host), 1, 14) AS BIGINT) + seed * CAST('0x' || substr(md5(host), 15, 14) AS BIGINT)) % 72057594037927931) AS minimum FROM v, (SELECT unnest(range(64)) AS seed) GROUP BY grp, seed),
m AS (SELECT grp, list(minimum ORDER BY seed) AS minima FROM s GROUP BY grp), c AS (SELECT min(grp) AS grp, minima FROM m GROUP BY minima), band AS (SELECT grp, i, minima[2 * i + 1:2 * i + 2] AS key FROM c, range(32) r(i)) """


def _groups(spark: SparkSession, sf: str) -> DataFrame:
    """Sketches of the hosts of each source, year, and lane and third of years."""
    groups = F.array(F.concat(F.lit("l"), "lane", F.col("year") % 3), "source_id", F.concat(F.lit("y"), "year"))
    return M.minhash(D.log(spark, sf).select(F.explode(groups).alias("grp"), "host"), "grp", "host")


@query("m3_similar_groups", _GROUPS + """
, pairs AS (SELECT DISTINCT a.grp AS l, b.grp AS r FROM band a JOIN band b ON a.i = b.i AND a.key = b.key AND a.grp < b.grp), j AS (SELECT l, r, list_sum(list_transform(range(1, 65), lambda i: CAST(x.minima[i] = y.minima[i] AS INT))) / 64 AS jaccard FROM pairs JOIN c x ON x.grp = l JOIN c y ON y.grp = r)
SELECT l AS "left", r AS "right", jaccard FROM j WHERE jaccard >= 0.5""")
def m3_similar_groups(spark: SparkSession, sf: str) -> DataFrame:
    """M3 by bands: only groups that are likely to be similar are compared."""
    return M.similar(_groups(spark, sf), "grp")[0]


@query("m3_overlap_penalty", _GROUPS + """
, pairs AS (SELECT DISTINCT a.grp AS l, b.grp AS r FROM band a JOIN band b ON a.i = b.i AND a.key = b.key WHERE a.grp[1:1] = 's' AND b.grp[1:1] <> 's'), j AS (SELECT l, list_sum(list_transform(range(1, 65), lambda i: CAST(x.minima[i] = y.minima[i] AS INT))) / 64 AS jaccard FROM pairs JOIN c x ON x.grp = l JOIN c y ON y.grp = r)
SELECT grp, coalesce((SELECT max(jaccard) FROM j WHERE l = grp), 0) AS penalty FROM m WHERE grp[1:1] = 's'""")
def m3_overlap_penalty(spark: SparkSession, sf: str) -> DataFrame:
    """M3: how much of what is active each candidate source repeats at most."""
    sketches = _groups(spark, sf)
    return M.overlap_penalty(sketches.where("grp like 's%'"), sketches.where("grp not like 's%'"), "grp")


@query("m4_containment", _SKETCH + """
, n AS (SELECT grp, count(*) AS n FROM v GROUP BY grp), j AS (SELECT a.grp AS l, b.grp AS r, count(*) / 64 AS jaccard FROM s a JOIN s b ON a.seed = b.seed AND a.minimum = b.minimum AND a.grp < b.grp GROUP BY 1, 2)
SELECT l AS "left", r AS "right", least(x.n, y.n, jaccard * (x.n + y.n) / (1 + jaccard)) AS shared, least(1.0, least(x.n, y.n, jaccard * (x.n + y.n) / (1 + jaccard)) / x.n) AS containment FROM j JOIN n x ON x.grp = l JOIN n y ON y.grp = r""")
def m4_containment(spark: SparkSession, sf: str) -> DataFrame:
    """M4, U8: how much of each group another holds, from sketches and sizes."""
    n = D.log(spark, sf).select(F.concat("lane", F.col("year") % 3).alias("grp"), "host").distinct().groupBy("grp").agg(F.count("*").alias("n"))
    j = M.similarity(_sketch(spark, sf), "grp").join(n.select(F.col("grp").alias("left"), F.col("n").alias("x")), "left").join(n.select(F.col("grp").alias("right"), F.col("n").alias("y")), "right")
    return j.select("left", "right", M.intersection(F.col("x"), F.col("y"), F.col("jaccard")).alias("shared"), M.containment(F.col("x"), F.col("y"), F.col("jaccard")).alias("containment"))


_EDGES = "edges AS (SELECT p_partkey // 3 AS parent, p_partkey AS child FROM part WHERE p_partkey > 0), rewards AS (SELECT p_partkey AS node, p_retailprice AS reward FROM part)"
_REACH = f"WITH RECURSIVE {_EDGES}, walk(root, node, depth) AS (SELECT parent, child, 1 FROM edges UNION ALL SELECT w.root, e.child, w.depth + 1 FROM walk w JOIN edges e ON e.parent = w.node WHERE w.depth < 4), d AS (SELECT DISTINCT * FROM walk) "


def _edges(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    p = D.table(spark, sf, "part")
    return p.where("p_partkey > 0").select(F.floor(F.col("p_partkey") / 3).alias("parent"), F.col("p_partkey").alias("child")), p.select(F.col("p_partkey").alias("node"), F.col("p_retailprice").alias("reward"))


@query("p1_graph_depth", _REACH + "SELECT root, CAST(max(depth) AS INT) AS max_depth FROM d GROUP BY root")
def p1_graph_depth(spark: SparkSession, sf: str) -> DataFrame:
    return G.depth_of(_edges(spark, sf)[0], 4)


@query("p2_descendant_reward", _REACH + "SELECT root, sum(reward * pow(0.5, depth)) AS descendant_reward FROM d JOIN rewards USING (node) GROUP BY root")
def p2_descendant_reward(spark: SparkSession, sf: str) -> DataFrame:
    edges, rewards = _edges(spark, sf)
    return G.descendant_reward(edges, rewards, 4)


@query("p3_rejected_batch", """
WITH RECURSIVE e AS (SELECT s_suppkey AS parent, s_nationkey * 3 + 1 AS child, s_suppkey % 9 <> 5 AS known FROM supplier), n AS (SELECT parent AS node FROM e WHERE known),
b AS (SELECT parent, child, count(*) AS n, parent IN (SELECT node FROM n) AND child IN (SELECT node FROM n) AS known FROM e GROUP BY parent, child), g AS (SELECT parent, child FROM b WHERE parent <> child AND known),
w(root, node) AS (SELECT parent, child FROM g UNION SELECT w.root, g.child FROM w JOIN g ON g.parent = w.node),
up(node, hops) AS (SELECT child, 1 FROM g UNION SELECT g.child, hops + 1 FROM up JOIN g ON g.parent = up.node WHERE hops < 5), down(node, hops) AS (SELECT parent, 1 FROM g UNION SELECT g.parent, hops + 1 FROM down JOIN g ON g.child = down.node WHERE hops < 5)
SELECT parent, child, reason FROM (SELECT parent, child, CASE WHEN parent = child THEN 'self_edge' WHEN NOT known THEN 'unknown_node' WHEN n > 1 THEN 'duplicate' WHEN EXISTS (SELECT 1 FROM w WHERE w.root = b.child AND w.node = b.parent) THEN 'cycle'
  WHEN coalesce((SELECT max(hops) FROM up WHERE node = b.parent), 0) + 1 + coalesce((SELECT max(hops) FROM down WHERE node = b.child), 0) > 4 THEN 'depth' END AS reason FROM b) WHERE reason IS NOT NULL""")
def p3_rejected_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Cycles of any length and the limit of hops; a ninth of the nodes is planted as unknown."""
    s = D.table(spark, sf, "supplier")
    edges = s.select(F.col("s_suppkey").alias("parent"), (F.col("s_nationkey") * 3 + 1).cast("long").alias("child"))
    return G.rejected_batch(edges, s.where("s_suppkey % 9 <> 5").select(F.col("s_suppkey").alias("node")))


@query("d1_mixing_fraction", f"""
WITH {D.RUNS} SELECT run_id, CASE WHEN k % 10 = 0 OR kind = 'signup' THEN (k % 10) / 10 ELSE (1 - least(1.0, requests / 50.0)) * ((k % 10) / 10) + least(1.0, requests / 50.0) * least(0.95, greatest(0.05, CASE WHEN eed + cost <= 0 THEN (k % 10) / 10 ELSE cost / (eed + cost) END)) END AS fraction FROM runs""")
def d1_mixing_fraction(spark: SparkSession, sf: str) -> DataFrame:
    base = (F.col("k") % 10) / 10
    return D.runs(spark, sf).select("run_id", A.mixing_fraction(base, F.col("eed"), F.col("cost"), F.col("requests"), F.col("kind") != "signup").alias("fraction"))


@query("d5_production_value", f"""
WITH RECURSIVE {D.RUNS}, c AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE eed > 0) AS s FROM runs GROUP BY source), r AS (SELECT source, eed / cost AS v, row_number() OVER (PARTITION BY source ORDER BY ts DESC, run_id DESC) AS rn FROM runs),
l AS (SELECT source, v, row_number() OVER (PARTITION BY source ORDER BY rn DESC) AS i FROM r WHERE rn <= 8), e AS (SELECT source, i, v AS ewma FROM l WHERE i = 1 UNION ALL SELECT l.source, l.i, 0.6 * l.v + 0.4 * e.ewma FROM e JOIN l ON l.source = e.source AND l.i = e.i + 1),
f AS (SELECT source, arg_max(ewma, i) AS ewma FROM e GROUP BY source)
SELECT source, n, round(greatest(0.05 / sqrt(n + 1.0), (s + 1.0) / (n + 2.0) * ewma + 0.5 / sqrt(n + 1.0)), 8) AS score FROM c JOIN f USING (source)""")
def d5_production_value(spark: SparkSession, sf: str) -> DataFrame:
    """What a source yields now: success probability times the recent rate, plus exploration that shrinks."""
    r = D.runs(spark, sf)
    c = r.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("eed") > 0).alias("s"))
    j = c.join(A.recent_values(r, "source", ["ts", "run_id"], F.col("eed") / F.col("cost")), "source")
    explore = F.sqrt(F.col("n") + 1.0)
    score = F.greatest(0.05 / explore, (F.col("s") + 1.0) / (F.col("n") + 2.0) * A.ewma(F.col("values")) + 0.5 / explore)
    return j.select("source", "n", F.round(score, 8).alias("score"))


@query("s21_throughput_projection", f"""
WITH {D.RUNS}, d AS (SELECT kind, sum(eed) / 30 AS per_day FROM runs GROUP BY kind), t AS (SELECT unnest([250000, 500000, 1000000]) AS target) SELECT kind, CAST(target AS INT) AS target, round(target / per_day, 6) AS days FROM d, t""")
def s21_throughput_projection(spark: SparkSession, sf: str) -> DataFrame:
    """Days to each of three targets."""
    d = D.runs(spark, sf).groupBy("kind").agg((F.sum("eed") / 30).alias("per_day"))
    return d.select("kind", "per_day", F.explode(F.array(F.lit(250000), F.lit(500000), F.lit(1000000))).alias("target")).select("kind", "target", F.round(F.col("target") / F.col("per_day"), 6).alias("days"))

"""Queries over outcomes, credits, regions and outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearmask.functions import hosts as H
from yearmask.operators import eed as E
from yearmask.operators import graph as G
from yearmask.operators import portfolio as P
from yearmask.operators import sketch as M
from yearmask.operators import value as A
from yearmask.operators.evidence import mask_by_host
from yearmask.plans import derived as D
from yearmask.plans.flagship import b7_reconcile_candidates
from yearmask.plans.registry import query
from yearmask.sources import sinks
from yearmask.streaming.evidence import work_folder


@query("g2_weight_model", f"WITH {D.WEIGHTS} SELECT tld, CAST(weight AS DOUBLE) AS weight FROM weights")
def g2_weight_model(spark: SparkSession, sf: str) -> DataFrame:
    """Weights read from a model of parallel arrays that holds other languages too."""
    n = D.table(spark, sf, "nation").where("n_nationkey % 7 <> 3")
    share = F.when(F.col("n_nationkey") == 5, 0).otherwise(F.col("n_nationkey") * 37 % 101)
    rows = n.select(F.expr(D.TLD.format(k="n_nationkey")).alias("tld"), share.cast("string").alias("p"))
    both = rows.withColumn("lang", F.lit("eng")).unionByName(rows.withColumn("lang", F.lit("deu")))
    column = F.array_sort(F.collect_list(F.struct("tld", "lang", "p")))
    model = both.agg(column["tld"].alias("tld"), column["lang"].alias("lang"), column["p"].alias("perc_of_tld"))
    return E.english_weights(model).select("tld", F.col("weight").cast("double").alias("weight"))


@query("j17_closure_gate", f"""
WITH {D.RUNS} SELECT source, count(*) AS runs, bool_and(kind <> 'error' OR eed >= 0) AND count(*) FILTER (WHERE requests > 0) > 0 AND max(run_id) <= (SELECT max(run_id) * 0.999 FROM runs) AND count(*) >= 20 AS closed FROM runs GROUP BY source""")
def j17_closure_gate(spark: SparkSession, sf: str) -> DataFrame:
    """The four conditions under which a run may be closed; the frontier is a table of one row."""
    r = D.runs(spark, sf)
    s = r.groupBy("source").agg(F.count("*").alias("runs"), F.bool_and((F.col("kind") != "error") | (F.col("eed") >= 0)).alias("sound"), F.count_if(F.col("requests") > 0).alias("asked"), F.max("run_id").alias("last"))
    frontier = r.agg((F.max("run_id") * 0.999).alias("frontier"))
    return s.join(F.broadcast(frontier)).select("source", "runs", (F.col("sound") & (F.col("asked") > 0) & (F.col("last") <= F.col("frontier")) & (F.col("runs") >= 20)).alias("closed"))


_OUTCOMES = f"""WITH {D.RUNS}, f AS (SELECT source, arg_min(kind, run_id) AS first_kind, min(run_id) AS first_run FROM runs GROUP BY source), t AS (SELECT source, count(*) AS runs, round(sum(eed), 4) AS eed, sum(cost) AS cost FROM runs WHERE kind <> 'signup' GROUP BY source),
e AS (SELECT source, count(*) AS errors FROM runs WHERE kind = 'error' GROUP BY source), s AS (SELECT source, max(ts) AS last_success FROM runs WHERE eed > 0 GROUP BY source)
SELECT f.source, first_kind, first_run, coalesce(runs, 0) AS runs, coalesce(eed, 0) AS eed, coalesce(cost, 0) AS cost, coalesce(errors, 0) AS errors, last_success FROM f LEFT JOIN t USING (source) LEFT JOIN e USING (source) LEFT JOIN s USING (source)"""


@query("j18_source_outcomes", _OUTCOMES)
def j18_source_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """One wide row a source: its first proposal and what came of it. All tables are aggregated to a row a source
    before they are joined."""
    r = D.runs(spark, sf)
    f = r.groupBy("source").agg(F.min_by("kind", "run_id").alias("first_kind"), F.min("run_id").alias("first_run"))
    t = r.where("kind <> 'signup'").groupBy("source").agg(F.count("*").alias("runs"), F.round(F.sum("eed"), 4).alias("eed"), F.sum("cost").alias("cost"))
    e = r.where("kind = 'error'").groupBy("source").agg(F.count("*").alias("errors"))
    s = r.where("eed > 0").groupBy("source").agg(F.max("ts").alias("last_success"))
    return f.join(t, "source", "left").join(e, "source", "left").join(s, "source", "left").fillna(0, ["runs", "eed", "cost", "errors"])


@query("a25_outcome_sink", _OUTCOMES.replace(", last_success FROM f", " FROM f"))
def a25_outcome_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Outcomes written as JSON lines and read back."""
    out = j18_source_outcomes(spark, sf).drop("last_success")
    path = work_folder(spark, "outcomes")
    sinks.write_outcomes(out, path)
    return spark.read.schema(out.schema).json(path)


@query("j19_exhausted_sources", "SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_acctbal > 0 AND r_name IN ('ASIA', 'AMERICA')")
def j19_exhausted_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Active sources (positive balance) whose reservoir (region) is used up."""
    s, n, r = (D.table(spark, sf, t) for t in ("supplier", "nation", "region"))
    return s.where("s_acctbal > 0").join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r.where(F.col("r_name").isin("ASIA", "AMERICA")), F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey")


@query("j25_reward_reconciliation", f"""
WITH {D.RUNS}, m AS (SELECT run_id, k % 12 AS cell, eed AS credited, CASE WHEN run_id % 5 = 0 THEN eed / 2 ELSE eed END AS accepted FROM runs) SELECT cell, count(*) AS episodes, round(sum(accepted - credited), 4) AS delta FROM m WHERE abs(accepted - credited) > 1e-12 GROUP BY cell""")
def j25_reward_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    """What has to be added to each cell's credit, from episodes where the two differ."""
    r = D.runs(spark, sf)
    cell = r.select("run_id", (F.col("k") % 12).alias("cell"), F.col("eed").alias("credited"))
    episode = r.select("run_id", F.when(F.col("run_id") % 5 == 0, F.col("eed") / 2).otherwise(F.col("eed")).alias("accepted"))
    differ = F.abs(F.col("accepted") - F.col("credited")) > 1e-12
    return episode.join(cell, "run_id").where(differ).groupBy("cell").agg(F.count("*").alias("episodes"), F.round(F.sum(F.col("accepted") - F.col("credited")), 4).alias("delta"))


@query("j28_stale_credit", f"""
WITH {D.RUNS}, a AS (SELECT k AS episode, CASE WHEN run_id % 4 = 0 THEN NULL ELSE concat('sig', run_id % 2) END AS signature, run_id % 7 = 0 AS legacy, source, eed AS credit FROM runs), final AS (SELECT DISTINCT source FROM runs WHERE kind = 'purchase'),
s AS (SELECT episode, sum(credit) AS stale FROM a WHERE (NOT legacy AND coalesce(signature, '') <> 'sig1') OR (legacy AND source NOT IN (SELECT source FROM final)) GROUP BY episode), t AS (SELECT episode, sum(credit) * 0.8 AS total FROM a GROUP BY episode)
SELECT episode, round(greatest(0, total - coalesce(stale, 0)), 4) AS credit FROM t LEFT JOIN s USING (episode)""")
def j28_stale_credit(spark: SparkSession, sf: str) -> DataFrame:
    """Credit of each episode less what another authority gave, not below zero."""
    r, i = D.runs(spark, sf), F.col("run_id")
    a = r.select(F.col("k").alias("episode"), F.when(i % 4 != 0, F.concat(F.lit("sig"), i % 2)).alias("signature"), (i % 7 == 0).alias("legacy"), "source", F.col("eed").alias("credit"))
    final = r.where("kind = 'purchase'").select("source").distinct()
    other = a.where(~F.col("legacy") & ~F.col("signature").eqNullSafe(F.lit("sig1")))
    orphan = a.where("legacy").join(final, "source", "left_anti")
    stale = other.select("episode", "credit").unionByName(orphan.select("episode", "credit")).groupBy("episode").agg(F.sum("credit").alias("stale"))
    total = a.groupBy("episode").agg((F.sum("credit") * 0.8).alias("total"))
    return total.join(stale, "episode", "left").select("episode", F.round(F.greatest(F.lit(0.0), F.col("total") - F.coalesce("stale", F.lit(0.0))), 4).alias("credit"))


@query("j30_search_cells", "SELECT n_name AS institution, mechanism, period FROM nation, (SELECT unnest(['list', 'dump', 'index']) AS mechanism), (SELECT unnest([1996, 1998, 2000]) AS period)")
def j30_search_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The seed space of all nations, exploded from lists inside each row."""
    nations = D.table(spark, sf, "nation")
    n = nations.select(F.col("n_name").alias("institution"), F.explode(F.array(F.lit("list"), F.lit("dump"), F.lit("index"))).alias("mechanism"))
    return n.select("institution", "mechanism", F.explode(F.array(F.lit(1996), F.lit(1998), F.lit(2000))).alias("period"))


@query("k6_registration_ready", f"""
WITH {D.VALID}, h AS (SELECT DISTINCT host, string_split(host, '.') AS l FROM valid), p AS (SELECT array_to_string(CASE WHEN length(list_extract(l, -1)) = 2 THEN l[-3:] ELSE l[-2:] END, '.') AS parent, host FROM h WHERE len(l) >= CASE WHEN length(list_extract(l, -1)) = 2 THEN 3 ELSE 2 END)
SELECT parent, count(*) AS hosts, bool_or(host = parent) AS self_observed FROM p GROUP BY parent HAVING bool_or(host = parent) OR count(*) >= 2 ORDER BY hosts DESC, parent LIMIT 80""")
def k6_registration_ready(spark: SparkSession, sf: str) -> DataFrame:
    """K6: parents worth a registration look-up: seen themselves or with several children."""
    h = D.valid_captures(spark, sf).select("host").distinct().withColumn("parent", H.registrable_parent(F.col("host"))).where("parent is not null")
    g = h.groupBy("parent").agg(F.count("*").alias("hosts"), F.bool_or(F.col("host") == F.col("parent")).alias("self_observed"))
    return g.where("self_observed or hosts >= 2").orderBy(F.desc("hosts"), "parent").limit(80)


@query("k9_lease_ranking", f"""
WITH {D.RUNS} SELECT run_id, round(eed / greatest(0.000001, greatest(cost / 10, requests / 4.0, k / 50.0)), 8) AS rate FROM runs ORDER BY rate DESC, run_id LIMIT 100""")
def k9_lease_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """K9: value by the scarcest resource that a candidate takes."""
    scarce = F.greatest(F.col("cost") / 10, F.col("requests") / 4.0, F.col("k") / 50.0)
    return D.runs(spark, sf).select("run_id", F.round(F.col("eed") / F.greatest(F.lit(1e-6), scarce), 8).alias("rate")).orderBy(F.desc("rate"), "run_id").limit(100)


@query("k10_region_actions", """
WITH r AS (SELECT p_partkey AS region, CASE WHEN p_partkey > 0 AND p_size > 10 THEN p_partkey // 3 END AS parent, p_retailprice AS eed, p_size * 100000 AS bytes_read, p_partkey % 10 / 10 AS confidence FROM part),
d AS (SELECT region, coalesce(eed / nullif(bytes_read, 0), 0) * 1048576.0::DOUBLE AS density, confidence FROM r WHERE region NOT IN (SELECT parent FROM r WHERE parent IS NOT NULL))
SELECT region, round(density + (1 - confidence) * greatest(1, density), 8) AS priority FROM d ORDER BY priority DESC, region LIMIT 64""")
def k10_region_actions(spark: SparkSession, sf: str) -> DataFrame:
    p, k = D.table(spark, sf, "part"), F.col("p_partkey")
    regions = p.select(k.alias("region"), F.when((k > 0) & (F.col("p_size") > 10), F.floor(k / 3)).alias("parent"), F.col("p_retailprice").alias("eed"), (F.col("p_size") * 100000).alias("bytes_read"), (k % 10 / 10).alias("confidence"))
    return P.leaf_actions(regions, 64).select("region", "priority")


def written(df: DataFrame, what: str) -> DataFrame:
    path = work_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_REGION_PICKS, _BUDGET_SHARE = 6, 4


def _greedy_sql() -> str:
    """The picks one after the other, each from the sketches and sizes of those before it."""
    steps = ["won0 AS MATERIALIZED (SELECT NULL::INT AS pick, NULL::VARCHAR AS region, 0::DOUBLE AS bytes, 0::DOUBLE AS fresh, 0::DOUBLE AS added WHERE FALSE)"]
    for i in range(_REGION_PICKS):
        steps.append(f"u{i} AS MATERIALIZED (SELECT seed, min(minimum) AS u FROM sketch WHERE region IN (SELECT region FROM won{i}) GROUP BY seed)")
        steps.append(f"c{i} AS MATERIALIZED (SELECT coalesce(sum(bytes), 0) AS spent, coalesce(sum(fresh), 0) AS covered FROM won{i})")
        steps.append(f"""j{i} AS MATERIALIZED (SELECT region, count(*) FILTER (WHERE minimum = u) / 64 AS j FROM sketch JOIN u{i} USING (seed) GROUP BY region)""")
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r.region, items, bytes, least(items, covered, coalesce(j, 0) * (items + covered) / (1 + coalesce(j, 0))) AS shared, eed FROM r LEFT JOIN j{i} USING (region), c{i} WHERE bytes > 0 AND eed > 0 AND bytes <= budget - spent AND r.region NOT IN (SELECT region FROM won{i}))""")
        best = f"SELECT {i} AS pick, region, bytes, greatest(0, items - shared) AS fresh, round(eed * greatest(0, 1 - least(1, shared / items)), 8) AS added, round(eed * greatest(0, 1 - least(1, shared / items)) / bytes, 12) AS rate FROM a{i}"
        steps.append(f"won{i + 1} AS MATERIALIZED (SELECT * FROM won{i} UNION ALL (SELECT pick, region, bytes, fresh, added FROM ({best}) WHERE added > 0 ORDER BY rate DESC, region LIMIT 1))")
    return ", ".join(steps)


@query("k11_greedy_portfolio", f"""
WITH {D.LOG}, hashed AS (SELECT DISTINCT source_id AS region, CAST('0x' || substr(md5(host), 1, 14) AS BIGINT) AS a, CAST('0x' || substr(md5(host), 15, 14) AS BIGINT) AS b FROM log),
sketch AS MATERIALIZED (SELECT region, seed, min((a + seed * b) % 72057594037927931) AS minimum FROM hashed, (SELECT unnest(range(64)) AS seed) GROUP BY region, seed),
g AS (SELECT source_id AS region, CAST(count(DISTINCT host) AS DOUBLE) AS items, CAST(sum(n) AS DOUBLE) AS eed, count(*) * 100.0::DOUBLE AS bytes FROM log GROUP BY source_id),
r AS MATERIALIZED (SELECT *, (SELECT sum(bytes) FROM g) / {_BUDGET_SHARE} AS budget FROM g), {_greedy_sql()} SELECT pick, region, added FROM won{_REGION_PICKS}""")
def k11_greedy_portfolio(spark: SparkSession, sf: str) -> DataFrame:
    """The regions (sources) of a portfolio in the order of their picks."""
    rows = D.log(spark, sf)
    regions = rows.groupBy(F.col("source_id").alias("region")).agg(F.countDistinct("host").alias("items"), F.sum("n").alias("eed"), (F.count("*") * 100.0).alias("bytes"))
    sketch = M.minhash(rows.select(F.col("source_id").alias("region"), "host"), "region", "host")
    # each pick asks both again: written once, so the log is scanned and hashed once
    regions, sketch = written(regions, "regions"), written(sketch, "sketch")
    budget = (regions.agg(F.sum("bytes")).first()[0] or 0.0) / _BUDGET_SHARE
    picked = P.greedy(regions, sketch, _REGION_PICKS, budget)
    return spark.createDataFrame([(i, r["region"], float(r["added"])) for i, r in enumerate(picked)], "pick int, region string, added double")


@query("k14_value_ranking", f"""
WITH RECURSIVE {D.RUNS}, edges AS (SELECT DISTINCT source AS parent, concat('src', (user_id * 7 + 3) % 50) AS child FROM runs JOIN events ON run_id = event_id), h AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE eed > 0) AS s, sum(eed) AS e, sum(cost) AS c FROM runs GROUP BY source),
walk(root, node, depth) AS (SELECT parent, child, 1 FROM edges UNION ALL SELECT w.root, e.child, w.depth + 1 FROM walk w JOIN edges e ON e.parent = w.node WHERE w.depth < 3), d AS (SELECT root, sum(e * pow(0.5, depth)) AS reward FROM (SELECT DISTINCT * FROM walk) JOIN h ON source = node GROUP BY root)
SELECT h.source, round(((s + 1.0::DOUBLE) / (n + 2.0::DOUBLE) * e + coalesce(reward, 0) + greatest(1, e) / sqrt(n + 1.0)) * (1 - n % 5 / 10) / c, 8) AS score FROM h LEFT JOIN d ON d.root = h.source""")
def k14_value_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """K14, D3 with the descendants that all events show."""
    return value_ranking(spark, sf, D.table(spark, sf, "events"))


def value_ranking(spark: SparkSession, sf: str, events: DataFrame) -> DataFrame:
    """Direct value, discounted value of descendants and uncertainty, less overlap, by cost."""
    edges = events.select(F.concat(F.lit("src"), F.col("user_id") % 50).alias("parent"), F.concat(F.lit("src"), (F.col("user_id") * 7 + 3) % 50).alias("child")).distinct()
    h = D.runs(spark, sf).groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("eed") > 0).alias("s"), F.sum("eed").alias("e"), F.sum("cost").alias("c"))
    d = G.descendant_reward(edges, h.select(F.col("source").alias("node"), F.col("e").alias("reward")), 3).withColumnRenamed("root", "source")
    score = A.source_value((F.col("s") + 1.0) / (F.col("n") + 2.0) * F.col("e"), F.coalesce("descendant_reward", F.lit(0.0)), F.greatest(F.lit(1.0), F.col("e")) / F.sqrt(F.col("n") + 1.0), F.col("n") % 5 / 10, F.col("c"))
    return h.join(d, "source", "left").select("source", F.round(score, 8).alias("score"))


@query("a22_annual_output", f"WITH {D.VALID} SELECT year, count(DISTINCT host) AS lines FROM valid GROUP BY year")
def a22_annual_output(spark: SparkSession, sf: str) -> DataFrame:
    """The ordered annual lists, written, read back and counted."""
    path = work_folder(spark, "annual")
    sinks.write_annual(D.valid_captures(spark, sf), path)
    return spark.read.text(path).groupBy(F.col("year").cast("int").alias("year")).agg(F.count("*").alias("lines"))


@query("a22_submission_audit", f"""
WITH {D.VALID}, f AS (SELECT host, year, arg_min(kind, seq) AS lane FROM valid GROUP BY host, year), m AS (SELECT host, {D.BITS} AS m FROM valid WHERE status <> 'P' GROUP BY host)
SELECT year, count(*) AS lines, count(*) AS evidence_rows, 0 AS unproven, 0 AS unlisted, count(*) FILTER (WHERE coalesce(m, 0) & CAST(1 << CAST(year - 1996 AS INT) AS INT) = 0) AS not_allowed, 0 AS files_out_of_order,
 count(*) FILTER (WHERE coalesce(m, 0) & CAST(1 << CAST(year - 1996 AS INT) AS INT) = 0) = 0 AS sound FROM f LEFT JOIN m USING (host) GROUP BY year""")
def a22_submission_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Lists, evidence rows and lane counts, written and audited as they are read back. What is allowed is what
    orders that aren't under way show, so the audit has something to find."""
    rows = D.valid_captures(spark, sf)
    path = work_folder(spark, "submission")
    sinks.write_submission(rows.withColumn("lane", F.col("kind")), path)
    return sinks.audit_submission(spark, path, mask_by_host(rows.where("status <> 'P'")))


@query("a22_lane_counts", f"WITH {D.VALID}, f AS (SELECT host, year, arg_min(kind, seq) AS lane FROM valid GROUP BY host, year) SELECT year, lane, count(*) AS host_years FROM f GROUP BY year, lane")
def a22_lane_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The host-years of each year and lane, as they are written beside the lists."""
    path = work_folder(spark, "submission")
    lanes = sinks.write_submission(D.valid_captures(spark, sf).withColumn("lane", F.col("kind")), path)
    return spark.read.schema(lanes.schema).parquet(f"{path}/lanes")


@query("a24_file_digests", f"""
WITH {D.VALID}, h AS (SELECT DISTINCT year, seq // 8192 AS chunk, seq, host FROM valid)
SELECT year, CAST(chunk AS BIGINT) AS chunk, CAST(sum(strlen(host) + 1) AS BIGINT) AS length, sha256(string_agg(host || chr(10), '' ORDER BY seq)) AS sha256 FROM h GROUP BY year, chunk""")
def a24_file_digests(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes and digests of files of hosts, one for a year's captures of some orders."""
    path = work_folder(spark, "digests")
    rows = D.valid_captures(spark, sf).select("year", F.floor(F.col("seq") / 8192).alias("chunk"), "seq", F.col("host").alias("value"))
    rows.repartition("year", "chunk").sortWithinPartitions("year", "chunk", "seq").drop("seq").write.partitionBy("year", "chunk").text(path)
    told = [F.regexp_extract("path", rf"{name}=(\d+)/", 1).cast(kind).alias(name) for name, kind in (("year", "int"), ("chunk", "long"))]
    return sinks.manifest(spark, f"{path}/*/*/*").select(*told, "length", "sha256")


@query("a23_candidate_output", f"""
WITH {D.BASE}, r AS (SELECT coalesce(host, raw) AS h, CASE WHEN host IS NULL THEN 'unparsed' WHEN seq % 11 = 0 THEN 'reference' WHEN seq % 13 = 0 THEN 'excluded' ELSE 'active' END AS bucket, host FROM captures)
SELECT bucket, count(DISTINCT h) AS hosts FROM r WHERE bucket <> 'active' OR host NOT IN (SELECT host FROM baseline) GROUP BY bucket""")
def a23_candidate_output(spark: SparkSession, sf: str) -> DataFrame:
    """The candidate lists, written and read back."""
    path = work_folder(spark, "candidates")
    sinks.write_candidates(b7_reconcile_candidates(spark, sf), path)
    return spark.read.text(path).groupBy("bucket").agg(F.count("*").alias("hosts"))


@query("a24_input_manifest")
def a24_input_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes and digests of the annual lists that A22 writes: one row a file, so no SQL twin."""
    path = work_folder(spark, "annual")
    sinks.write_annual(D.valid_captures(spark, sf), path)
    files = sinks.manifest(spark, f"{path}/*/*.txt")
    return files.select(F.regexp_extract("path", r"(year=\d{4})", 1).alias("list"), "length", "sha256")


@query("b8_role_aware_admission", """
WITH p AS (SELECT p_partkey, ['SOURCE', 'COLLECTION', 'METASOURCE'][p_size % 3 + 1] AS level, p_partkey % 9 = 0 AS direct_entry, CASE WHEN p_partkey % 7 = 0 THEN 0.5 ELSE 0.0 END AS direct_prior, CASE WHEN p_partkey % 11 <> 0 THEN p_partkey END AS volume,
 p_size % 10 / 10 AS enumerable, p_partkey % 10 / 10 AS confidence, CASE WHEN p_size % 4 <> 0 THEN 1990 + p_size % 16 END AS year_from FROM part), f AS (SELECT *, level <> 'SOURCE' AS gateway FROM p)
SELECT p_partkey, CASE WHEN direct_prior > 0 AND NOT direct_entry THEN 'direct_prior_not_authoritative' WHEN volume IS NULL THEN 'volume_missing' WHEN volume < CASE WHEN direct_entry THEN 1 WHEN gateway THEN 10 ELSE 1000 END THEN 'volume_below_floor'
 WHEN enumerable < CASE WHEN gateway AND NOT direct_entry THEN 0.3 ELSE 0.5 END THEN 'not_enumerable' WHEN confidence < 0.2 THEN 'low_confidence' WHEN year_from IS NULL AND NOT direct_entry THEN 'years_missing' WHEN year_from + 2 < 1996 OR year_from > 2001 THEN 'years_off_target' ELSE 'admitted' END AS reason FROM f""")
def b8_role_aware_admission(spark: SparkSession, sf: str) -> DataFrame:
    p, k, s = D.table(spark, sf, "part"), F.col("p_partkey"), F.col("p_size")
    year = F.when(s % 4 != 0, s % 16 + 1990)
    reason = P.admission(F.element_at(F.array(*map(F.lit, ("SOURCE", "COLLECTION", "METASOURCE"))), s % 3 + 1), k % 9 == 0, F.when(k % 7 == 0, 0.5).otherwise(0.0), F.when(k % 11 != 0, k), s % 10 / 10, k % 10 / 10, year, year + 2)
    return p.select("p_partkey", F.coalesce(reason, F.lit("admitted")).alias("reason"))


@query("b12_region_rules", """
WITH r AS (SELECT p_partkey, p_size % 5 = 0 AS complete, p_partkey % 4 AS novel, p_partkey % 4 / 50 AS fraction, p_retailprice / 500 AS eed_per_mib, p_size * 4 AS observed, p_partkey % 10 / 10 AS confidence FROM part)
SELECT p_partkey, CASE WHEN NOT complete AND CASE WHEN novel > 0 THEN fraction >= 0.01 OR eed_per_mib >= 1.0 ELSE observed < 100 OR confidence < 0.9 END THEN 'refine' WHEN novel > 0 AND fraction >= 0.01 AND eed_per_mib >= 1.0 THEN 'harvest' ELSE 'drop' END AS decision FROM r""")
def b12_region_rules(spark: SparkSession, sf: str) -> DataFrame:
    p, k, s = D.table(spark, sf, "part"), F.col("p_partkey"), F.col("p_size")
    novel, fraction, density = k % 4, k % 4 / 50, F.col("p_retailprice") / 500
    return p.select("p_partkey", F.when(P.refine(s % 5 == 0, novel, fraction, density, s * 4, k % 10 / 10), "refine").when(P.worth_harvest(novel, fraction, density), "harvest").otherwise("drop").alias("decision"))


@query("m5_covered_union", f"""
WITH {D.LOG}, v AS (SELECT DISTINCT host FROM log WHERE lane IN ('N', 'R')) SELECT CAST(seed AS INT) AS seed, min((CAST('0x' || substr(md5(host), 1, 14) AS BIGINT) + seed * CAST('0x' || substr(md5(host), 15, 14) AS BIGINT)) % 72057594037927931) AS minimum FROM v, (SELECT unnest(range(64)) AS seed) GROUP BY seed""")
def m5_covered_union(spark: SparkSession, sf: str) -> DataFrame:
    """M5: the sketch of everything harvested so far (two lanes), from the sketches of the parts."""
    sketch = M.minhash(D.log(spark, sf).where(F.col("lane").isin("N", "R")).select("lane", "host"), "lane", "host")
    return M.union(sketch.withColumn("all", F.lit(1)), "all").select("seed", "minimum")

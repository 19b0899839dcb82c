"""Core reports: baselines, novelty, weights, masks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearmask.functions import hosts as H
from yearmask.operators import eed as E
from yearmask.operators import evidence as V
from yearmask.operators import sampling as S
from yearmask.operators.value import posterior
from yearmask.plans import derived as D
from yearmask.plans.registry import query
from yearmask.sources.index import BaselineIndex, input_digest


@query("novel_eed_report", f"""
WITH {D.BASE}, {D.WEIGHTS}, novel AS (SELECT DISTINCT host, year FROM valid EXCEPT SELECT host, year FROM baseline)
SELECT year, {D.TLD_OF} AS tld, count(*) AS host_years, CAST(sum(coalesce(weight, 0)) AS DOUBLE) AS eed
FROM novel LEFT JOIN weights ON weights.tld = {D.TLD_OF} GROUP BY 1, 2""")
def novel_eed_report(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship (G4, U1, J1, J2): weighted novel host-years by year and TLD."""
    novel = V.novel_host_years(D.valid_captures(spark, sf), D.baseline(spark, sf)).withColumn("tld", H.tld(F.col("host")))
    counts = novel.groupBy("year", "tld").agg(F.count("*").alias("host_years")).join(D.weights(spark, sf), "tld", "left")
    return counts.select("year", "tld", "host_years", (F.col("host_years").cast("decimal(18,0)") * F.coalesce("weight", F.lit(0)).cast(E.WEIGHT)).cast("double").alias("eed"))


@query("a2_baseline_masks", f"WITH {D.VALID} SELECT host, {D.BITS} AS year_mask FROM valid GROUP BY host")
def a2_baseline_masks(spark: SparkSession, sf: str) -> DataFrame:
    return V.mask_by_host(D.valid_captures(spark, sf))


@query("a26_baseline_manifest", f"""
WITH {D.CAPTURES}, {D.WEIGHTS} SELECT year, count(*) AS lines, count(DISTINCT host) AS hosts, count(DISTINCT CASE WHEN host IS NULL THEN raw END) AS invalid,
 CAST((SELECT sum(coalesce(weight, 0)) FROM (SELECT DISTINCT host FROM captures c WHERE c.year = o.year AND host IS NOT NULL) x LEFT JOIN weights ON weights.tld = list_extract(string_split(x.host, '.'), -1)) AS DOUBLE) AS eed
FROM captures o GROUP BY year""")
def a26_baseline_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Lines, hosts, invalid names and EED of each annual list."""
    rows = D.captures(spark, sf)
    counts = rows.groupBy("year").agg(F.count("*").alias("lines"), F.countDistinct("host").alias("hosts"), F.countDistinct(F.when(F.col("host").isNull(), F.col("raw"))).alias("invalid"))
    distinct = rows.where("host is not null").select("year", "host").distinct().withColumn("tld", H.tld(F.col("host")))
    weighed = distinct.groupBy("year", "tld").agg(F.count("*").alias("n")).join(D.weights(spark, sf), "tld", "left").groupBy("year").agg(E.eed(F.col("n"), F.col("weight")).cast("double").alias("eed"))
    return counts.join(weighed, "year", "left")


@query("g1_eed_by_tld", f"""
WITH {D.CAPTURES}, {D.WEIGHTS}, u AS (SELECT DISTINCT host FROM captures WHERE host IS NOT NULL)
SELECT {D.TLD_OF} AS tld, count(*) AS hosts, CAST(sum(coalesce(weight, 0)) AS DOUBLE) AS eed, CASE WHEN max(weights.tld) IS NULL THEN 'unmatched' ELSE 'matched' END AS model_status
FROM u LEFT JOIN weights ON weights.tld = {D.TLD_OF} GROUP BY 1""")
def g1_eed_by_tld(spark: SparkSession, sf: str) -> DataFrame:
    return E.by_tld(D.captures(spark, sf), D.weights(spark, sf), "raw")


@query("g1_eed_summary", f"""
WITH {D.CAPTURES}, {D.WEIGHTS}, u AS (SELECT DISTINCT lower(trim(raw)) AS v, host FROM captures)
SELECT count(*) AS unique_nonempty, count(host) AS valid, count(*) - count(host) AS invalid, count(weight) AS matched, count(host) - count(weight) AS unmatched,
       100.0 * count(weight) / count(host) AS coverage_percent, CAST(sum(weight) AS DOUBLE) AS eed
FROM u LEFT JOIN weights ON weights.tld = {D.TLD_OF}""")
def g1_eed_summary(spark: SparkSession, sf: str) -> DataFrame:
    return E.summary(D.captures(spark, sf), D.weights(spark, sf), "raw")


_G3 = f"WITH {D.LOG}, {D.WEIGHTS}, u AS (SELECT DISTINCT host, year, source_id, lane FROM log) "


@query("g3_annual_eed", _G3 + f"""
SELECT year, source_id, lane, CAST(grouping(lane, source_id, year) AS INT) AS level, count(*) AS host_years, CAST(sum(coalesce(weight, 0)) AS DOUBLE) AS eed
FROM u LEFT JOIN weights ON weights.tld = {D.TLD_OF} GROUP BY GROUPING SETS ((year), (source_id), (lane), ())""")
def g3_annual_eed(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct (host, year, source, lane) weighed by year, source, lane and in total."""
    rows = D.log(spark, sf).select("host", "year", "source_id", "lane").distinct()
    return E.report(rows, D.weights(spark, sf), [["year"], ["source_id"], ["lane"], []])


@query("g38_lane_contribution", f"""
WITH {D.LOG}, {D.WEIGHTS}, u AS (SELECT DISTINCT host, year, lane FROM log)
SELECT lane, year, count(*) AS host_years, CAST(sum(coalesce(weight, 0)) AS DOUBLE) AS eed FROM u LEFT JOIN weights ON weights.tld = {D.TLD_OF} GROUP BY lane, year""")
def g38_lane_contribution(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.log(spark, sf).select("host", "year", "lane").distinct()
    return E.report(rows, D.weights(spark, sf), [["lane", "year"]]).drop("level")


@query("g4_readiness", f"""
WITH {D.BASE}, {D.WEIGHTS}, a AS (SELECT DISTINCT host, year FROM valid),
w AS (SELECT a.year, a.host, b.host IS NULL AS novel, coalesce(weight, 0) AS weight FROM a LEFT JOIN baseline b USING (host, year) LEFT JOIN weights ON weights.tld = list_extract(string_split(a.host, '.'), -1))
SELECT year, count(*) AS accepted, count(*) FILTER (WHERE novel) AS novel, CAST(coalesce(sum(weight) FILTER (WHERE novel), 0) AS DOUBLE) AS novel_eed,
       CAST(sum(weight) FILTER (WHERE NOT novel) AS DOUBLE) AS baseline_eed, coalesce(sum(weight) FILTER (WHERE novel), 0) >= sum(weight) FILTER (WHERE NOT novel) * CAST(0.05 AS DECIMAL(6,4)) AS passes
FROM w GROUP BY year""")
def g4_readiness(spark: SparkSession, sf: str) -> DataFrame:
    """Per year accepted and novel host-years, EED of both sides, and the 5 % gate, exactly."""
    known = D.baseline(spark, sf).withColumn("known", F.lit(True))
    rows = D.valid_captures(spark, sf).select("host", "year").distinct().join(known, ["host", "year"], "left").withColumn("tld", H.tld(F.col("host"))).join(D.weights(spark, sf), "tld", "left")
    w = F.coalesce("weight", F.lit(0)).cast(E.WEIGHT)
    novel = F.col("known").isNull()
    out = rows.groupBy("year").agg(F.count("*").alias("accepted"), F.count_if(novel).alias("novel"), F.coalesce(F.sum(F.when(novel, w)), F.lit(0)).alias("n"), F.sum(F.when(~novel, w)).alias("b"))
    return out.select("year", "accepted", "novel", F.col("n").cast("double").alias("novel_eed"), F.col("b").cast("double").alias("baseline_eed"), E.passes(F.col("n"), F.col("b"), "0.05").alias("passes"))


@query("g5_capture_summary", f"""
WITH {D.VALID} SELECT host, {D.BITS} AS year_mask, count(*) AS captures, arg_min(raw, seq) AS first_locator, arg_max(raw, seq) AS last_locator FROM valid GROUP BY host""")
def g5_capture_summary(spark: SparkSession, sf: str) -> DataFrame:
    return V.capture_summary(D.valid_captures(spark, sf), "seq", "raw")


@query("g6_witnesses", f"""
WITH {D.VALID}, f AS (SELECT host, year, min(seq) AS seq FROM valid GROUP BY host, year)
SELECT host, string_agg(concat(year, ':', seq), ',' ORDER BY year) AS witnesses FROM f GROUP BY host""")
def g6_witnesses(spark: SparkSession, sf: str) -> DataFrame:
    out = V.witnesses(D.valid_captures(spark, sf), "seq", ["seq"])
    return out.select("host", F.array_join(F.transform("witnesses", lambda w: F.concat(w.year, F.lit(":"), w.seq)), ",").alias("witnesses"))


_G7 = f"WITH {D.VALID}, w AS (SELECT host, seq % 4 AS win, {D.BITS} AS year_mask, count(*) AS n FROM valid GROUP BY host, seq % 4) "


@query("g7_merge_windows", _G7 + "SELECT host, CAST(bit_or(year_mask) AS INT) AS year_mask, CAST(sum(n) AS BIGINT) AS captures FROM w GROUP BY host")
def g7_merge_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Masks of sample windows merged."""
    windows = D.valid_captures(spark, sf).groupBy("host", (F.col("seq") % 4).alias("win")).agg(F.bit_or(H.bit(F.col("year"))).alias("year_mask"), F.count("*").alias("n"))
    return windows.groupBy("host").agg(F.bit_or("year_mask").alias("year_mask"), F.sum("n").alias("captures"))


@query("g8_region_synopsis", f"""
WITH {D.BASE}, {D.WEIGHTS}, p AS (SELECT source_id, host, year, count(*) AS n FROM valid GROUP BY ALL),
q AS (SELECT p.*, b.host IS NULL AS novel, coalesce(weight, 0) AS weight FROM p LEFT JOIN baseline b USING (host, year) LEFT JOIN weights ON weights.tld = list_extract(string_split(p.host, '.'), -1))
SELECT source_id, CAST(sum(n) AS BIGINT) AS records, count(DISTINCT host) AS hosts, count(DISTINCT CASE WHEN novel THEN host END) AS novel_hosts, count(*) AS pairs, count(*) FILTER (WHERE novel) AS novel_pairs,
       CAST(coalesce(sum(weight) FILTER (WHERE novel), 0) AS DOUBLE) AS novel_eed,
       (SELECT string_agg(concat(year, '=', c), ',' ORDER BY year) FROM (SELECT year, count(*) AS c FROM q q2 WHERE q2.source_id = q.source_id GROUP BY year)) AS year_histogram
FROM q GROUP BY source_id""")
def g8_region_synopsis(spark: SparkSession, sf: str) -> DataFrame:
    """Records, hosts, pairs, novelty, EED and a year histogram of each region."""
    pairs = D.valid_captures(spark, sf).groupBy("source_id", "host", "year").agg(F.count("*").alias("n"))
    known = D.baseline(spark, sf).withColumn("known", F.lit(True))
    q = pairs.join(known, ["host", "year"], "left").withColumn("tld", H.tld(F.col("host"))).join(D.weights(spark, sf), "tld", "left")
    novel, w = F.col("known").isNull(), F.coalesce("weight", F.lit(0)).cast(E.WEIGHT)
    per_year = q.groupBy("source_id", "year").agg(F.count("*").alias("c")).groupBy("source_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("year", "c"))), lambda x: F.concat(x.year, F.lit("="), x.c)), ",").alias("year_histogram"))
    out = q.groupBy("source_id").agg(
        F.sum("n").alias("records"), F.countDistinct("host").alias("hosts"), F.countDistinct(F.when(novel, F.col("host"))).alias("novel_hosts"), F.count("*").alias("pairs"), F.count_if(novel).alias("novel_pairs"),
        F.coalesce(F.sum(F.when(novel, w)), F.lit(0)).cast("double").alias("novel_eed"),
    )
    return out.join(per_year, "source_id")


_RESOLVE = f"WITH {D.BASE}, m AS (SELECT host, {D.BITS} AS year_mask FROM baseline GROUP BY host), c AS (SELECT DISTINCT host FROM valid WHERE provider = 'ia') "


@query("j1_batch_resolve", _RESOLVE + """
SELECT h.host, coalesce(m.year_mask, 0) AS baseline_mask, c.host IS NOT NULL AS is_candidate FROM (SELECT DISTINCT host FROM valid) h LEFT JOIN m USING (host) LEFT JOIN c USING (host)""")
def j1_batch_resolve(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.valid_captures(spark, sf)
    return V.resolve(rows.select("host").distinct(), V.mask_by_host(D.baseline(spark, sf)), rows.where("provider = 'ia'"))


@query("j1_index_resolve", _RESOLVE + """
SELECT h.host, coalesce(m.year_mask, 0) AS baseline_mask, c.host IS NOT NULL AS is_candidate FROM (SELECT DISTINCT host FROM valid) h LEFT JOIN m USING (host) LEFT JOIN c USING (host)""")
def j1_index_resolve(spark: SparkSession, sf: str) -> DataFrame:
    """The index is written for a state of the input once; later calls only probe it."""
    rows = D.valid_captures(spark, sf)
    return baseline_index(spark, sf).resolve(rows.select("host").distinct())


def baseline_index(spark: SparkSession, sf: str) -> BaselineIndex:
    rows = D.valid_captures(spark, sf)
    index = BaselineIndex.named(spark, input_digest(spark, f"{sf}/orders.parquet", f"{sf}/customer.parquet"))
    return index.build(D.baseline(spark, sf), rows.where("provider = 'ia'").select("host"))


@query("j2_novel_masks", _RESOLVE + f"""
, e AS (SELECT host, {D.BITS} AS year_mask FROM valid GROUP BY host)
SELECT host, CAST(e.year_mask & ~coalesce(m.year_mask, 0) & 63 AS INT) AS novel_mask, e.year_mask FROM e LEFT JOIN m USING (host) WHERE e.year_mask & ~coalesce(m.year_mask, 0) & 63 <> 0""")
def j2_novel_masks(spark: SparkSession, sf: str) -> DataFrame:
    """Masks minus the baseline."""
    return V.subtract(V.mask_by_host(D.valid_captures(spark, sf)), V.mask_by_host(D.baseline(spark, sf)))


@query("j8_candidate_overlap", f"WITH {D.BASE} SELECT count(DISTINCT v.host) AS overlap FROM valid v WHERE provider = 'rdap' AND v.host IN (SELECT host FROM baseline)")
def j8_candidate_overlap(spark: SparkSession, sf: str) -> DataFrame:
    pool = D.valid_captures(spark, sf).where("provider = 'rdap'").select("host").distinct()
    return pool.join(D.baseline(spark, sf).select("host"), "host", "left_semi").agg(F.count("*").alias("overlap"))


@query("u2_distinct_hosts", f"WITH {D.CAPTURES} SELECT DISTINCT host FROM captures WHERE host IS NOT NULL")
def u2_distinct_hosts(spark: SparkSession, sf: str) -> DataFrame:
    return D.captures(spark, sf).select("host").where("host is not null").distinct()


@query("u3_idempotent_insert", f"""
WITH {D.VALID} SELECT DISTINCT host, year FROM valid WHERE seq % 2 = 0 EXCEPT SELECT host, year FROM valid WHERE seq % 2 = 1""")
def u3_idempotent_insert(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.valid_captures(spark, sf)
    return V.insert_new(rows.where("seq % 2 = 0").select("host", "year"), rows.where("seq % 2 = 1"), ["host", "year"])


@query("w1_first_by_sequence", f"WITH {D.VALID} SELECT host, year, min(seq) AS seq, arg_min(source_id, seq) AS source_id FROM valid GROUP BY host, year")
def w1_first_by_sequence(spark: SparkSession, sf: str) -> DataFrame:
    return V.first_by(D.valid_captures(spark, sf).select("host", "year", "seq", "source_id"), ["host", "year"], ["seq"])


@query("w2_canonical_capsules", f"""
WITH {D.VALID} SELECT host, year, provider, payload, seq FROM (
 SELECT host, year, provider, sha256(raw) AS payload, seq, row_number() OVER (PARTITION BY host, year ORDER BY provider, sha256(raw), seq) AS rn FROM valid WHERE seq <= (SELECT max(seq) * 0.9 FROM valid)) WHERE rn = 1""")
def w2_canonical_capsules(spark: SparkSession, sf: str) -> DataFrame:
    """The canonical capsule of each host-year up to a sequence ceiling."""
    rows = D.valid_captures(spark, sf).select("host", "year", "provider", F.sha2("raw", 256).alias("payload"), "seq")
    ceiling = rows.agg((F.max("seq") * 0.9).alias("ceiling"))
    return V.first_by(rows.join(F.broadcast(ceiling), F.col("seq") <= F.col("ceiling")).drop("ceiling"), ["host", "year"], ["provider", "payload", "seq"])


@query("k1_stratified_sample", f"""
WITH {D.CAPTURES}, u AS (SELECT DISTINCT host FROM captures WHERE host IS NOT NULL),
s AS (SELECT host, concat_ws('|', {D.TLD_OF}, len(string_split(host, '.')) - 2, CASE WHEN length(host) <= 15 THEN 'short' WHEN length(host) <= 30 THEN 'medium' ELSE 'long' END, CASE WHEN starts_with(host, 'www.') THEN 'www' ELSE 'nonwww' END) AS stratum FROM u),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY stratum ORDER BY sha256(host)) AS INT) AS round FROM s)
SELECT host, stratum, round FROM r WHERE round <= 32 ORDER BY round, sha256(stratum) LIMIT 500""")
def k1_stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    return S.stratified(D.captures(spark, sf).where("host is not null"), limit=500, cap=32)


@query("k2_hash_sample", f"""
WITH {D.CAPTURES}, u AS (SELECT DISTINCT host FROM captures WHERE host IS NOT NULL) SELECT host, sha256(concat('seed7|', host)) AS score FROM u ORDER BY score LIMIT 200""")
def k2_hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    return S.smallest_hashes(D.captures(spark, sf).where("host is not null"), "host", 200, "seed7")


@query("k3_sample_per_source", f"""
WITH {D.LOG}, u AS (SELECT DISTINCT source_id, host FROM log), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY source_id ORDER BY sha256(concat('seed3|', host))) AS INT) AS rank FROM u)
SELECT source_id, host, rank FROM r WHERE rank <= 5""")
def k3_sample_per_source(spark: SparkSession, sf: str) -> DataFrame:
    return S.per_group(D.log(spark, sf), "source_id", "host", 5, "seed3")


@query("k15_page_after_cursor", f"WITH {D.VALID} SELECT seq, host, year FROM valid WHERE seq > 500 ORDER BY seq LIMIT 300")
def k15_page_after_cursor(spark: SparkSession, sf: str) -> DataFrame:
    """The next page of the host-year log after a cursor."""
    return D.valid_captures(spark, sf).where("seq > 500").orderBy("seq").limit(300).select("seq", "host", "year")


@query("b6_source_scope", """
SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'COMMON_CRAWL_CORPUS_EXCLUDED' WHEN doc_id % 5 = 1 THEN 'ISC_REFERENCE' WHEN doc_id % 5 = 2 THEN 'OFFICIAL_POOL' ELSE 'LOCAL_DISCOVERY' END AS scope FROM documents""")
def b6_source_scope(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.table(spark, sf, "documents").select("doc_id", "source")
    names = F.array(F.lit("CC-MAIN "), F.lit("ISC "), F.lit("candidate pool"), F.lit("list "), F.lit("crawl "))
    named = F.element_at(names, (F.col("doc_id") % 5 + 1).cast("int"))
    named = F.when(F.col("doc_id") % 5 == 2, named).otherwise(F.concat(named, "source"))
    return docs.select("doc_id", H.classify_source(named).alias("scope"))


@query("b7_reconcile_candidates", f"""
WITH {D.BASE}, r AS (
 SELECT raw, host, seq, source_id, CASE WHEN host IS NULL THEN 'unparsed' WHEN seq % 11 = 0 THEN 'reference' WHEN seq % 13 = 0 THEN 'excluded' ELSE 'active' END AS bucket FROM captures),
k AS (SELECT * FROM r WHERE bucket <> 'active' OR host NOT IN (SELECT host FROM baseline))
SELECT bucket, coalesce(host, raw) AS host, min(seq) AS first FROM k GROUP BY 1, 2""")
def b7_reconcile_candidates(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.captures(spark, sf)
    source = F.when(F.col("seq") % 11 == 0, F.concat(F.lit("isc_"), "source_id")).when(F.col("seq") % 13 == 0, F.concat(F.lit("cc_"), "source_id")).otherwise(F.concat(F.lit("local_"), "source_id"))
    candidates = rows.select(F.col("raw").alias("hostname"), source.alias("source_id"), F.lit("LOCAL_DISCOVERY").alias("scope"), "seq")
    return V.reconcile(candidates, D.baseline(spark, sf), "seq").select("bucket", "host", "first")


@query("d2_action_posterior", f"""
WITH {D.RUNS}, a AS (SELECT ['EXACT', 'RANGE', 'DOMAIN', 'RDAP'][k % 4 + 1] AS action, count(*) AS attempts, CAST(sum(requests) AS BIGINT) AS requests, count(*) FILTER (WHERE eed > 0) AS novel FROM runs GROUP BY 1)
SELECT action, attempts, requests, novel, (novel + 4.0 * CASE action WHEN 'EXACT' THEN 0.25 WHEN 'DOMAIN' THEN 1.0 ELSE 0.5 END) / (greatest(requests, attempts) + 4.0) AS posterior FROM a""")
def d2_action_posterior(spark: SparkSession, sf: str) -> DataFrame:
    """Posterior yield of each kind of action."""
    action = F.element_at(F.array(*map(F.lit, ("EXACT", "RANGE", "DOMAIN", "RDAP"))), F.col("k") % 4 + 1)
    rows = D.runs(spark, sf).groupBy(action.alias("action")).agg(F.count("*").alias("attempts"), F.sum("requests").alias("requests"), F.count_if(F.col("eed") > 0).alias("novel"))
    return rows.withColumn("posterior", posterior(F.col("action"), F.col("novel"), F.col("requests"), F.col("attempts")))

"""Evidence queries: classification, coverage, planning, provenance, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yearmask.functions import hosts as H
from yearmask.operators import eed as E
from yearmask.operators import evidence as V
from yearmask.plans import derived as D
from yearmask.plans.registry import query

#: capsules made of captures, the same in both engines
CAPSULES = D.CAPTURES + """, capsules AS (
  SELECT seq, host AS hostname, year, provider, CASE WHEN seq % 7 = 0 THEN 'registration_event_year' ELSE 'capture_timestamp_year' END AS temporal_semantics,
         CASE WHEN seq % 9 = 0 THEN 'other' ELSE 'exact_host_cdx_capture' END AS evidence_type, CASE WHEN seq % 4 = 0 THEN concat('parser; contract=lists@', seq % 3) ELSE 'parser' END AS extraction_method,
         CASE WHEN seq % 23 = 0 THEN year + 1 ELSE year END AS stamp_year, CASE WHEN seq % 29 = 0 THEN NULL ELSE sha256(raw) END AS payload_hash
  FROM captures)"""


def capsules(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("seq")
    rows = D.captures(spark, sf).select(
        s, F.col("host").alias("hostname"), "year", "provider", F.when(s % 7 == 0, "registration_event_year").otherwise("capture_timestamp_year").alias("temporal_semantics"),
        F.when(s % 9 == 0, "other").otherwise("exact_host_cdx_capture").alias("evidence_type"), F.when(s % 4 == 0, F.concat(F.lit("parser; contract=lists@"), s % 3)).otherwise("parser").alias("extraction_method"),
        F.when(s % 23 == 0, F.col("year") + 1).otherwise(F.col("year")).alias("stamp_year"), F.when(s % 29 != 0, F.sha2("raw", 256)).alias("payload_hash"),
    )
    contracts = spark.range(2).select(F.lit("lists").alias("contract_id"), F.col("id").cast("string").alias("version"))
    full = rows.withColumns({"evidence_timestamp": F.concat(F.col("stamp_year"), F.lit("0101000000")), "original_url": F.concat(F.lit("http://"), F.coalesce("hostname", F.lit("none")), F.lit("/index.html"))})
    return V.bound_contract(full, contracts)


_BOUND = "seq % 4 = 0 AND seq % 3 < 2"
_LANE = f"""CASE WHEN starts_with(provider, 'direct:') THEN CASE WHEN {_BOUND} THEN 'DIRECT_ANNUAL' ELSE 'UNKNOWN' END
  WHEN provider = 'rdap' OR temporal_semantics = 'registration_event_year' THEN 'REGISTRATION_YEAR' WHEN provider = 'dns' THEN 'DNS_REFERENCE' WHEN evidence_type <> 'other' THEN 'VERIFIED_CANDIDATE' ELSE 'UNKNOWN' END"""


@query("b1_semantic_errors", f"""
WITH {CAPSULES} SELECT seq, concat_ws(',', CASE WHEN hostname IS NULL THEN 'hostname_invalid' END, CASE WHEN year NOT BETWEEN 1996 AND 2001 THEN 'year_out_of_window' END,
  CASE WHEN stamp_year NOT BETWEEN 1996 AND 2001 OR stamp_year <> year THEN 'timestamp_year_mismatch' END, CASE WHEN hostname IS NULL AND FALSE THEN 'url_host_mismatch' END, CASE WHEN payload_hash IS NULL THEN 'payload_hash_missing' END,
  CASE WHEN starts_with(provider, 'direct:') AND NOT ({_BOUND}) THEN 'contract_missing' END) AS errors FROM capsules""")
def b1_semantic_errors(spark: SparkSession, sf: str) -> DataFrame:
    """What is wrong with each capsule."""
    return V.semantic_errors(capsules(spark, sf)).select("seq", F.array_join("errors", ",").alias("errors"))


@query("b2_acquisition_lanes", f"WITH {CAPSULES} SELECT {_LANE} AS lane, provider, count(*) AS n FROM capsules GROUP BY 1, 2")
def b2_acquisition_lanes(spark: SparkSession, sf: str) -> DataFrame:
    return capsules(spark, sf).groupBy(V.lane(F.col("bound")).alias("lane"), "provider").agg(F.count("*").alias("n"))


@query("b3_contribution_buckets", f"""
WITH {CAPSULES}, l AS (SELECT {_LANE} AS lane FROM capsules) SELECT CASE lane WHEN 'DIRECT_ANNUAL' THEN 'direct_annual' WHEN 'VERIFIED_CANDIDATE' THEN 'verified_candidate' ELSE 'other_restricted' END AS bucket, count(*) AS n FROM l GROUP BY 1""")
def b3_contribution_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return capsules(spark, sf).groupBy(V.bucket(V.lane(F.col("bound"))).alias("bucket")).agg(F.count("*").alias("n"))


@query("b5_contract_resolution", """
SELECT s_suppkey, CASE WHEN s_suppkey % 10 = 3 THEN 'exact' WHEN s_nationkey % 4 = 0 THEN 'family0' WHEN s_nationkey % 4 = 1 THEN 'family1' ELSE 'discovery_only' END AS contract_id FROM supplier""")
def b5_contract_resolution(spark: SparkSession, sf: str) -> DataFrame:
    s = D.table(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("http://lists.example/"), "s_suppkey").alias("locator"), F.concat(F.lit("parser"), F.col("s_nationkey") % 4).alias("family"))
    allowed = s.where("s_suppkey % 10 = 3").select("locator", F.lit("exact").alias("contract_id"))
    families = spark.range(2).select(F.concat(F.lit("parser"), "id").alias("family"), F.concat(F.lit("family"), "id").alias("contract_id"))
    return V.resolve_contract(s, allowed, families).select("s_suppkey", "contract_id")


_TASKS = D.VALID + """, tasks AS (
  SELECT seq, host, year AS year_from, CAST(least(year + seq % 3, 2001) AS INT) AS year_to, ['PASS', 'EMPTY_EXHAUSTIVE', 'INCOMPLETE', 'TRANSIENT_ERROR', 'INVALID'][seq % 5 + 1] AS state, provider, cost FROM valid)"""


def tasks(spark: SparkSession, sf: str) -> DataFrame:
    states = F.array(*map(F.lit, ("PASS", "EMPTY_EXHAUSTIVE", "INCOMPLETE", "TRANSIENT_ERROR", "INVALID")))
    return D.valid_captures(spark, sf).select("seq", "host", F.col("year").alias("year_from"), F.least(F.col("year") + F.col("seq") % 3, F.lit(2001)).cast("int").alias("year_to"), F.element_at(states, (F.col("seq") % 5 + 1).cast("int")).alias("state"), "provider", "cost")


_COVER = _TASKS + ", cover AS (SELECT host, CAST(bit_or((1 << (year_to - 1995)) - (1 << (year_from - 1996))) AS INT) AS covered_mask FROM tasks WHERE state IN ('PASS', 'EMPTY_EXHAUSTIVE') GROUP BY host)"


@query("j5_coverage_masks", f"WITH {_COVER} SELECT host, covered_mask FROM cover")
def j5_coverage_masks(spark: SparkSession, sf: str) -> DataFrame:
    return V.coverage_mask(tasks(spark, sf))


_PLAN = f"""WITH {_COVER}, b AS (SELECT host, {D.BITS} AS m FROM valid WHERE status = 'F' GROUP BY host), l AS (SELECT host, {D.BITS} AS m FROM valid WHERE status = 'O' AND seq % 2 = 0 GROUP BY host),
o AS (SELECT v.seq, v.host, v.year, seq % 3 = 0 AS allow, seq % 10 = 1 AS excluded, CASE WHEN seq % 4 = 0 THEN 1 << (year - 1996) ELSE 0 END AS direct, CASE WHEN seq % 5 = 0 THEN 3 ELSE 0 END AS hint,
   coalesce(b.m, 0) | coalesce(l.m, 0) AS closed, coalesce(covered_mask, 0) AS covered FROM valid v LEFT JOIN b USING (host) LEFT JOIN l USING (host) LEFT JOIN cover USING (host)),
d AS (SELECT *, CASE WHEN allow AND NOT excluded THEN direct & ~closed ELSE 0 END AS direct_mask, hint | (1 << (year - 1996)) AS h FROM o)
SELECT seq, CAST(direct_mask AS INT) AS direct_mask, CAST((CASE WHEN NOT (allow AND NOT excluded) OR (h = 0 AND direct_mask = 0) THEN 63 ELSE h END) & ~closed & ~direct_mask & ~covered AS INT) AS query_mask FROM d"""


@query("j6_evidence_plan", _PLAN)
def j6_evidence_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Which years are proven directly, and which are still to be asked for."""
    rows, s = D.valid_captures(spark, sf), F.col("seq")
    own = H.bit(F.col("year"))
    local = (F.col("status") == "O") & (s % 2 == 0)  # open orders of odd numbers stand for what isn't local
    masks = rows.groupBy("host").agg(F.bit_or(F.when(F.col("status") == "F", own).otherwise(0)).alias("official_mask"), F.bit_or(F.when(local, own).otherwise(0)).alias("local_mask"))
    o = rows.select(
        s, "host", F.col("year").alias("source_year"), (s % 3 == 0).alias("allow_direct"), F.when(s % 10 == 1, "COMMON_CRAWL_CORPUS_EXCLUDED").otherwise("LOCAL_DISCOVERY").alias("scope"),
        F.when(s % 4 == 0, H.bit(F.col("year"))).otherwise(0).alias("direct_year_mask"), F.when(s % 5 == 0, 3).otherwise(0).alias("year_hint_mask"),
    )
    known = masks.join(V.coverage_mask(tasks(spark, sf)), "host", "left")
    o = o.join(known, "host", "left").fillna(0, ["official_mask", "local_mask", "covered_mask"])
    return V.plan(o).select("seq", "direct_mask", "query_mask")


@query("j7_exact_harvest", f"""
WITH {D.BASE}, p AS (SELECT DISTINCT host, year FROM valid WHERE seq % 6 = 0), w AS (SELECT source_id, host, year, min(seq) AS seq FROM valid GROUP BY ALL)
SELECT source_id, count(*) AS witnesses, count(*) FILTER (WHERE b.host IS NOT NULL) AS known, count(*) FILTER (WHERE b.host IS NULL AND p.host IS NOT NULL) AS proven, count(*) FILTER (WHERE b.host IS NULL AND p.host IS NULL) AS kept
FROM w LEFT JOIN baseline b USING (host, year) LEFT JOIN p USING (host, year) GROUP BY source_id""")
def j7_exact_harvest(spark: SparkSession, sf: str) -> DataFrame:
    """Witnesses of each region that are known, already proven, or new."""
    rows = D.valid_captures(spark, sf)
    w = rows.groupBy("source_id", "host", "year").agg(F.min("seq").alias("seq"))
    b = D.baseline(spark, sf).withColumn("b", F.lit(True))
    p = rows.where("seq % 6 = 0").select("host", "year").distinct().withColumn("p", F.lit(True))
    j = w.join(b, ["host", "year"], "left").join(p, ["host", "year"], "left")
    return j.groupBy("source_id").agg(F.count("*").alias("witnesses"), F.count("b").alias("known"), F.count_if(F.col("b").isNull() & F.col("p").isNotNull()).alias("proven"), F.count_if(F.col("b").isNull() & F.col("p").isNull()).alias("kept"))


_ORIGINS = f"{D.VALID}, o AS (SELECT host, year, ts, source_id, 'run' AS origin, seq FROM valid WHERE seq % 2 = 0 UNION ALL SELECT host, year, ts, source_id, 'task', seq FROM valid WHERE seq % 2 = 1 OR seq % 3 = 0)"


def origin_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Every capture is in the log of runs, in that of tasks, or in both."""
    rows = D.valid_captures(spark, sf).select("host", "year", "ts", "source_id", "seq")
    run, task = F.col("seq") % 2 == 0, (F.col("seq") % 2 == 1) | (F.col("seq") % 3 == 0)
    return rows.withColumn("origin", F.explode(F.array_compact(F.array(F.when(run, "run"), F.when(task, "task")))))


@query("j9_first_touch", f"""
WITH {_ORIGINS} SELECT host, year, source_id, origin, seq FROM (SELECT *, row_number() OVER (PARTITION BY host, year ORDER BY ts, source_id, origin, seq) AS rn FROM o) WHERE rn = 1""")
def j9_first_touch(spark: SparkSession, sf: str) -> DataFrame:
    """The first source of each host-year over two logs, with the whole chain of ties."""
    return V.first_by(origin_logs(spark, sf), ["host", "year"], ["ts", "source_id", "origin", "seq"]).select("host", "year", "source_id", "origin", "seq")


@query("j10_attribution", f"""
WITH {D.VALID}, hy AS (SELECT DISTINCT host, year FROM valid), p AS (SELECT host, year, arg_min(kind, seq) AS kind FROM valid WHERE status = 'F' GROUP BY ALL), l AS (SELECT host, year, arg_min(kind, seq) AS kind FROM valid WHERE status = 'O' GROUP BY ALL)
SELECT host, year, coalesce(p.kind, l.kind, '__unattributed__') AS kind, CASE WHEN p.kind IS NOT NULL THEN 'proof' WHEN l.kind IS NOT NULL THEN 'ledger' ELSE 'none' END AS side FROM hy LEFT JOIN p USING (host, year) LEFT JOIN l USING (host, year)""")
def j10_attribution(spark: SparkSession, sf: str) -> DataFrame:
    """The task kind of each host-year; the proof's provenance goes before the ledger's. Closed orders stand for proofs,
    open ones for the ledger, and those under way for rows without provenance."""
    rows = D.valid_captures(spark, sf)
    side = {n: rows.where(F.col("status") == s).groupBy("host", "year").agg(F.min_by("kind", "seq").alias(n)) for s, n in (("F", "p"), ("O", "l"))}
    j = rows.select("host", "year").distinct().join(side["p"], ["host", "year"], "left").join(side["l"], ["host", "year"], "left")
    return j.select("host", "year", F.coalesce("p", "l", F.lit("__unattributed__")).alias("kind"), F.when(F.col("p").isNotNull(), "proof").when(F.col("l").isNotNull(), "ledger").otherwise("none").alias("side"))


@query("j11_proof_lineage", f"WITH {D.VALID} SELECT host, year, arg_min(provider, seq) AS provider, arg_min(kind, seq) AS kind, min(seq) AS seq FROM valid WHERE provider <> 'dns' GROUP BY host, year")
def j11_proof_lineage(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.valid_captures(spark, sf).where("provider <> 'dns'").select("host", "year", "provider", "kind", "seq")
    return V.first_by(rows, ["host", "year"], ["seq"])


@query("j12_direct_sources", f"WITH {D.VALID} SELECT host, year, string_agg(DISTINCT source_id, ',' ORDER BY source_id) AS sources FROM valid WHERE provider = 'direct:lists' GROUP BY host, year")
def j12_direct_sources(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.valid_captures(spark, sf).where("provider = 'direct:lists'")
    return rows.groupBy("host", "year").agg(F.array_join(F.sort_array(F.collect_set("source_id")), ",").alias("sources"))


@query("j13_request_totals", f"""
WITH {D.RUNS}, p AS (SELECT k, arg_min(source, run_id) AS source FROM runs WHERE kind = 'click' GROUP BY k)
SELECT coalesce(p.source, '__unattributed__') AS source, CAST(sum(requests) AS BIGINT) AS requests, count(*) AS attempts FROM runs LEFT JOIN p USING (k) GROUP BY 1""")
def j13_request_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Requests by the first source of their task."""
    r = D.runs(spark, sf)
    first = r.where("kind = 'click'").groupBy("k").agg(F.min_by("source", "run_id").alias("s"))
    return r.join(first, "k", "left").groupBy(F.coalesce("s", F.lit("__unattributed__")).alias("source")).agg(F.sum("requests").alias("requests"), F.count("*").alias("attempts"))


@query("j14_lineage_coverage", f"""
WITH {_TASKS} SELECT state, count(*) AS tasks, count(*) FILTER (WHERE host IN (SELECT host FROM valid WHERE status = 'P')) AS with_origin FROM tasks GROUP BY state""")
def j14_lineage_coverage(spark: SparkSession, sf: str) -> DataFrame:
    t = tasks(spark, sf)
    has = D.valid_captures(spark, sf).where("status = 'P'").select("host").distinct().withColumn("o", F.lit(True))
    return t.join(has, "host", "left").groupBy("state").agg(F.count("*").alias("tasks"), F.count("o").alias("with_origin"))


@query("j15_registration_backfill", f"""
WITH {_TASKS}, {D.WEIGHTS}, p AS (SELECT CASE WHEN length(list_extract(l, -1)) = 2 THEN CASE WHEN len(l) >= 3 THEN array_to_string(l[-3:], '.') END ELSE array_to_string(l[-2:], '.') END AS parent, seq, state
  FROM (SELECT string_split(host, '.') AS l, seq, state FROM tasks)),
q AS (SELECT parent, min(seq) AS first_seq, count(*) AS children FROM p WHERE state IN ('INCOMPLETE', 'TRANSIENT_ERROR') AND parent IS NOT NULL AND parent NOT IN (SELECT parent FROM p WHERE state = 'PASS' AND parent IS NOT NULL) GROUP BY parent)
SELECT parent, first_seq, children, CAST(coalesce(weight, 0) AS DOUBLE) AS weight FROM q LEFT JOIN weights ON tld = list_extract(string_split(parent, '.'), -1) ORDER BY weight DESC, parent LIMIT 100""")
def j15_registration_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """Parents of open tasks that are not queued yet, with their first lineage, best weights first."""
    t = tasks(spark, sf).withColumn("parent", H.registrable_parent(F.col("host"))).where("parent is not null")
    open_tasks = t.where("state in ('INCOMPLETE', 'TRANSIENT_ERROR')").join(t.where("state = 'PASS'").select("parent").distinct(), "parent", "left_anti")
    q = open_tasks.groupBy("parent").agg(F.min("seq").alias("first_seq"), F.count("*").alias("children")).withColumn("tld", H.tld(F.col("parent"))).join(D.weights(spark, sf), "tld", "left")
    return q.select("parent", "first_seq", "children", F.coalesce("weight", F.lit(0)).cast("double").alias("weight")).orderBy(F.desc("weight"), "parent").limit(100)


@query("j16_run_closure", f"""
WITH {_TASKS}, r AS (SELECT host, min(year_from) AS first_year, count(*) AS created FROM tasks GROUP BY host)
SELECT r.host, r.created, count(t.seq) AS later, count(t.seq) FILTER (WHERE t.state IN ('PASS', 'EMPTY_EXHAUSTIVE', 'INVALID')) AS terminal, count(t.seq) FILTER (WHERE t.state = 'PASS') AS proofs
FROM r LEFT JOIN tasks t ON t.host = r.host AND t.year_from >= r.first_year GROUP BY r.host, r.created""")
def j16_run_closure(spark: SparkSession, sf: str) -> DataFrame:
    """Tasks of each run that came at or after it: an equi-join with an inequality beside it."""
    t = tasks(spark, sf)
    r = t.groupBy("host").agg(F.min("year_from").alias("first_year"), F.count("*").alias("created"))
    a, b = r.alias("r"), t.alias("t")
    j = a.join(b, (F.col("r.host") == F.col("t.host")) & (F.col("t.year_from") >= F.col("r.first_year")), "left")
    return j.groupBy("r.host", "created").agg(F.count("seq").alias("later"), F.count_if(F.col("state").isin("PASS", "EMPTY_EXHAUSTIVE", "INVALID")).alias("terminal"), F.count_if(F.col("state") == "PASS").alias("proofs"))


@query("j20_provider_overlap", f"""
WITH {D.VALID}, d AS (SELECT DISTINCT provider, host FROM valid) SELECT a.provider AS "left", b.provider AS "right", count(*) AS shared FROM d a JOIN d b ON a.host = b.host AND a.provider < b.provider GROUP BY 1, 2""")
def j20_provider_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Datasets shared by pairs of providers. A host has a handful of providers, so pairs are taken inside its set."""
    sets = D.valid_captures(spark, sf).groupBy("host").agg(F.sort_array(F.collect_set("provider")).alias("p"))
    pairs = F.flatten(F.transform("p", lambda a: F.transform(F.filter("p", lambda b: b > a), lambda b: F.struct(a.alias("left"), b.alias("right")))))
    return sets.select(F.explode(pairs).alias("x")).groupBy("x.left", "x.right").agg(F.count("*").alias("shared"))


@query("j21_merge_audit", f"""
WITH {D.VALID}, a AS (SELECT DISTINCT host, year FROM valid WHERE seq % 10 <> 0), e AS (SELECT DISTINCT host, year FROM valid WHERE seq % 10 <> 1)
SELECT coalesce(a.year, e.year) AS year, count(*) FILTER (WHERE e.host IS NULL) AS without_evidence, count(*) FILTER (WHERE a.host IS NULL) AS not_listed, count(*) FILTER (WHERE a.host IS NOT NULL AND e.host IS NOT NULL) AS matched
FROM a FULL OUTER JOIN e ON a.host = e.host AND a.year = e.year GROUP BY 1""")
def j21_merge_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Every listed host-year has evidence, and the other way round."""
    rows = D.valid_captures(spark, sf)
    a = rows.where("seq % 10 <> 0").select("host", "year").distinct().withColumn("a", F.lit(True))
    e = rows.where("seq % 10 <> 1").select("host", "year").distinct().withColumn("e", F.lit(True))
    j = a.join(e, ["host", "year"], "full_outer")
    return j.groupBy("year").agg(F.count_if(F.col("e").isNull()).alias("without_evidence"), F.count_if(F.col("a").isNull()).alias("not_listed"), F.count_if(F.col("a") & F.col("e")).alias("matched"))


@query("j22_active_not_annual", f"WITH {D.VALID} SELECT DISTINCT host FROM valid WHERE provider = 'ia' AND host IN (SELECT host FROM valid WHERE status = 'P')")
def j22_active_not_annual(spark: SparkSession, sf: str) -> DataFrame:
    """Active candidates that an annual list has; an audit wants none."""
    rows = D.valid_captures(spark, sf)
    return rows.where("provider = 'ia'").select("host").distinct().join(rows.where("status = 'P'").select("host"), "host", "left_semi")


@query("j23_domain_matches", f"""
WITH {D.VALID}, h AS (SELECT DISTINCT host FROM valid), d AS (SELECT DISTINCT array_to_string(string_split(host, '.')[-2:], '.') AS domain FROM valid WHERE starts_with(host, 'a'))
SELECT d.domain, h.host FROM h JOIN d ON h.host = d.domain OR ends_with(h.host, '.' || d.domain)""")
def j23_domain_matches(spark: SparkSession, sf: str) -> DataFrame:
    hosts = D.valid_captures(spark, sf).select("host").distinct()
    domains = hosts.where("startswith(host, 'a')").select(F.regexp_extract("host", r"([^.]+\.[^.]+)\z", 1).alias("domain"))
    return V.domain_matches(hosts, domains)


@query("j24_current_authority", f"WITH {D.RUNS} SELECT source, count(*) AS n, sum(requests)::BIGINT AS requests FROM runs WHERE k = (SELECT arg_max(k, run_id) FROM runs) GROUP BY source")
def j24_current_authority(spark: SparkSession, sf: str) -> DataFrame:
    """Measurements under the latest authority only (a table of one row)."""
    r = D.runs(spark, sf)
    now = r.agg(F.max_by("k", "run_id").alias("k"))
    return r.join(F.broadcast(now), "k").groupBy("source").agg(F.count("*").alias("n"), F.sum("requests").alias("requests"))


@query("j26_active_host_years", f"""
WITH {_ORIGINS} SELECT DISTINCT host, year FROM o WHERE source_id IN (SELECT concat('src', s_suppkey) FROM supplier WHERE s_acctbal > 0) ORDER BY host, year LIMIT 1000""")
def j26_active_host_years(spark: SparkSession, sf: str) -> DataFrame:
    active = D.table(spark, sf, "supplier").where("s_acctbal > 0").select(F.concat(F.lit("src"), "s_suppkey").alias("source_id"))
    return origin_logs(spark, sf).join(active, "source_id", "left_semi").select("host", "year").distinct().orderBy("host", "year").limit(1000)


@query("j27_highest_sequence", f"""
WITH {D.VALID}, p AS (SELECT DISTINCT source_id, host, year FROM valid), l AS (SELECT host, year, max(seq) AS seq FROM valid GROUP BY ALL)
SELECT source_id, max(seq) AS seq FROM p JOIN l USING (host, year) GROUP BY source_id""")
def j27_highest_sequence(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.valid_captures(spark, sf)
    p = rows.select("source_id", "host", "year").distinct()
    last = rows.groupBy("host", "year").agg(F.max("seq").alias("seq"))
    return p.join(last, ["host", "year"]).groupBy("source_id").agg(F.max("seq").alias("seq"))


@query("j29_leaf_regions", "SELECT p_partkey AS region FROM part p WHERE p_partkey NOT IN (SELECT p_partkey // 3 FROM part WHERE p_size > 10)")
def j29_leaf_regions(spark: SparkSession, sf: str) -> DataFrame:
    """Regions without a child."""
    p = D.table(spark, sf, "part")
    children = p.where("p_size > 10").select(F.floor(F.col("p_partkey") / 3).alias("region"))
    return p.select(F.col("p_partkey").alias("region")).join(children, "region", "left_anti")


@query("u4_coalesced_observations", f"""
WITH {D.VALID} SELECT host, year, provider, status, min(seq) AS seq FROM valid GROUP BY host, year, provider, status""")
def u4_coalesced_observations(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.valid_captures(spark, sf).select("host", "year", "provider", "status", "seq")
    return V.first_by(rows, ["host", "year", "provider", "status"], ["seq"])


@query("u6_merged_providers", f"""
WITH {D.VALID} SELECT host, year, provider, seq FROM (SELECT *, row_number() OVER (PARTITION BY host, year ORDER BY CASE provider WHEN 'ia' THEN 0 WHEN 'arquivo' THEN 1 ELSE 2 END, seq) AS rn FROM valid) WHERE rn = 1""")
def u6_merged_providers(spark: SparkSession, sf: str) -> DataFrame:
    """One capsule a host-year over providers, in the order of providers."""
    rank = F.when(F.col("provider") == "ia", 0).when(F.col("provider") == "arquivo", 1).otherwise(2)
    return V.first_by(D.valid_captures(spark, sf).select("host", "year", "provider", "seq"), ["host", "year"], [rank, "seq"])


@query("u7_task_outcomes", f"""
WITH {_TASKS} SELECT host AS task_id, CASE WHEN bool_or(state = 'PASS') THEN 'PASS' WHEN bool_and(state = 'EMPTY_EXHAUSTIVE') THEN 'EMPTY_EXHAUSTIVE' WHEN bool_and(state IN ('EMPTY_EXHAUSTIVE', 'INVALID')) THEN 'INVALID'
  WHEN bool_or(state = 'TRANSIENT_ERROR') THEN 'TRANSIENT_ERROR' ELSE 'INCOMPLETE' END AS outcome FROM tasks GROUP BY host""")
def u7_task_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return V.task_outcome(tasks(spark, sf).withColumnRenamed("host", "task_id"))


@query("w4_year_ranges", f"""
WITH {D.VALID}, y AS (SELECT DISTINCT host, year FROM valid), g AS (SELECT *, year - row_number() OVER (PARTITION BY host ORDER BY year) AS grp FROM y) SELECT host, min(year) AS year_from, max(year) AS year_to FROM g GROUP BY host, grp""")
def w4_year_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return V.year_ranges(V.mask_by_host(D.valid_captures(spark, sf)), "year_mask", ["host"])


@query("g9_candidate_ledger", f"""
WITH {D.CAPTURES} SELECT host, status AS scope, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS observations, arg_min(source_id, seq) AS source_id, arg_min(year, seq) FILTER (WHERE year BETWEEN 1996 AND 2001) AS source_year
FROM captures WHERE host IS NOT NULL GROUP BY host, status""")
def g9_candidate_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """First and last sighting, count, first source, first known year of each candidate and scope."""
    rows = D.captures(spark, sf).where("host is not null").withColumn("y", H.in_window(F.col("year")))
    return rows.groupBy("host", F.col("status").alias("scope")).agg(
        F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count("*").alias("observations"), F.min_by("source_id", "seq").alias("source_id"), F.min_by("y", F.when(F.col("y").isNotNull(), F.col("seq"))).alias("source_year"),
    )


@query("g10_unparsed_ledger", f"WITH {D.CAPTURES} SELECT raw, source_id, 'invalid_hostname' AS reason, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS n FROM captures WHERE host IS NULL GROUP BY raw, source_id")
def g10_unparsed_ledger(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.captures(spark, sf).where("host is null")
    return rows.groupBy("raw", "source_id", F.lit("invalid_hostname").alias("reason")).agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count("*").alias("n"))


@query("g11_counts_by_state", f"""
WITH {_TASKS}, s AS (SELECT unnest(['PASS', 'EMPTY_EXHAUSTIVE', 'INCOMPLETE', 'TRANSIENT_ERROR', 'INVALID', 'QUEUED']) AS state) SELECT state, count(seq) AS n FROM s LEFT JOIN tasks USING (state) GROUP BY state""")
def g11_counts_by_state(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of all states, those without rows too."""
    names = spark.range(1).select(F.explode(F.array(*map(F.lit, ("PASS", "EMPTY_EXHAUSTIVE", "INCOMPLETE", "TRANSIENT_ERROR", "INVALID", "QUEUED")))).alias("state"))
    counts = tasks(spark, sf).groupBy("state").agg(F.count("*").alias("c"))
    return names.join(counts, "state", "left").select("state", F.coalesce("c", F.lit(0)).alias("n"))


@query("g12_source_audit", f"""
WITH {D.BASE}, c AS (SELECT DISTINCT host FROM valid WHERE provider = 'ia'), u AS (SELECT source_id, raw, host, count(*) AS n FROM captures GROUP BY ALL),
h AS (SELECT source_id, host, sum(n) AS n FROM u WHERE host IS NOT NULL GROUP BY ALL),
v AS (SELECT source_id, CAST(sum(n) AS BIGINT) AS valid, count(*) AS unique_hosts, count(*) FILTER (WHERE host IN (SELECT host FROM baseline)) AS in_baseline, count(*) FILTER (WHERE host NOT IN (SELECT host FROM baseline) AND host IN (SELECT host FROM c)) AS in_candidates FROM h GROUP BY 1),
r AS (SELECT source_id, CAST(sum(n) AS BIGINT) AS raw_lines FROM u GROUP BY 1),
a AS (SELECT source_id, raw_lines, coalesce(valid, 0) AS valid, coalesce(unique_hosts, 0) AS unique_hosts, coalesce(in_baseline, 0) AS in_baseline, coalesce(in_candidates, 0) AS in_candidates FROM r LEFT JOIN v USING (source_id))
SELECT source_id, raw_lines, valid, raw_lines - valid AS invalid, valid - unique_hosts AS duplicates, unique_hosts, in_baseline, in_candidates, unique_hosts - in_baseline - in_candidates AS remainder FROM a""")
def g12_source_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Raw, valid, invalid, duplicate and unique hosts of each source, and what of them is known. A source without any
    valid line has a row too."""
    inside = F.expr(D.IN_WINDOW.format(c="ts"))
    marks = D.captures(spark, sf).select("source_id", "host", (inside & (F.col("status") == "F")).alias("base"), (inside & (F.col("provider") == "ia")).alias("candidate"))
    # one scan: a host has a row a source at most, once they are counted, and what any of them knows all know
    per_host = marks.groupBy("source_id", "host").agg(F.count("*").alias("n"), F.bool_or("base").alias("base"), F.bool_or("candidate").alias("candidate"))
    of_host = Window.partitionBy("host")
    return audit_counts(per_host.select("source_id", "host", "n", F.max("base").over(of_host).alias("base"), F.max("candidate").over(of_host).alias("candidate")))


def source_audit(rows: DataFrame, baseline: DataFrame, candidates: DataFrame) -> DataFrame:
    """G12 of rows (source_id, host; null: not valid), baseline host-years and candidate hosts."""
    per_host = rows.groupBy("source_id", "host").agg(F.count("*").alias("n"))
    known = V.resolve(per_host, V.mask_by_host(baseline), candidates)
    return audit_counts(known.select("source_id", "host", "n", (F.col("baseline_mask") != 0).alias("base"), F.col("is_candidate").alias("candidate")))


def audit_counts(hosts: DataFrame) -> DataFrame:
    """G12 of (source_id, host, n, base, candidate), a row for each source and host and one for all its lines without."""
    valid, base = F.col("host").isNotNull(), F.col("base") & F.col("host").isNotNull()
    a = hosts.groupBy("source_id").agg(
        F.sum("n").alias("raw_lines"), F.coalesce(F.sum(F.when(valid, F.col("n"))), F.lit(0)).alias("valid"), F.count("host").alias("unique_hosts"), F.count_if(base).alias("in_baseline"),
        F.count_if(valid & ~base & F.col("candidate")).alias("in_candidates"),
    )
    return a.select("source_id", "raw_lines", "valid", (F.col("raw_lines") - F.col("valid")).alias("invalid"), (F.col("valid") - F.col("unique_hosts")).alias("duplicates"), "unique_hosts", "in_baseline", "in_candidates", (F.col("unique_hosts") - F.col("in_baseline") - F.col("in_candidates")).alias("remainder"))


@query("g37_reconciliation", f"""
WITH {D.BASE}, {D.WEIGHTS}, r AS (SELECT c.*, row_number() OVER (PARTITION BY c.host, c.year ORDER BY seq) AS rn, b.host IS NOT NULL AS known, coalesce(weight, 0) AS weight
  FROM captures c LEFT JOIN baseline b USING (host, year) LEFT JOIN weights ON weights.tld = list_extract(string_split(c.host, '.'), -1))
SELECT count(*) AS input, count(*) FILTER (WHERE host IS NULL OR year NOT BETWEEN 1996 AND 2001) AS invalid, count(*) FILTER (WHERE host IS NOT NULL AND year BETWEEN 1996 AND 2001 AND rn > 1) AS duplicates,
 count(*) FILTER (WHERE rn = 1 AND known) AS overlap, count(*) FILTER (WHERE host IS NOT NULL AND year BETWEEN 1996 AND 2001 AND rn = 1 AND NOT known) AS novel,
 CAST(sum(weight) FILTER (WHERE host IS NOT NULL AND year BETWEEN 1996 AND 2001 AND rn = 1 AND NOT known) AS DOUBLE) AS novel_eed FROM r""")
def g37_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    """What became of every input row."""
    good = F.col("host").isNotNull() & F.col("year").between(1996, 2001)
    rows = D.captures(spark, sf).withColumn("good", F.coalesce(good, F.lit(False)))
    known = D.baseline(spark, sf).withColumn("known", F.lit(True))
    pairs = rows.where("good").groupBy("host", "year").agg(F.count("*").alias("n")).join(known, ["host", "year"], "left").withColumn("tld", H.tld(F.col("host"))).join(D.weights(spark, sf), "tld", "left")
    new = F.col("known").isNull()
    p = pairs.agg(F.sum(F.col("n") - 1).alias("duplicates"), F.count("known").alias("overlap"), F.count_if(new).alias("novel"), F.sum(F.when(new, F.coalesce("weight", F.lit(0)).cast(E.WEIGHT))).cast("double").alias("novel_eed"))
    return rows.agg(F.count("*").alias("input"), F.count_if(~F.col("good")).alias("invalid")).join(F.broadcast(p))


@query("b13_precheck", f"""
WITH {D.BASE}, {D.WEIGHTS}, a AS (SELECT DISTINCT host, year FROM valid), s AS (
 SELECT count(*) AS host_years, count(DISTINCT a.year) AS years, CAST(sum(coalesce(weight, 0)) FILTER (WHERE b.host IS NULL) AS DOUBLE) AS novel_eed, CAST(sum(coalesce(weight, 0)) FILTER (WHERE b.host IS NOT NULL) AS DOUBLE) AS baseline_eed
 FROM a LEFT JOIN baseline b USING (host, year) LEFT JOIN weights ON weights.tld = list_extract(string_split(a.host, '.'), -1))
SELECT host_years, years, novel_eed, baseline_eed, concat_ws(',', CASE WHEN years < 6 THEN 'missing_years' END, CASE WHEN novel_eed <= 0 THEN 'no_novelty' END, CASE WHEN novel_eed < 0.05 * baseline_eed THEN 'below_gate' END) AS reasons FROM s""")
def b13_precheck(spark: SparkSession, sf: str) -> DataFrame:
    """Whether a submission is ready, with what stands against it."""
    known = D.baseline(spark, sf).withColumn("known", F.lit(True))
    rows = D.valid_captures(spark, sf).select("host", "year").distinct().join(known, ["host", "year"], "left").withColumn("tld", H.tld(F.col("host"))).join(D.weights(spark, sf), "tld", "left")
    w = F.coalesce("weight", F.lit(0)).cast(E.WEIGHT)
    s = rows.agg(F.count("*").alias("host_years"), F.countDistinct("year").alias("years"), F.sum(F.when(F.col("known").isNull(), w)).alias("n"), F.sum(F.when(F.col("known"), w)).alias("b"))
    reasons = F.array_compact(F.array(F.when(F.col("years") < 6, F.lit("missing_years")), F.when(F.col("n") <= 0, F.lit("no_novelty")), F.when(~E.passes(F.col("n"), F.col("b"), "0.05"), F.lit("below_gate"))))
    return s.select("host_years", "years", F.col("n").cast("double").alias("novel_eed"), F.col("b").cast("double").alias("baseline_eed"), F.array_join(reasons, ",").alias("reasons"))

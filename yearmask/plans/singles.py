"""Queries that apply one operator each where other queries use it only in passing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearmask.functions import hosts as H
from yearmask.operators import evidence as V
from yearmask.operators import sketch as M
from yearmask.operators import value as A
from yearmask.plans import derived as D
from yearmask.plans.analytics import cells
from yearmask.plans.evidence import CAPSULES, _ORIGINS, capsules, origin_logs
from yearmask.plans.registry import query
from yearmask.plans.streams import log_stream
from yearmask.sources import framing as R
from yearmask.sources import lines as L
from yearmask.streaming import evidence as T


@query("a1_line_scan", f"WITH {D.CAPTURES} SELECT year, count(*) AS lines, CAST(sum(length(raw)) AS BIGINT) AS chars FROM captures GROUP BY year")
def a1_line_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A1: lines written to one folder a year and scanned with the file that each came from."""
    path = T.work_folder(spark, "lines")
    D.captures(spark, sf).select("year", F.col("raw").alias("value")).write.partitionBy("year").text(path)
    rows = L.read_lines(spark, f"{path}/*/*.txt").select(F.regexp_extract("file", r"year=(\d+)", 1).cast("int").alias("year"), "value")
    return rows.groupBy("year").agg(F.count("*").alias("lines"), F.sum(F.length("value")).cast("long").alias("chars"))


@query("a1_line_locators", f"WITH {D.CAPTURES} SELECT year, CAST(seq // 8192 AS BIGINT) AS chunk, row_number() OVER (PARTITION BY year, seq // 8192 ORDER BY seq) AS line, raw AS value FROM captures")
def a1_line_locators(spark: SparkSession, sf: str) -> DataFrame:
    """A1: lines with their place in their file. Files hold a year's captures of some orders; half of them are gzipped."""
    path = T.work_folder(spark, "numbered")
    rows = D.captures(spark, sf).select("year", F.floor(F.col("seq") / 8192).alias("chunk"), "seq", F.col("raw").alias("value"))
    for form, part in (("none", "chunk % 2 = 0"), ("gzip", "chunk % 2 = 1")):
        rows.where(part).repartition("year", "chunk").sortWithinPartitions("year", "chunk", "seq").drop("seq").write.partitionBy("year", "chunk").option("compression", form).text(f"{path}/{form}")
    read = R.read_numbered_lines(spark, f"{path}/*/*/*")
    told = [F.regexp_extract("locator", rf"{name}=(\d+)/", 1).cast(kind).alias(name) for name, kind in (("year", "int"), ("chunk", "long"))]
    return read.select(*told, F.regexp_extract("locator", r":(\d+)\z", 1).cast("long").alias("line"), "value")


@query("a11_host_column_inference", "SELECT CAST(r_regionkey AS INT) AS file, CASE WHEN r_regionkey % 2 = 0 THEN 'where' END AS hosts_field FROM region")
def a11_host_column_inference(spark: SparkSession, sf: str) -> DataFrame:
    """The host column of each file; none where two are equally good."""
    nation = D.table(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("file"))
    customer = D.table(spark, sf, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    site = F.concat(F.lit("c"), "c_custkey", F.lit(".example.com"))
    record = F.struct(site.alias("where"), F.when(F.col("file") % 2 == 1, F.concat(F.lit("http://"), site, F.lit("/"))).alias("link"), F.col("c_mktsegment").alias("segment"))
    return L.infer_fields(customer.select("file", F.to_json(record).alias("value"))).select("file", F.col("host_field").alias("hosts_field"))


@query("b4_contract_binding", f"WITH {CAPSULES} SELECT seq, seq % 4 = 0 AND seq % 3 < 2 AS bound FROM capsules")
def b4_contract_binding(spark: SparkSession, sf: str) -> DataFrame:
    return capsules(spark, sf).select("seq", "bound")


_MASKS = f"WITH {D.BASE}, e AS (SELECT host, {D.BITS} AS m, count(*) AS captures FROM valid GROUP BY host), b AS (SELECT host, {D.BITS} AS m FROM baseline GROUP BY host) "


@query("j3_mask_difference", _MASKS + "SELECT host, captures, CAST(e.m & ~coalesce(b.m, 0) & 7 AS INT) AS novel_mask FROM e LEFT JOIN b USING (host) WHERE e.m & ~coalesce(b.m, 0) & 7 <> 0")
def j3_mask_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Masks less the baseline for a target of three years, provenance kept."""
    masks = D.valid_captures(spark, sf).groupBy("host").agg(F.bit_or(H.bit(F.col("year"))).alias("year_mask"), F.count("*").alias("captures"))
    return V.subtract(masks, V.mask_by_host(D.baseline(spark, sf)), target=7).select("host", "captures", "novel_mask")


@query("j4_evidence_masks", f"WITH {D.VALID}, q AS (SELECT DISTINCT host FROM valid WHERE provider = 'ia'), e AS (SELECT host, {D.BITS} AS m FROM valid WHERE provider <> 'ia' GROUP BY host) SELECT host, coalesce(m, 0) AS year_mask FROM q LEFT JOIN e USING (host)")
def j4_evidence_masks(spark: SparkSession, sf: str) -> DataFrame:
    """What is already proven of each host asked for."""
    rows = D.valid_captures(spark, sf)
    return rows.where("provider = 'ia'").select("host").distinct().join(V.mask_by_host(rows.where("provider <> 'ia'")), "host", "left").select("host", F.coalesce("year_mask", F.lit(0)).alias("year_mask"))


@query("g14_unseen_mass", f"""
WITH {D.VALID}, k AS (SELECT provider, host, count(*) AS c FROM valid GROUP BY ALL)
SELECT provider, CAST(sum(c) AS BIGINT) AS observations, count(*) AS distinct_keys, count(*) FILTER (WHERE c = 1) AS singletons, count(*) FILTER (WHERE c = 2) AS doubletons, count(*) FILTER (WHERE c = 1) / sum(c) AS unseen_fraction, count(*) FILTER (WHERE c = 1) / sum(c) * greatest(1, count(*)) AS opportunity FROM k GROUP BY provider""")
def g14_unseen_mass(spark: SparkSession, sf: str) -> DataFrame:
    return A.unseen(D.valid_captures(spark, sf), "provider", "host")


@query("g22_cell_statistics", """
SELECT p_type AS mechanism, p_brand AS institution, count(*) AS attempts, CAST(sum(p_size) AS BIGINT) AS results, coalesce(sum(p_partkey % (p_size + 1)) / nullif(sum(p_size), 0), 0) AS duplicate_fraction, least(1, coalesce(sum(p_partkey % 7 % (p_size + 1)) / nullif(sum(p_size), 0), 0)) AS qualified_fraction FROM part GROUP BY ALL""")
def g22_cell_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return A.cell_fractions(cells(spark, sf), [["mechanism", "institution"]]).select("mechanism", "institution", "attempts", "results", "duplicate_fraction", "qualified_fraction")


@query("u1_accepted_minus_baseline", f"WITH {D.BASE} SELECT host, year FROM valid EXCEPT SELECT host, year FROM baseline")
def u1_accepted_minus_baseline(spark: SparkSession, sf: str) -> DataFrame:
    return V.novel_host_years(D.valid_captures(spark, sf), D.baseline(spark, sf))


@query("u5_origin_union", f"WITH {_ORIGINS} SELECT origin, source_id, count(*) AS n, min(ts) AS first_seen FROM o GROUP BY origin, source_id")
def u5_origin_union(spark: SparkSession, sf: str) -> DataFrame:
    return origin_logs(spark, sf).groupBy("origin", "source_id").agg(F.count("*").alias("n"), F.min("ts").alias("first_seen"))


@query("u8_intersection_sizes", "SELECT p_partkey, least(p_size, p_partkey, (p_size % 10 / 10) * (p_size + p_partkey) / (1 + p_size % 10 / 10)) AS shared FROM part")
def u8_intersection_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return D.table(spark, sf, "part").select("p_partkey", M.intersection(F.col("p_size"), F.col("p_partkey"), F.col("p_size") % 10 / 10).alias("shared"))


_PAGE_HOST = "lower(regexp_extract(url, '^https?://([^/?#:]+)', 1))"


@query("s2_scalar_hosts", f"SELECT page_id, CASE page_id % 5 WHEN 4 THEN NULL ELSE {_PAGE_HOST} END AS host FROM pages")
def s2_scalar_hosts(spark: SparkSession, sf: str) -> DataFrame:
    """Hosts of URLs, of ``//host``, of ``host/path``, of bare hosts, and of what has none."""
    host, k = F.regexp_extract("url", "^https?://([^/?#:]+)", 1), F.col("page_id") % 5
    forms = F.when(k == 0, F.col("url")).when(k == 1, F.concat(F.lit("//"), host, F.lit(":8080/x"))).when(k == 2, F.concat(host, F.lit("/path?x=1"))).when(k == 3, F.concat(F.lit(' "'), F.upper(host), F.lit('" '))).otherwise(F.concat(F.lit("no host in "), host))
    return D.table(spark, sf, "pages").select("page_id", H.host_of(forms).alias("host"))


@query("s3_tld_and_depth", f"WITH {D.VALID} SELECT {D.TLD_OF} AS tld, CAST(len(string_split(host, '.')) - 2 AS INT) AS depth, count(DISTINCT host) AS hosts FROM valid GROUP BY 1, 2")
def s3_tld_and_depth(spark: SparkSession, sf: str) -> DataFrame:
    h = D.valid_captures(spark, sf).select("host").distinct()
    return h.groupBy(H.tld(F.col("host")).alias("tld"), H.depth(F.col("host")).alias("depth")).agg(F.count("*").alias("hosts"))


@query("s5_registrable_parents", f"""
WITH {D.VALID}, h AS (SELECT DISTINCT host, string_split(host, '.') AS l FROM valid)
SELECT host, CASE WHEN length(list_extract(l, -1)) = 2 THEN CASE WHEN len(l) >= 3 THEN array_to_string(l[-3:], '.') END ELSE array_to_string(l[-2:], '.') END AS parent FROM h""")
def s5_registrable_parents(spark: SparkSession, sf: str) -> DataFrame:
    return D.valid_captures(spark, sf).select("host").distinct().select("host", H.registrable_parent(F.col("host")).alias("parent"))


@query("s6_parent_domains", f"""
WITH {D.VALID}, h AS (SELECT DISTINCT host, string_split(host, '.') AS l FROM valid) SELECT host, CASE WHEN len(l) >= 3 AND NOT (length(list_extract(l, -1)) = 2 AND len(l) < 4) THEN array_to_string(l[2:], '.') END AS parent FROM h""")
def s6_parent_domains(spark: SparkSession, sf: str) -> DataFrame:
    return D.valid_captures(spark, sf).select("host").distinct().select("host", H.parent_domain(F.col("host")).alias("parent"))


@query("s9_source_keys", "SELECT page_id, concat('src:', sha256(regexp_replace(url, '#.*$', ''))) AS key, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS origin FROM pages")
def s9_source_keys(spark: SparkSession, sf: str) -> DataFrame:
    return D.table(spark, sf, "pages").select("page_id", H.source_key(F.col("url")).alias("key"), H.origin(F.col("url")).alias("origin"))


@query("s11_doi_and_family", "SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN concat('10.', 1000 + p_size, '/part.', p_partkey) END AS doi, p_name AS family FROM part")
def s11_doi_and_family(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    bare = F.concat(F.lit("10."), F.col("p_size") + 1000, F.lit("/Part."), "p_partkey")
    text = F.when(k == 0, F.concat(bare, F.lit(".;"))).when(k == 1, F.concat(F.lit(" https://dx.doi.org/"), bare)).otherwise(F.concat(F.lit("see "), bare))
    title = F.concat(F.upper("p_name"), F.lit(", version 3.1 [2001]"))
    return D.table(spark, sf, "part").select("p_partkey", H.doi(text).alias("doi"), H.family_label(title).alias("family"))


_R, _M = (", ".join(f"'{t}'" for t in x) for x in (H.RESOURCE_TERMS, H.META_TERMS))


@query("s13_link_signals", rf"""
WITH t AS (SELECT p_partkey, concat('/', p_name, CASE p_size % 3 WHEN 0 THEN '/catalog/index' WHEN 1 THEN '/datasets' ELSE '/x' END, CASE WHEN p_partkey % 4 = 0 THEN '.csv.gz' ELSE '' END) AS path FROM part), k AS (SELECT p_partkey, path, list_distinct(regexp_split_to_array(lower(path), '[^a-z0-9]+')) AS tokens FROM t)
SELECT p_partkey, CAST(len(list_intersect(tokens, [{_R}])) AS INT) AS resource_hits, CAST(len(list_intersect(tokens, [{_M}])) AS INT) AS meta_hits, ends_with(path, '.csv.gz') AS bulk FROM k""")
def s13_link_signals(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("p_size") % 3
    path = F.concat(F.lit("/"), "p_name", F.when(s == 0, "/catalog/index").when(s == 1, "/datasets").otherwise("/x"), F.when(F.col("p_partkey") % 4 == 0, ".csv.gz").otherwise(""))
    return D.table(spark, sf, "part").select("p_partkey", H.link_hits(path, H.RESOURCE_TERMS).alias("resource_hits"), H.link_hits(path, H.META_TERMS).alias("meta_hits"), H.is_bulk(path).alias("bulk"))


@query("d3_source_values", """
SELECT p_partkey, greatest(0.0, p_retailprice - 1500 + p_size + 1.0 / sqrt(1.0 + p_size)) * greatest(0.0, 1.0 - p_size % 13 / 10) / greatest(0.000001, p_size / 7) AS value FROM part""")
def d3_source_values(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("p_size")
    return D.table(spark, sf, "part").select("p_partkey", A.source_value(F.col("p_retailprice") - 1500, s, 1.0 / F.sqrt(1.0 + s), s % 13 / 10, s / 7).alias("value"))


@query("d4_scout_priority", """
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 1.25 ELSE 1.6 END * ln(1 + greatest(1, coalesce(CASE WHEN p_size % 4 <> 0 THEN p_partkey END, CASE WHEN p_size % 5 >= 3 THEN 100000 END, 1))) * greatest(0.01, 1.0 - p_size % 12 / 10) * (1.0 + 0.3 + 0.6 + p_size % 5 / 5) / 4.0
 * (1.0 + 4.0 * (p_size % 5 / 5)) * greatest(0.05, p_partkey % 10 / 10) / greatest(0.1, 1.0 + 0.5 + 0.25) AS priority FROM part""")
def d4_scout_priority(spark: SparkSession, sf: str) -> DataFrame:
    s, k = F.col("p_size"), F.col("p_partkey")
    level = F.when(s % 3 == 0, "SOURCE").when(s % 3 == 1, "COLLECTION").otherwise("METASOURCE")
    volume = F.when(s % 4 != 0, k)
    return D.table(spark, sf, "part").select("p_partkey", A.scout_priority(level, volume, s % 5 / 5, s % 12 / 10, F.lit(0.3), F.lit(0.6), F.lit(0.5), F.lit(0.25), k % 10 / 10).alias("priority"))


@query("t2_replay_on_new_authority", f"""
WITH {D.LOG} SELECT 'old' AS authority, count(*) AS novel FROM (SELECT DISTINCT host, year FROM log EXCEPT SELECT host, year FROM log WHERE lane = 'R') UNION ALL SELECT 'new', count(*) FROM (SELECT DISTINCT host, year FROM log EXCEPT SELECT host, year FROM log WHERE lane = 'A')""")
def t2_replay_on_new_authority(spark: SparkSession, sf: str) -> DataFrame:
    """Two authorities under one root: the digest of the second is another, so it replays the log from zero."""
    out, root = None, T.work_folder(spark, "novelty")
    for name, lane in (("old", "R"), ("new", "A")):
        base = D.log(spark, sf).where(F.col("lane") == lane).select("host", "year").distinct()
        novel = T.novelty_under(log_stream(spark, sf), base, D.weights(spark, sf), root)
        one = novel.agg(F.lit(name).alias("authority"), F.count("*").alias("novel"))
        out = one if out is None else out.unionByName(one)
    return out

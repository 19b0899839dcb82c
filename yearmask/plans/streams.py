"""Streaming queries: each reads its table as a stream and gives the same rows as a batch would."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearmask.functions import hosts as H
from yearmask.operators import eed as E
from yearmask.operators.graph import stored
from yearmask.operators.ordered import place
from yearmask.plans import derived as D
from yearmask.plans.registry import query
from yearmask.streaming import evidence as S


def file_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of files: one file or a folder of them."""
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()
    options = {} if folder else {"pathGlobFilter": f"{name}.parquet"}
    return spark.readStream.schema(schema).options(**options).option("maxFilesPerTrigger", 16).parquet(path if folder else sf_dir)


def in_batches(spark: SparkSession, rows: DataFrame, order: str, n: int = 3) -> DataFrame:
    """rows as a stream of ``n`` batches in an order: written range after range, read a range's files at a time. All ranges
    have equally many files, empty ones where there are too few, since a batch is so many files and nothing else: one that
    began with some files of a range would bring its later rows before earlier ones."""
    path = S.work_folder(spark, "batches")
    cuts = rows.agg(F.percentile_approx(F.col(order).cast("long"), [i / n for i in range(1, n)])).first()[0] or []
    where, each = spark._jvm.org.apache.hadoop.fs.Path, spark.sparkContext.defaultParallelism
    for i in range(n):
        rows.where(place(F.col(order).cast("long"), cuts) == i).repartition(each).write.parquet(f"{path}/{i}")
    files = where(path).getFileSystem(spark._jsc.hadoopConfiguration())
    counts = [len(files.globStatus(where(f"{path}/{i}/[^_.]*"))) for i in range(n)]
    for i, count in enumerate(counts):
        for _ in range(max(counts) - count):
            spark.createDataFrame([], rows.schema).coalesce(1).write.mode("append").parquet(f"{path}/{i}")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max(counts)).parquet(f"{path}/*")


_LOGGED = D.LOG + ", b AS (SELECT DISTINCT host, year FROM log WHERE lane = 'R'), f AS (SELECT host, year, arg_min(source_id, seq) AS source_id, arg_min(lane, seq) AS lane FROM log GROUP BY host, year), novel AS (SELECT f.* FROM f LEFT JOIN b USING (host, year) WHERE b.host IS NULL)"


def log_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The capture log of derived.log, as a stream."""
    t = F.expr(D.TLD.format(k="CAST(l_partkey % 25 AS INT)"))
    return file_stream(spark, sf, "lineitem").where(D.IN_WINDOW.format(c="l_shipdate")).select(
        F.concat(F.lit("p"), F.col("l_partkey"), F.lit("."), t).alias("host"), F.year("l_shipdate").alias("year"), F.concat(F.lit("s"), F.col("l_suppkey") % 60).alias("source_id"), F.col("l_returnflag").alias("lane"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), F.col("l_partkey").alias("part"),
    )


def _novel(spark: SparkSession, sf: str) -> DataFrame:
    base = D.log(spark, sf).where("lane = 'R'").select("host", "year").distinct()
    return S.incremental_novelty(log_stream(spark, sf), base, S.work_folder(spark, "novelty"))


@query("t1_incremental_novelty", f"WITH {_LOGGED}, {D.WEIGHTS} SELECT year, lane, count(*) AS host_years, CAST(sum(coalesce(weight, 0)) AS DOUBLE) AS eed FROM novel LEFT JOIN weights ON weights.tld = {D.TLD_OF} GROUP BY year, lane")
def t1_incremental_novelty(spark: SparkSession, sf: str) -> DataFrame:
    """Totals over the host-years that the incremental stream has kept."""
    return E.report(_novel(spark, sf), D.weights(spark, sf), [["year", "lane"]]).drop("level")


@query("t1_attribution_totals", f"""
WITH {D.LOG}, m AS (SELECT concat('p', l_partkey, '.', {D.TLD.format(k="CAST(l_partkey % 25 AS INT)")}) AS host, CAST(year(l_shipdate) AS INT) AS year, l_orderkey * 10 + l_linenumber AS seq, concat('s', l_suppkey % 60) AS source, concat('r', l_orderkey // 1000) AS run, l_linestatus AS kind, l_returnflag AS lane FROM lineitem WHERE year(l_shipdate) BETWEEN 1996 AND 2001),
b AS (SELECT DISTINCT host, year FROM m WHERE lane = 'R'), f AS (SELECT host, year, arg_min(source, seq) AS source, arg_min(run, seq) AS run, arg_min(kind, seq) AS kind FROM m GROUP BY host, year), novel AS (SELECT f.* FROM f LEFT JOIN b USING (host, year) WHERE b.host IS NULL), {D.WEIGHTS}
SELECT year, source, run, kind, count(*) AS host_years, CAST(sum(coalesce(weight, 0)) AS DOUBLE) AS eed FROM novel LEFT JOIN weights ON weights.tld = {D.TLD_OF} GROUP BY GROUPING SETS ((year), (source), (run), (kind))""")
def t1_attribution_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Totals by year, source, run and kind over what the stream has kept, after several batches."""
    t = F.expr(D.TLD.format(k="CAST(l_partkey % 25 AS INT)"))
    rows = D.table(spark, sf, "lineitem").where(D.IN_WINDOW.format(c="l_shipdate")).select(
        F.concat(F.lit("p"), F.col("l_partkey"), F.lit("."), t).alias("host"), F.year("l_shipdate").alias("year"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.concat(F.lit("s"), F.col("l_suppkey") % 60).alias("source"), F.concat(F.lit("r"), F.floor(F.col("l_orderkey") / 1000)).alias("run"), F.col("l_linestatus").alias("kind"), F.col("l_returnflag").alias("lane"),
    )
    base = rows.where("lane = 'R'").select("host", "year").distinct()
    novel = S.incremental_novelty(in_batches(spark, rows, "seq"), base, S.work_folder(spark, "novelty"))
    return E.report(novel, D.weights(spark, sf), [["year"], ["source"], ["run"], ["kind"]]).drop("level")


@query("t3_readiness_gates", f"""
WITH {_LOGGED}, {D.WEIGHTS}, n AS (SELECT year, sum(coalesce(weight, 0)) AS eed FROM novel LEFT JOIN weights ON weights.tld = {D.TLD_OF} GROUP BY year), k AS (SELECT year, sum(coalesce(weight, 0)) AS eed FROM b LEFT JOIN weights ON weights.tld = {D.TLD_OF} GROUP BY year)
SELECT year, CAST(n.eed AS DOUBLE) AS novel_eed, n.eed >= k.eed * CAST(0.045 AS DECIMAL(6,4)) AS prewarm, n.eed >= k.eed * CAST(0.05 AS DECIMAL(6,4)) AS formal, n.eed >= k.eed * CAST(0.0525 AS DECIMAL(6,4)) AS dispatch FROM n JOIN k USING (year)""")
def t3_readiness_gates(spark: SparkSession, sf: str) -> DataFrame:
    """The gates (90 % of formal, 5 %, 5.25 %) over the sink of T1."""
    w = F.coalesce("weight", F.lit(0)).cast(E.WEIGHT)

    def weighed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("tld", H.tld(F.col("host"))).join(D.weights(spark, sf), "tld", "left").groupBy("year").agg(F.sum(w).alias("e"))

    n = weighed(_novel(spark, sf)).withColumnRenamed("e", "n")
    k = weighed(D.log(spark, sf).where("lane = 'R'").select("host", "year").distinct()).withColumnRenamed("e", "k")
    gates = {g: E.passes(F.col("n"), F.col("k"), r).alias(g) for g, r in (("prewarm", "0.045"), ("formal", "0.05"), ("dispatch", "0.0525"))}
    return n.join(k, "year").select("year", F.col("n").cast("double").alias("novel_eed"), *gates.values())


@query("t4_first_wins", f"WITH {_LOGGED} SELECT host, year, source_id, lane FROM novel")
def t4_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    """T4: the first row of each host-year of the stream."""
    return _novel(spark, sf).select("host", "year", "source_id", "lane")


@query("t5_candidate_status", f"""
WITH {D.CAPTURES} SELECT host, coalesce(arg_min(CASE status WHEN 'F' THEN 'VERIFIED' ELSE 'REJECTED' END, seq) FILTER (WHERE status IN ('F', 'P')), 'ACTIVE') AS status FROM captures WHERE host IS NOT NULL GROUP BY host""")
def t5_candidate_status(spark: SparkSession, sf: str) -> DataFrame:
    """T5 over a table: what each candidate has come to."""
    events = D.captures(spark, sf).where("host is not null").select("host", "seq", F.when(F.col("status") == "F", "VERIFIED").when(F.col("status") == "P", "REJECTED").otherwise("ACTIVE").alias("status"))
    return S.candidate_status_batch(events)


@query("t5_status_stream", f"""
WITH {D.CAPTURES} SELECT host, coalesce(arg_min(CASE status WHEN 'F' THEN 'VERIFIED' ELSE 'REJECTED' END, seq) FILTER (WHERE status IN ('F', 'P')), 'ACTIVE') AS status FROM captures WHERE host IS NOT NULL GROUP BY host""")
def t5_status_stream(spark: SparkSession, sf: str) -> DataFrame:
    """T5 as a stateful stream over several batches: the first terminal event stands. Captures are made once and filtered as
    they are read: a filter of hosts above the join would match each host once more in the join, and again for each range."""
    status = F.when(F.col("status") == "F", "VERIFIED").when(F.col("status") == "P", "REJECTED").otherwise("ACTIVE")
    events = stored(D.captures(spark, sf).select("host", "seq", status.alias("status")), "captures").where("host is not null")
    return S.keep(S.candidate_status(in_batches(spark, events, "seq")), S.work_folder(spark, "statuses"), ["host"])


@query("t5_status_history", f"""
WITH {D.CAPTURES}, c AS (SELECT host, seq, provider, CASE status WHEN 'F' THEN 'VERIFIED' WHEN 'P' THEN 'REJECTED' ELSE 'ACTIVE' END AS status FROM captures WHERE host IS NOT NULL)
SELECT host, 'ACTIVE' AS status, NULL::VARCHAR AS reason, min(seq) AS seq FROM c GROUP BY host UNION ALL SELECT host, arg_min(status, seq), arg_min(provider, seq), min(seq) FROM c WHERE status <> 'ACTIVE' GROUP BY host""")
def t5_status_history(spark: SparkSession, sf: str) -> DataFrame:
    """T5 as a stream: every status that each candidate has had, why and since when."""
    events = D.captures(spark, sf, file_stream(spark, sf, "orders")).where("host is not null")
    status = F.when(F.col("status") == "F", "VERIFIED").when(F.col("status") == "P", "REJECTED").otherwise("ACTIVE")
    return S.status_history(events.select("host", "seq", status.alias("status"), F.col("provider").alias("reason")), S.work_folder(spark, "status"))


@query("t6_live_suppressions", f"""
WITH {D.RUNS}, l AS (SELECT source, arg_max(ts + INTERVAL 3 DAY, ts) AS expires_at FROM runs WHERE kind = 'error' GROUP BY source) SELECT 'SOURCE' AS scope, source AS key, expires_at FROM l WHERE expires_at > TIMESTAMP '2024-02-01'""")
def t6_live_suppressions(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.runs(spark, sf).where("kind = 'error'").select(F.lit("SOURCE").alias("scope"), F.col("source").alias("key"), F.col("ts").alias("set_at"), F.expr("ts + interval 3 days").alias("expires_at"))
    return S.live_suppressions(rows, F.lit("2024-02-01").cast("timestamp"))


@query("t6_suppression_stream", f"""
WITH {D.RUNS}, l AS (SELECT kind, source, max(ts) AS set_at FROM runs WHERE kind IN ('error', 'signup') GROUP BY kind, source), e AS (SELECT CASE kind WHEN 'error' THEN 'SOURCE' ELSE 'FAMILY' END AS scope, source AS key, set_at + CASE kind WHEN 'error' THEN INTERVAL 3 DAY ELSE INTERVAL 1 DAY END AS expires_at FROM l)
SELECT scope, key, expires_at, expires_at > (SELECT max(ts) FROM runs WHERE kind IN ('error', 'signup')) - INTERVAL 2 DAY AS live FROM e""")
def t6_suppression_stream(spark: SparkSession, sf: str) -> DataFrame:
    """T6 as a stateful stream over several batches in the order of time: suppressions end by timers, two days late at most."""
    rows = D.runs(spark, sf).where("kind in ('error', 'signup')").withColumn("set_at", F.col("ts").cast("timestamp"))
    ends = F.when(F.col("kind") == "error", F.expr("set_at + interval 3 days")).otherwise(F.expr("set_at + interval 1 day"))
    events = rows.select(F.when(F.col("kind") == "error", "SOURCE").otherwise("FAMILY").alias("scope"), F.col("source").alias("key"), "set_at", ends.alias("expires_at"), F.col("kind").alias("reason"))
    states = S.suppression_states(in_batches(spark, events, "set_at"), S.work_folder(spark, "suppressions"), "2 days")
    return states.select("scope", "key", F.timestamp_micros("expires_us").cast("timestamp_ntz").alias("expires_at"), "live")


@query("t7_running_counters", "SELECT event_type AS name, CAST(sum(event_id % 9) AS BIGINT) AS total, last(event_id % 9 ORDER BY ts, event_id) AS last, max(event_id % 9) AS highest, min(event_id % 9) AS lowest, count(*) AS n FROM events GROUP BY event_type")
def t7_running_counters(spark: SparkSession, sf: str) -> DataFrame:
    rows = file_stream(spark, sf, "events").select(F.col("event_type").alias("name"), (F.col("event_id") % 9).alias("value"), "ts", F.col("event_id").alias("id"))
    return S.running_counters(rows, S.work_folder(spark, "counters"))

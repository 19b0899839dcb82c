"""Host-year tables made from the given ones, each with its SQL twin.

The given tables have no hosts and captures; orders, line items and events stand in for them by fixed rules, row for row,
so every derived table grows with its source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearmask.functions.hosts import normalize_host

#: the TLD of a nation's key, the same expression in both engines
TLD = "CASE WHEN {k} = 0 THEN 'com' WHEN {k} = 1 THEN 'org' ELSE concat(chr(97 + CAST(floor({k} / 5) AS INT)), chr(97 + {k} % 5)) END"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """rows dealt over all cores if they come in fewer parts: a small file of one row group is one task otherwise. Filters
    and columns still reach the scan; tables of many files stay as they are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def captures(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Raw dated captures, one an order (of the table, or of a stream of it): seq, raw host, host (null if invalid), year, ts,
    source_id, provider, kind, cost."""
    orders, customer = orders or spread(table(spark, sf_dir, "orders")), table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).withColumn("t", F.expr(TLD.format(k="c_nationkey")))
    k = F.col("o_custkey")
    raw = (
        F.when(k % 41 == 0, F.concat(F.lit("bad_host"), k, F.lit("."), "t"))
        .when(k % 37 == 0, F.concat(F.lit("  WWW.C"), k, F.lit("."), F.upper("t"), F.lit(" ")))
        .when(k % 5 == 0, F.concat(F.lit("a"), k % 7, F.lit(".n.c"), k % 40, F.lit("."), "t"))
        .otherwise(F.concat(F.lit("c"), k, F.lit("."), "t"))
    )
    return rows.select(
        F.col("o_orderkey").alias("seq"), raw.alias("raw"), normalize_host(raw).alias("host"), F.year("o_orderdate").alias("year"), F.col("o_orderdate").alias("ts"), F.col("o_orderstatus").alias("status"),
        F.concat(F.lit("src"), F.col("o_orderkey") % 40).alias("source_id"),
        F.element_at(F.array(*map(F.lit, ("ia", "arquivo", "rdap", "direct:lists", "dns"))), (F.col("o_orderkey") % 5 + 1).cast("int")).alias("provider"),
        F.col("o_orderpriority").alias("kind"), F.col("o_totalprice").alias("cost"),
    )


def host_sql(raw: str) -> str:
    """SQL of a normalised host."""
    h = f"lower(regexp_replace({raw}, '^\\s+|\\s+$', '', 'g'))"
    return f"CASE WHEN length({h}) <= 253 AND regexp_full_match({h}, '(?:[a-z0-9](?:[a-z0-9-]{{0,61}}[a-z0-9])?\\.)+[a-z]{{2,63}}') THEN {h} END"


_TLD_SQL = TLD.format(k="c_nationkey")
CAPTURES = f"""
raw_captures AS (
  SELECT *, {_TLD_SQL} AS t FROM orders JOIN customer ON o_custkey = c_custkey),
named_captures AS (
  SELECT *, CASE WHEN o_custkey % 41 = 0 THEN concat('bad_host', o_custkey, '.', t)
                 WHEN o_custkey % 37 = 0 THEN concat('  WWW.C', o_custkey, '.', upper(t), ' ')
                 WHEN o_custkey % 5 = 0 THEN concat('a', o_custkey % 7, '.n.c', o_custkey % 40, '.', t)
                 ELSE concat('c', o_custkey, '.', t) END AS raw FROM raw_captures),
captures AS (
  SELECT o_orderkey AS seq, raw, {host_sql("raw")} AS host, CAST(year(o_orderdate) AS INT) AS year, o_orderdate AS ts, o_orderstatus AS status,
         concat('src', o_orderkey % 40) AS source_id, ['ia', 'arquivo', 'rdap', 'direct:lists', 'dns'][o_orderkey % 5 + 1] AS provider, o_orderpriority AS kind, o_totalprice AS cost
  FROM named_captures)"""

VALID = CAPTURES + ", valid AS (SELECT * FROM captures WHERE host IS NOT NULL AND year BETWEEN 1996 AND 2001)"
BASE = VALID + ", baseline AS (SELECT DISTINCT host, year FROM valid WHERE status = 'F')"
BITS = "CAST(bit_or(1 << CAST(year - 1996 AS INT)) AS INT)"


#: the window as a range of times, which reaches the scan's row groups; a filter on year() would not
IN_WINDOW = "{c} >= timestamp '1996-01-01' and {c} < timestamp '2002-01-01'"


def valid_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captures(spark, sf_dir).where(IN_WINDOW.format(c="ts")).where("host is not null")


def baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The known host-years: those with a closed order."""
    return valid_captures(spark, sf_dir).where("status = 'F'").select("host", "year").distinct()


def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English weights by TLD: some TLDs are missing from the model, one has weight 0."""
    n = table(spark, sf_dir, "nation").where("n_nationkey % 7 <> 3")
    share = F.when(F.col("n_nationkey") == 5, 0).otherwise(F.col("n_nationkey") * 37 % 101)
    return n.select(F.expr(TLD.format(k="n_nationkey")).alias("tld"), (share.cast("decimal(9,4)") * F.lit("0.01").cast("decimal(4,2)")).cast("decimal(9,6)").alias("weight"))


WEIGHTS = f"""weights AS (
  SELECT {TLD.format(k="n_nationkey")} AS tld, CAST(CAST(CASE WHEN n_nationkey = 5 THEN 0 ELSE n_nationkey * 37 % 101 END AS DECIMAL(9,4)) * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(9,6)) AS weight
  FROM nation WHERE n_nationkey % 7 <> 3)"""

#: TLD of a host in SQL
TLD_OF = "list_extract(string_split(host, '.'), -1)"


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A larger capture log, one a line item: host, year, source_id, lane, seq, n (quantity)."""
    t = F.expr(TLD.format(k="CAST(l_partkey % 25 AS INT)"))
    rows = spread(table(spark, sf_dir, "lineitem")).where(IN_WINDOW.format(c="l_shipdate"))
    return rows.select(
        F.concat(F.lit("p"), F.col("l_partkey"), F.lit("."), t).alias("host"), F.year("l_shipdate").alias("year"), F.concat(F.lit("s"), F.col("l_suppkey") % 60).alias("source_id"),
        F.col("l_returnflag").alias("lane"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), F.col("l_quantity").alias("n"),
    )


LOG = f"""log AS (
  SELECT concat('p', l_partkey, '.', {TLD.format(k="CAST(l_partkey % 25 AS INT)")}) AS host, CAST(year(l_shipdate) AS INT) AS year, concat('s', l_suppkey % 60) AS source_id,
         l_returnflag AS lane, l_orderkey * 10 + l_linenumber AS seq, l_quantity AS n
  FROM lineitem WHERE year(l_shipdate) BETWEEN 1996 AND 2001)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed source runs, one an event: run_id, source, kind, ts, eed, cost, requests."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"), F.concat(F.lit("src"), F.col("user_id") % 50).alias("source"), F.col("event_type").alias("kind"), "ts",
        F.when(F.col("event_id") % 3 == 0, 0.0).otherwise(F.col("value")).alias("eed"), (F.col("event_id") % 17 + 1).cast("double").alias("cost"), (F.col("event_id") % 9).alias("requests"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


RUNS = """runs AS (
  SELECT event_id AS run_id, concat('src', user_id % 50) AS source, event_type AS kind, ts, CASE WHEN event_id % 3 = 0 THEN 0.0 ELSE value END AS eed,
         CAST(event_id % 17 + 1 AS DOUBLE) AS cost, event_id % 9 AS requests, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)"""

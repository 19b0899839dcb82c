"""Queries over nested reports: deltas of their leaves and rates between snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearmask.operators import reports as N
from yearmask.plans import derived as D
from yearmask.plans.registry import query

_REPORTS = """
WITH e AS (SELECT event_id AS id, concat('src', user_id % 50) AS source, ts, event_type AS kind, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
r AS (
  SELECT source, id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, row_number() OVER (PARTITION BY source ORDER BY id) - 1 AS number,
         json_object('eed', id * 0.25, 'counters', json_object('requests', id % 700, 'claimed', id // 2, 'passed', id // 5, 'throttled', id // 11, 'errors', id // 13),
                     'kinds', json_object(kind, json_object('k', k, 'half', k / 2)), 'steps', json_array(k % 4, json_object('deep', json_array(k % 3))), 'ok', k > 50, 'note', kind, 'text', CAST(k % 5 AS VARCHAR)) AS body FROM e),
v AS (SELECT source, number, replace(replace(substr(fullkey, 3), '[', '.'), ']', '') AS path, TRY_CAST(trim(atom, '"') AS DOUBLE) AS value FROM r, json_tree(r.body) t WHERE t.type NOT IN ('OBJECT', 'ARRAY', 'BOOLEAN', 'NULL') AND TRY_CAST(trim(atom, '"') AS DOUBLE) IS NOT NULL),
d AS (
  SELECT source, number, path, coalesce(a.value, 0) AS now, coalesce(b.value, 0) AS before, a.value IS NOT NULL AND b.value IS NOT NULL AS in_both
  FROM v a FULL OUTER JOIN (SELECT source, number + 1 AS number, path, value FROM v) b USING (source, number, path) WHERE number > 0 AND (source, number) IN (SELECT source, number FROM r)) """


def reports(spark: SparkSession, sf: str) -> DataFrame:
    """A nested report of its source for each event, but the first: (source, number, elapsed, steps) since the one before."""
    e, i = D.table(spark, sf, "events"), F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    body = F.struct(
        (i * 0.25).alias("eed"),
        F.struct((i % 700).alias("requests"), F.floor(i / 2).alias("claimed"), F.floor(i / 5).alias("passed"), F.floor(i / 11).alias("throttled"), F.floor(i / 13).alias("errors")).alias("counters"),
        F.create_map("event_type", F.struct(k.alias("k"), (k / 2).alias("half"))).alias("kinds"),
    )
    steps = F.concat(F.lit("["), k % 4, F.lit(',{"deep":['), k % 3, F.lit("]}]"))
    json = F.concat(F.rtrim(F.to_json(body), F.lit("}")), F.lit('}},"steps":'), steps, F.lit(',"ok":'), k > 50, F.lit(',"note":"'), F.col("event_type"), F.lit('","text":"'), (k % 5), F.lit('"}'))
    rows = e.select(F.concat(F.lit("src"), F.col("user_id") % 50).alias("source"), i.alias("id"), F.unix_timestamp("ts").alias("seconds"), json.alias("json"))
    pairs = N.in_pairs(rows, "source", "id").where("number > 0")
    return N.steps(pairs.select("source", "number", (F.col("seconds") - F.col("before.seconds")).alias("elapsed"), F.col("json").alias("now"), F.col("before.json").alias("before")), "now", "before")


@query("w10_nested_deltas", _REPORTS + "SELECT source, number, path, before, now, now - before AS delta, now < before AS reset FROM d WHERE in_both AND now <> before")
def w10_nested_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """The numbers of nested reports that differ from those of the report before."""
    return N.that_differ(N.step_deltas(reports(spark, sf), "source"))


@query("w9_nested_growth", _REPORTS + "SELECT source, path, sum(now - before) AS growth FROM d WHERE now >= before GROUP BY source, path")
def w9_nested_growth(spark: SparkSession, sf: str) -> DataFrame:
    """How much each nested counter of a source grew in all, resets left out."""
    return N.that_grew(N.step_deltas(reports(spark, sf), "source", missing=True)).groupBy("source", "path").agg(F.sum("delta").alias("growth"))


@query("g34_snapshot_windows", _REPORTS + """
, s AS (SELECT source, number, count(*) FILTER (WHERE path LIKE 'counters.%' AND now < before) AS resets,
  coalesce(sum(now - before) FILTER (WHERE path = 'counters.requests' AND now >= before), 0) AS requests, coalesce(sum(now - before) FILTER (WHERE path = 'counters.claimed' AND now >= before), 0) AS claimed,
  coalesce(sum(now - before) FILTER (WHERE path = 'counters.passed' AND now >= before), 0) AS passed, coalesce(sum(now - before) FILTER (WHERE path = 'counters.throttled' AND now >= before), 0) AS throttled, coalesce(sum(now - before) FILTER (WHERE path = 'counters.errors' AND now >= before), 0) AS errors FROM d GROUP BY source, number),
w AS (SELECT s.*, CAST(b.seconds - a.seconds AS BIGINT) AS elapsed, (b.id - a.id) * 0.25 AS gained, resets = 0 AND b.seconds > a.seconds AS valid FROM s JOIN r b USING (source, number) JOIN r a ON a.source = b.source AND a.number = b.number - 1)
SELECT source, number, elapsed, valid, resets, requests, CASE WHEN valid THEN gained * 3600 / elapsed END AS eed_per_hour, CASE WHEN valid THEN gained * 3600 / elapsed * 24 END AS eed_per_day, CASE WHEN valid AND requests > 0 THEN gained * 1000 / requests END AS eed_per_1000_requests,
 CASE WHEN claimed > 0 THEN passed / claimed END AS pass_fraction, CASE WHEN requests > 0 THEN throttled / requests END AS throttle_fraction, CASE WHEN requests > 0 THEN errors / requests END AS error_fraction FROM w""")
def g34_snapshot_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Rates and fractions of the window between each snapshot of a source and the one before."""
    return N.step_windows(reports(spark, sf), "source", F.col("elapsed"))

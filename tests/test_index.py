"""The baseline index: written once, probed without a shuffle of its side, looked up by bucket."""

import pytest
from pyspark.sql import functions as F

from yearmask.operators import evidence as V
from yearmask.sources.index import BaselineIndex, input_digest


@pytest.fixture
def parts(spark):
    years = spark.range(4000).select(F.concat(F.lit("h"), F.col("id") % 1500, F.lit(".org")).alias("host"), (F.col("id") % 8 + 1995).cast("int").alias("year"))
    candidates = spark.range(1000, 2500).select(F.concat(F.lit("h"), "id", F.lit(".org")).alias("host"))
    hosts = spark.range(500, 3000).select(F.concat(F.lit("h"), "id", F.lit(".org")).alias("host"))
    return years.unionByName(years.limit(3).withColumn("host", F.lit(None).cast("string"))), candidates, hosts


def plan_of(df, mode="simple"):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_index_equals_plain_joins(spark, parts, tmp_path):
    years, candidates, hosts = parts
    index = BaselineIndex.named(spark, "abc", f"file://{tmp_path}", buckets=6).build(years, candidates)
    got = index.resolve(hosts)
    want = V.resolve(hosts, V.mask_by_host(years), candidates)
    assert sorted(map(tuple, got.select("host", "baseline_mask", "is_candidate").collect())) == sorted(map(tuple, want.select("host", "baseline_mask", "is_candidate").collect()))
    assert index.rows().count() == index.rows().select("host").distinct().count() == 2500


def test_the_index_side_has_no_exchange(spark, parts, tmp_path):
    years, candidates, hosts = parts
    index = BaselineIndex.named(spark, "plan", f"file://{tmp_path}", buckets=6).build(years, candidates)
    plan = plan_of(index.resolve(hosts))
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastExchange" not in plan and "ShuffledHashJoin" in plan and "Sort " not in plan
    side = plan[plan.index("ShuffledHashJoin") :]
    scan = side.index("Bucketed: true")
    assert "Exchange" not in side[scan : scan + 300]


def test_built_once_and_attached(spark, parts, tmp_path):
    years, candidates, hosts = parts
    index = BaselineIndex.named(spark, "once", f"file://{tmp_path}", buckets=3)
    assert not index.written()
    index.build(years, candidates)
    first = sorted(p.name for p in (tmp_path / "index" / index.table).iterdir())
    index.build(years.limit(0), candidates.limit(0))
    assert sorted(p.name for p in (tmp_path / "index" / index.table).iterdir()) == first
    spark.sql(f"DROP TABLE {index.table}")  # another session's catalogue doesn't know it
    again = BaselineIndex.named(spark, "once", f"file://{tmp_path}", buckets=3)
    assert again.written() and again.resolve(hosts).where("baseline_mask > 0").count() > 0
    assert "EqualTo(host,h7.org)" in plan_of(again.lookup("h7.org"), "formatted")
    assert [tuple(r) for r in again.lookup("h2000.org", "none.org").collect()] == [("h2000.org", 0, True)]


def test_empty_input(spark, tmp_path):
    none = spark.createDataFrame([], "host string, year int")
    index = BaselineIndex.named(spark, "empty", f"file://{tmp_path}", buckets=2).build(none, none)
    assert [tuple(r) for r in index.resolve(spark.createDataFrame([("a",), (None,)], "host string")).collect() if r["host"]] == [("a", 0, False)]


def test_digest(spark, tmp_path):
    (tmp_path / "a").write_text("x")
    one = input_digest(spark, f"file://{tmp_path}/a")
    assert one == input_digest(spark, f"file://{tmp_path}/a")
    (tmp_path / "a").write_text("xy")
    assert one != input_digest(spark, f"file://{tmp_path}/a")

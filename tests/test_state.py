"""Streams with state: suppressions that expire, restarts, and sinks that stay small."""

import datetime as dt

from pyspark.sql import functions as F

from yearmask.plans import streams
from yearmask.streaming import evidence as T

EVENT = "scope string, key string, set_at timestamp, expires_at timestamp, reason string"


def at(hour, day=1):
    return dt.datetime(2024, 1, day, hour)


def put(spark, folder, n, rows):
    spark.createDataFrame(rows, EVENT).coalesce(1).write.parquet(f"{folder}/in/{n}")


def states(spark, folder):
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")
    return {(r["scope"], r["key"]): (r["live"], r["reason"]) for r in T.suppression_states(stream, f"{folder}/work", "1 hour").collect()}


def test_suppressions_expire(spark, tmp_path):
    folder = f"file://{tmp_path}"
    put(spark, folder, 1, [("SOURCE", "a", at(1), at(4), "x"), ("SOURCE", "b", at(1), at(20), "x"), ("ORIGIN", "a", at(1), None, "x"), ("SOURCE", "a", at(0), at(23), "older")])
    assert states(spark, folder) == {("SOURCE", "a"): (True, "x"), ("SOURCE", "b"): (True, "x"), ("ORIGIN", "a"): (True, "x")}
    # another key's rows move the clock; a's ends without a row of its own, after a restart from the checkpoint
    put(spark, folder, 2, [("FAMILY", "f", at(9), at(11), "y")])
    assert states(spark, folder) == {("SOURCE", "a"): (False, "x"), ("SOURCE", "b"): (True, "x"), ("ORIGIN", "a"): (True, "x"), ("FAMILY", "f"): (True, "y")}
    # a newer one replaces: b now ends sooner, and a begins again
    put(spark, folder, 3, [("SOURCE", "b", at(10), at(12), "sooner"), ("SOURCE", "a", at(10), at(22), "again")])
    put(spark, folder, 4, [("SOURCE", "c", at(14), at(15), "z")])
    assert states(spark, folder) == {("SOURCE", "a"): (True, "again"), ("SOURCE", "b"): (False, "sooner"), ("ORIGIN", "a"): (True, "x"), ("FAMILY", "f"): (False, "y"), ("SOURCE", "c"): (True, "z")}
    assert states(spark, folder)[("SOURCE", "c")] == (True, "z")  # nothing new: nothing changes


def test_batches_keep_to_their_ranges(spark, tmp_path):
    """However many parts the rows of a range come in, and with ranges of few rows, too."""
    for n, parts in ((900, 7), (5, 12)):
        ranges = []
        stream = streams.in_batches(spark, spark.range(0, n, 1, parts).withColumnRenamed("id", "seq"), "seq")
        T.drain(stream, f"file://{tmp_path}/{n}", lambda b, _, r=ranges: r.append(sorted(x["seq"] for x in b.collect())))
        assert sum(ranges, []) == list(range(n)) and len(ranges) == 3


def test_first_terminal_event_in_any_batch(spark, tmp_path):
    folder, schema = f"file://{tmp_path}", "host string, seq long, status string"
    batches = [[("a", 5, "REJECTED"), ("b", 1, "ACTIVE"), ("c", 2, "VERIFIED")], [("a", 3, "VERIFIED"), ("a", 2, "ACTIVE"), ("c", 4, "REJECTED")], [("a", 4, "REJECTED"), ("b", 9, "REJECTED")]]
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/in/{n}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")
    found = {tuple(r) for r in T.keep(T.candidate_status(stream), f"{folder}/work", ["host"]).collect()}
    assert found == {("a", "VERIFIED"), ("b", "REJECTED"), ("c", "VERIFIED")}


def test_statuses_are_held_by_an_aggregate(spark, tmp_path):
    """No host calls Python, and a stream gives what a table does, also where a status or a number is missing."""
    folder, schema = f"file://{tmp_path}", "host string, seq long, status string"
    batches = [[("a", 2, None), ("b", 4, "REJECTED"), ("c", None, "VERIFIED")], [("a", 3, "REJECTED"), ("b", 1, None), ("d", 5, None)]]
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/in/{n}")
    stream = T.candidate_status(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*"))
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "Pandas" not in plan and "Python" not in plan
    found = {tuple(r) for r in T.keep(stream, f"{folder}/work", ["host"]).collect()}
    table = T.candidate_status_batch(spark.createDataFrame(sum(batches, []), schema)).collect()
    assert found == {tuple(r) for r in table} == {("a", "REJECTED"), ("b", "REJECTED"), ("c", "ACTIVE"), ("d", "ACTIVE")}


def test_captures_of_the_status_stream_are_made_once(spark, sf, monkeypatch):
    plans, deal = [], streams.in_batches

    def seen(spark, rows, order):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return deal(spark, rows, order)

    monkeypatch.setattr(streams, "in_batches", seen)
    assert streams.t5_status_stream(spark, sf).count() == streams.t5_candidate_status(spark, sf).count()
    assert len(plans) == 1 and "Join" not in plans[0] and "regexp" not in plans[0]


def test_sinks_are_compacted(spark, tmp_path):
    folder = f"file://{tmp_path}"
    schema = spark.createDataFrame([], "name string, value long, ts long, id long").schema
    want = {}
    for n in range(21):
        spark.createDataFrame([(f"k{n % 4}", n, n, n)], schema).coalesce(1).write.parquet(f"{folder}/in/{n:03}")
        want[f"k{n % 4}"] = (want.get(f"k{n % 4}", (0, 0))[0] + n, n)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")
    got = {r["name"]: (r["total"], r["last"]) for r in T.running_counters(stream, f"{folder}/work").collect()}
    assert got == want
    left = sorted(p.name for p in (tmp_path / "work/states").iterdir() if not p.name.startswith("."))
    assert left == ["batch=20"]
    (tmp_path / "work/states/batch=20").rename(tmp_path / "work/states/compact-20")  # cut off before the last step
    T.compact(spark, f"{folder}/work/states", T.keep.__globals__["StructType"](), ["name"])
    assert [p.name for p in (tmp_path / "work/states").iterdir() if not p.name.startswith(".")] == ["batch=20"]


def test_the_last_of_equal_times(spark, tmp_path):
    rows = [("k", v, 5, i) for i, v in ((3, 30), (9, 90), (1, 10))]
    spark.createDataFrame(rows, "name string, value long, ts long, id long").write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema("name string, value long, ts long, id long").parquet(f"file://{tmp_path}/in")
    assert T.running_counters(stream, f"file://{tmp_path}/work").first()["last"] == 90


def test_state_store_is_set_for_the_stream_alone(spark):
    before = spark.conf.get(T.STORE[0])
    spark.conf.set(T.STORE[0], "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    with T.state_on_disk(spark):
        assert "RocksDB" in spark.conf.get(T.STORE[0])
    assert "HDFS" in spark.conf.get(T.STORE[0])
    spark.conf.set(T.STORE[0], before)
    assert spark.range(1).select(F.lit(T.FOREVER)).first()[0] == 1 << 62

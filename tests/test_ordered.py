"""Lags, numbers and sums by ranges of the order, against plain loops."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from yearmask.operators import ordered as O
from yearmask.operators import value as A

SCHEMA = "k string, o long, i long, v long"


def plain(rows):
    last, total, place, out = {}, {}, {}, {}
    for k, o, i, v in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        total[k], place[k] = total.get(k, 0) + (v or 0), place.get(k, -1) + 1
        out[i] = (last.get(k), total[k], place[k])
        last[k] = v
    return out


@pytest.mark.parametrize("parts", [1, 2, 7, 64])
def test_against_loops(spark, parts):
    rng = random.Random(parts)
    # one key with two thirds of the rows, a null key, ties and nulls of the order, null values, one row of its own
    rows = [(rng.choice(["hot", "hot", "hot", "hot", "a", None]), rng.choice([None, *range(25)]), i, rng.choice([None, 1, 2, 3])) for i in range(400)] + [("alone", 3, 400, 5)]
    frame = O.in_blocks(spark.createDataFrame(rows, SCHEMA).repartition(5), F.col("o"), parts)
    for f, at in ((lambda: O.previous(frame, "k", ["o", "i"], "v", "x"), 0), (lambda: O.running_sum(frame, "k", ["o", "i"], "v", "x"), 1), (lambda: O.numbered(frame, "k", ["o", "i"], "x"), 2)):
        got = f().collect()
        assert len(got) == len(rows) and {r.i: r.x for r in got} == {i: t[at] for i, t in plain(rows).items()}


def test_a_hot_key_is_split(spark):
    frame = O.in_blocks(spark.range(10_000).select(F.lit("hot").alias("k"), F.col("id").alias("o")), F.col("o"), 32)
    sizes = [r["count"] for r in frame.groupBy("k", O.BLOCK).count().collect()]
    assert len(sizes) == 32 and max(sizes) < 400


def test_empty_tables(spark):
    none = O.in_blocks(spark.createDataFrame([], SCHEMA), F.col("o"))
    assert O.numbered(none, "k", ["o"], "x").count() == O.previous(none, "k", ["o"], "v", "x").count() == O.running_sum(none, "k", ["o"], "v", "x").count() == 0


def test_times(spark):
    times = [datetime.datetime(2024, 3, 31, 1, 59, 59), datetime.datetime(2024, 3, 31, 2, 30), datetime.datetime(2024, 3, 31, 3, 0), datetime.datetime(2025, 1, 1)]
    frame = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    got = [r.s for r in frame.select("t", O.seconds("t").alias("s")).orderBy("t").collect()]
    assert [b - a for a, b in zip(got, got[1:])] == [(b - a).total_seconds() for a, b in zip(times, times[1:])]


def test_deltas_keep_resets(spark):
    rows = [("c", 1, 5), ("c", 2, 9), ("c", 3, 2), ("d", 1, 7)]
    got = A.deltas(spark.createDataFrame(rows, "name string, at int, value int"), "name", "at", "value").collect()
    assert {(r.name, r.at): (r.delta, r.reset) for r in got} == {("c", 1): (None, None), ("c", 2): (4, False), ("c", 3): (-7, True), ("d", 1): (None, None)}

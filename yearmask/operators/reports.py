"""Nested reports: their leaves, what changed from one to the next, and rates of the window between two snapshots.

Reports that come as JSON are paired with the one before as they are ordered (``in_pairs``) and opened side by side within
their row (``steps``): what moves is a row a report. Where the numbers lie in rows of their own already (``leaves``,
``numbers``), reports meet by their paths (``deltas``).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from yearmask.operators.graph import stored
from yearmask.operators.ordered import in_blocks, numbered, numbered_with_before


def leaves(reports: DataFrame, keys: list[str], body: str) -> DataFrame:
    """(keys, path, leaf): the leaves of nested documents (a variant column), however deep. A path is the names and
    places, from 0, that lead to a leaf, with dots between them; a document that is a leaf itself has none and is left out.

    A round opens one level of all documents at once, a row for each name or place; there are as many rounds as levels.
    """
    spark = reports.sparkSession
    now = reports.select(*keys, F.lit("").alias("path"), F.col(body).alias("v"))
    out: DataFrame | None = None
    while True:
        inside = now.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).withColumnRenamed("key", "__key")
        step = F.concat(F.when(F.col("path") == "", "").otherwise(F.concat("path", F.lit("."))), F.coalesce("__key", F.col("pos").cast("string")))
        opened = stored(inside.select(*keys, step.alias("path"), F.col("value").alias("v"), F.schema_of_variant("value").alias("__kind")), "leaves")
        nested = F.col("__kind").startswith("OBJECT") | F.col("__kind").startswith("ARRAY")
        found = opened.where(~nested).select(*keys, "path", F.col("v").alias("leaf"))
        out = found if out is None else out.unionByName(found)
        now = opened.where(nested).select(*keys, "path", "v")
        if now.isEmpty():
            return out


def numbers(found: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, path, value): the leaves that are numbers, or texts of numbers; truth values and nulls are none."""
    kind = F.schema_of_variant("leaf")
    value = F.when(~kind.isin("BOOLEAN", "VOID"), F.try_variant_get("leaf", "$", "double"))
    return found.select(*keys, "path", value.alias("value")).where("value is not null")


def in_order(reports: DataFrame, source: str, order: str) -> DataFrame:
    """reports with ``number``, the place of each in its source, from 0; a source with most reports is split."""
    return numbered(in_blocks(reports, F.col(order)), source, [order], "number").drop("__block")


def deltas(values: DataFrame, reports: DataFrame, source: str, missing: bool = False) -> DataFrame:
    """(source, number, path, before, now, delta, reset) of the numbers of each report and the one before it.
    values: (source, number, path, value); reports: (source, number) of all reports, those without numbers too.

    Numbers that both reports have, or with ``missing`` either (the other counts as 0). ``reset`` says that a number fell.
    Paths meet in an equi-join, so a source with very many reports is no single task. First reports have no row.
    """
    now = values.select(source, "number", "path", F.col("value").alias("now"))
    before = values.select(source, (F.col("number") + 1).alias("number"), "path", F.col("value").alias("before"))
    later = reports.where("number > 0").select(source, "number")
    # all of these grow with the reports, and packed files or shuffles of them look small: none may be broadcast
    both = now.join(before.hint("merge"), [source, "number", "path"], "full_outer" if missing else "inner").join(later.hint("merge"), [source, "number"], "left_semi")
    both = both.withColumns({"now": F.coalesce("now", F.lit(0.0)), "before": F.coalesce("before", F.lit(0.0))})
    return both.select(source, "number", "path", "before", "now", (F.col("now") - F.col("before")).alias("delta"), (F.col("now") < F.col("before")).alias("reset"))


#: what a text of a number looks like, as casts to double take it: decimal and hexadecimal, and names in any case
DECIMAL = re.compile(r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[dDfF]?")
HEXADECIMAL = re.compile(r"[+-]?0[xX](?:[0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+[dDfF]?")
NAMED = re.compile(r"nan|[+-]?inf(?:inity)?", re.IGNORECASE)
BLANKS = "".join(map(chr, range(33)))


def text_number(text: str) -> float | None:
    """The number that a text is, None if it is none."""
    text = text.strip(BLANKS)
    if DECIMAL.fullmatch(text):
        return float(text.rstrip("dDfF"))
    if NAMED.fullmatch(text):
        return float(text)
    if HEXADECIMAL.fullmatch(text):
        try:
            return float.fromhex(text.rstrip("dDfF"))
        except OverflowError:
            return float("-inf" if text[0] == "-" else "inf")
    return float("nan") if text in ("+NaN", "-NaN") else None


def no_number(name: str) -> float:
    raise ValueError(f"JSON has no {name}")


def opened(report: str | None) -> dict[str, list[float]]:
    """The numbers of a JSON document by their paths, as ``leaves`` and ``numbers`` have them; names with dots in them can
    make one path of several."""
    found: dict[str, list[float]] = {}
    left = [] if report is None else [(None, json.loads(report, parse_int=float, parse_constant=no_number))]
    for path, value in left:
        kind = type(value)
        if kind is dict:
            left.extend((f"{path}.{k}" if path else k, v) for k, v in value.items())
        elif kind is list:
            left.extend((f"{path}.{k}" if path else str(k), v) for k, v in enumerate(value))
        elif path is not None and (number := value if kind is float else text_number(value) if kind is str else None) is not None:
            found.setdefault(path, []).append(number)
    return found


NONE = [None]


def in_pairs(reports: DataFrame, source: str, order: str) -> DataFrame:
    """reports with ``number`` as ``in_order`` has it and ``before``, a struct of the columns of the report before."""
    return numbered_with_before(in_blocks(reports, F.col(order)), source, [order], "number", "before").drop("__block")


def steps(pairs: DataFrame, now: str, before: str) -> DataFrame:
    """pairs with ``steps`` (path, before, now) in place of two JSON documents of which one follows the other: a step for
    each number of either, null in the one that lacks it."""
    keep = [c for c in pairs.columns if c not in (now, before)]
    step = StructType([StructField("path", StringType()), StructField("before", DoubleType()), StructField("now", DoubleType())])

    def side_by_side(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, numbers = None, {}  # the last report opened, which mostly is the one before the next
        for batch in batches:
            ends, paths, old, new = [0], [], [], []
            for a, b in zip(batch.column(before).to_pylist(), batch.column(now).to_pylist(), strict=True):
                earlier = numbers if a == text else opened(a)
                text, numbers = b, opened(b)
                for path in earlier | numbers:
                    for x in earlier.get(path, NONE):
                        for y in numbers.get(path, NONE):
                            paths.append(path)
                            old.append(x)
                            new.append(y)
                ends.append(len(paths))
            rows = pa.StructArray.from_arrays([pa.array(paths, "string"), pa.array(old, "double"), pa.array(new, "double")], ["path", "before", "now"])
            found = pa.ListArray.from_arrays(pa.array(np.array(ends, "int32")), rows)
            yield pa.RecordBatch.from_arrays([*map(batch.column, keep), found], [*keep, "steps"])

    return pairs.mapInArrow(side_by_side, StructType([*[pairs.schema[c] for c in keep], StructField("steps", ArrayType(step))]))


def step_deltas(stepped: DataFrame, source: str, missing: bool = False) -> DataFrame:
    """``deltas`` of reports opened side by side (source, number, steps)."""
    each = stepped.select(source, "number", F.inline("steps"))
    both = each.withColumns({"now": F.coalesce("now", F.lit(0.0)), "before": F.coalesce("before", F.lit(0.0))}) if missing else each.where("before is not null and now is not null")
    return both.select(source, "number", "path", "before", "now", (F.col("now") - F.col("before")).alias("delta"), (F.col("now") < F.col("before")).alias("reset"))


def that_differ(deltas: DataFrame) -> DataFrame:
    return deltas.where("now <> before")


def that_grew(deltas: DataFrame) -> DataFrame:
    return deltas.where("not reset").drop("reset")


def changed(values: DataFrame, reports: DataFrame, source: str) -> DataFrame:
    """The numbers that both reports have and that differ."""
    return that_differ(deltas(values, reports, source))


def growth(values: DataFrame, reports: DataFrame, source: str) -> DataFrame:
    """How much each counter grew; what a report lacks counts as 0, and what fell is left out."""
    return that_grew(deltas(values, reports, source, missing=True))


def share(part: Column, whole: Column) -> Column:
    """A share, null without a whole."""
    return F.when(whole > 0, part / whole)


#: what a report counts
COUNTERS = ("requests", "claimed", "passed", "throttled", "errors")


def validation_windows(values: DataFrame, reports: DataFrame, source: str, seconds: str, eed: str = "eed", counters: str = "counters.") -> DataFrame:
    """A row for each report but the first of a source: what happened since the snapshot before it.

    reports: (source, number and a time in seconds); values: their numbers. Counters lie under ``counters`` (requests,
    claimed, passed, throttled, errors); ``eed`` is the level that grows. Rates of EED (an hour, a day, per 1,000 requests)
    are null where the window isn't valid: a counter was reset, the clock didn't move, or a snapshot lacks ``eed``.
    Fractions are of the counters' growth and null without a whole.
    """
    every = deltas(values, reports, source, missing=True)
    counter = F.col("path").startswith(counters)

    def grew(name: str) -> Column:
        return F.coalesce(F.sum(F.when((F.col("path") == counters + name) & ~F.col("reset"), F.col("delta"))), F.lit(0.0)).alias(name)

    sums = every.groupBy(source, "number").agg(*[grew(n) for n in COUNTERS], F.count_if(counter & F.col("reset")).alias("resets"))
    level = values.where(F.col("path") == eed)
    ends = reports.select(source, "number", F.col(seconds).alias("__end")).join(level.select(source, "number", F.col("value").alias("__eed")).hint("merge"), [source, "number"], "left")
    starts = ends.select(source, (F.col("number") + 1).alias("number"), F.col("__end").alias("__start"), F.col("__eed").alias("__from"))
    rows = ends.join(starts.hint("merge"), [source, "number"]).join(sums.hint("merge"), [source, "number"], "left").na.fill(0, [*COUNTERS, "resets"])
    return rates(rows, source, F.col("__end") - F.col("__start"), F.col("__eed") - F.col("__from"))


def step_windows(stepped: DataFrame, source: str, elapsed: Column, eed: str = "eed", counters: str = "counters.") -> DataFrame:
    """``validation_windows`` of reports opened side by side (source, number, steps, and what tells the time ``elapsed``),
    each within its row."""
    now, before = (lambda s: F.coalesce(s["now"], F.lit(0.0))), (lambda s: F.coalesce(s["before"], F.lit(0.0)))

    def grew(name: str) -> Column:
        mine = F.filter("__counters", lambda s: (s["path"] == counters + name) & (now(s) >= before(s)))
        return F.aggregate(mine, F.lit(0.0), lambda sum_, s: sum_ + (now(s) - before(s))).alias(name)

    level = F.filter("steps", lambda s: s["path"] == eed)
    resets = F.size(F.filter("__counters", lambda s: now(s) < before(s))).cast("long").alias("resets")
    held = stepped.select(source, "number", elapsed.alias("__elapsed"), F.get(level, F.lit(0)).alias("__eed"), F.filter("steps", lambda s: s["path"].startswith(counters)).alias("__counters"))
    rows = held.select(source, "number", "__elapsed", (F.col("__eed.now") - F.col("__eed.before")).alias("__gained"), *map(grew, COUNTERS), resets)
    return rates(rows, source, F.col("__elapsed"), F.col("__gained"))


def rates(rows: DataFrame, source: str, elapsed: Column, gained: Column) -> DataFrame:
    """The columns of ``validation_windows`` from what the counters grew, how often one fell, the time and the gain."""
    valid = (F.col("resets") == 0) & (elapsed > 0) & gained.isNotNull()
    hour = F.when(valid, gained * 3600 / elapsed)
    return rows.select(
        source, "number", elapsed.alias("elapsed"), valid.alias("valid"), "resets", "requests", hour.alias("eed_per_hour"), (hour * 24).alias("eed_per_day"), F.when(valid, share(gained * 1000, F.col("requests"))).alias("eed_per_1000_requests"),
        share(F.col("passed"), F.col("claimed")).alias("pass_fraction"), share(F.col("throttled"), F.col("requests")).alias("throttle_fraction"), share(F.col("errors"), F.col("requests")).alias("error_fraction"),
    )

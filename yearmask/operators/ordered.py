"""Order within a key for keys of any size: lags, numbers and running sums that never sort a whole key in one task.

Rows are dealt into ranges of the order first (``in_blocks``). A window then sees one range of one key, and what earlier
ranges hand on (a last row, a count, a sum) is one small row for each key and range. Rows of equal order share a range, so
further order columns decide between them there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearmask.operators.graph import stored

BLOCK = "__block"
#: more ranges than this make the expression that finds one long
MOST_BLOCKS = 1024


def place(value: Column, cuts: list, base: int = 0) -> Column:
    """How many of the ascending cuts are at or below a value, by halving."""
    if not cuts:
        return F.lit(base)
    middle = len(cuts) // 2
    return F.when(value < cuts[middle], place(value, cuts[:middle], base)).otherwise(place(value, cuts[middle + 1 :], base + middle + 1))


def seconds(time: str) -> Column:
    """A number that grows with a time as it is written, whatever the session's time zone and its leaps."""
    return ((F.unix_date(F.to_date(time)) * F.lit(24).cast("long") + F.hour(time)) * 60 + F.minute(time)) * 60 + F.second(time)


def in_blocks(rows: DataFrame, order: Column, parts: int | None = None) -> DataFrame:
    """rows with the range (``__block``) of a number that they are ordered by; nulls come first. The cuts are approximate
    quantiles over all rows, as many as there are shuffle partitions; where they lie changes no result."""
    parts = min(MOST_BLOCKS, parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = rows.agg(F.percentile_approx(order, [i / parts for i in range(1, parts)])).first()[0] if parts > 1 else None
    return rows.withColumn(BLOCK, F.when(order.isNull(), 0).otherwise(place(order, sorted(set(found or [])))))


def handed_on(rows: DataFrame, key: str, what: Column, over: str) -> DataFrame:
    """What each range of each key gets from the ranges before it: the ``last`` or the ``sum`` of their own ``what``."""
    own = rows.groupBy(key, BLOCK).agg(what.alias("own"))
    w = Window.partitionBy(key).orderBy(BLOCK)
    before = F.lag("own").over(w) if over == "last" else F.coalesce(F.sum("own").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return own.select(F.col(key).alias("__key"), F.col(BLOCK).alias("__at"), before.alias("__before"))


def with_before(rows: DataFrame, key: str, before: DataFrame) -> DataFrame:
    return rows.join(before, F.col(key).eqNullSafe(F.col("__key")) & (F.col(BLOCK) == F.col("__at")), "left").drop("__key", "__at")


def within(key: str, order: list[str]) -> Window:
    return Window.partitionBy(key, BLOCK).orderBy(*order)


def previous(rows: DataFrame, key: str, order: list[str], value: str, name: str) -> DataFrame:
    """The value of the row before, of the same key; null for a key's first row."""
    before = handed_on(rows, key, F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)), "last")
    near = rows.withColumn("__lag", F.lag(F.struct(F.col(value).alias("v"))).over(within(key, order)))
    return with_before(near, key, before).withColumn(name, F.coalesce("__lag", "__before")["v"]).drop("__lag", "__before")


def running_sum(rows: DataFrame, key: str, order: list[str], value: str, name: str) -> DataFrame:
    """The sum of a key's values up to and with each row."""
    before = handed_on(rows, key, F.sum(value), "sum")
    near = rows.withColumn("__own", F.sum(value).over(within(key, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return with_before(near, key, before).withColumn(name, F.coalesce("__own", F.lit(0)) + F.coalesce("__before", F.lit(0))).drop("__own", "__before")


def numbered(rows: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """The place of each row within its key, from 0."""
    before = handed_on(rows, key, F.count("*"), "sum")
    near = rows.withColumn("__own", F.row_number().over(within(key, order)))
    return with_before(near, key, before).withColumn(name, F.col("__own") + F.col("__before") - 1).drop("__own", "__before")


def numbered_with_before(rows: DataFrame, key: str, order: list[str], number: str, name: str) -> DataFrame:
    """The place of each row within its key, from 0, and the row before it (a struct of the columns of ``rows``; null for a
    key's first row), by one window. What ranges hand on is written first, so that its size is known where it is joined."""
    plain = F.struct(*[c for c in rows.columns if c not in (key, BLOCK)])
    own = rows.groupBy(key, BLOCK).agg(F.count("*").alias("n"), F.max_by(plain, F.struct(*order)).alias("last"))
    w = Window.partitionBy(key).orderBy(BLOCK)
    handed = own.select(F.col(key).alias("__key"), F.col(BLOCK).alias("__at"), F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__n"), F.lag("last").over(w).alias("__last"))
    near = rows.withColumns({"__own": F.row_number().over(within(key, order)), "__lag": F.lag(plain).over(within(key, order))})
    joined = with_before(near, key, stored(handed, "handed"))
    return joined.withColumns({number: F.col("__own") + F.col("__n") - 1, name: F.coalesce("__lag", "__last")}).drop("__own", "__lag", "__n", "__last")

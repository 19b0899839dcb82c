"""MinHash sketches, their union, and overlap estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 64


#: a prime below 2 ** 56: sums of 64 multiples stay inside a bigint
PRIME = (1 << 56) - 5


def halves(value: Column) -> tuple[Column, Column]:
    """Two 56-bit numbers of a value's md5, which other engines have too."""
    return tuple(F.conv(F.substring(F.md5(value), at, 14), 16, 10).cast("bigint") for at in (1, 15))


def minhash(rows: DataFrame, group: str, value: str, width: int = WIDTH) -> DataFrame:
    """M1: (group, seed, minimum). A value is hashed once, to two numbers a and b; hash i of it is (a + i b) mod PRIME, so 64
    seeds cost 64 additions and no text work. The minima are aggregates of one pass: a row a group and task is shuffled,
    never the values times the seeds."""
    a, b = halves(F.col(value).cast("string"))
    numbers = rows.where(F.col(value).isNotNull()).select(group, a.alias("__a"), b.alias("__b"))
    minima = numbers.groupBy(group).agg(*[F.min((F.col("__a") + F.col("__b") * i) % F.lit(PRIME)).alias(f"m{i}") for i in range(width)])
    return minima.select(group, F.posexplode(F.array(*[f"m{i}" for i in range(width)])).alias("seed", "minimum"))


def union(sketch: DataFrame, group: str) -> DataFrame:
    """M2: the sketch of the union of all groups that ``group`` names alike."""
    return sketch.groupBy(group, "seed").agg(F.min("minimum").alias("minimum"))


def similarity(sketch: DataFrame, group: str, width: int = WIDTH) -> DataFrame:
    """M3: pairs of groups with any equal minimum and their Jaccard estimate, by an equi-join on (seed, minimum)."""
    a, b = sketch.alias("a"), sketch.alias("b")
    pairs = a.join(b, (F.col("a.seed") == F.col("b.seed")) & (F.col("a.minimum") == F.col("b.minimum")) & (F.col(f"a.{group}") < F.col(f"b.{group}")))
    return pairs.groupBy(F.col(f"a.{group}").alias("left"), F.col(f"b.{group}").alias("right")).agg((F.count("*") / F.lit(width)).alias("jaccard"))


#: minima of a band: two groups of a Jaccard estimate of 0.5 share one of 32 bands of 2 with a chance of 0.9999
BAND = 2


def sketch_classes(sketch: DataFrame, group: str) -> DataFrame:
    """(group, minima, class): the minima of each group in the order of the seeds, and a group that stands for all with the
    same minima. Copies of a set are one class, so that they aren't compared with one another."""
    whole = sketch.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("seed", "minimum"))), lambda x: x.minimum).alias("minima"))
    first = whole.groupBy("minima").agg(F.min(group).alias("class"))
    return whole.join(first, "minima")


def estimate(a: Column, b: Column) -> Column:
    """The share of equal minima of two sketches, of the width of the narrower."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))
    return equal / F.least(F.size(a), F.size(b))


def bands(classes: DataFrame, size: int = BAND) -> DataFrame:
    """(band, key, class, minima): a row for each band of each class."""
    one = classes.where(F.col("__group") == F.col("class"))
    keys = F.transform(F.sequence(F.lit(0), F.floor(F.size("minima") / size).cast("int") - 1), lambda i: F.xxhash64(F.slice("minima", i * size + 1, size)))
    return one.select("class", "minima", F.posexplode(keys).alias("band", "key"))


def similar(sketch: DataFrame, group: str, least: float = 0.5, size: int = BAND) -> tuple[DataFrame, DataFrame]:
    """M3 for very many groups: (left, right, jaccard) of classes whose estimate is ``least`` or more, and (group, class).

    Groups with the same minima are one class of similarity 1, and pairs are between classes. Candidates share a band of
    ``size`` minima, so a minimum that very many groups have makes no pairs by itself; each candidate's whole sketches are
    compared. Pairs of lower similarity, which are most, are never made. Groups without values aren't listed.
    """
    classes = sketch_classes(sketch, group).withColumnRenamed(group, "__group")
    keyed = bands(classes, size)
    a, b = keyed.alias("a"), keyed.select("band", "key", F.col("class").alias("other")).alias("b")
    pairs = a.join(b, ["band", "key"]).where(F.col("class") < F.col("other")).select(F.col("class").alias("left"), F.col("other").alias("right")).distinct()
    one = classes.where(F.col("__group") == F.col("class")).select("class", "minima")
    both = pairs.join(one.select(F.col("class").alias("left"), F.col("minima").alias("x")), "left").join(one.select(F.col("class").alias("right"), F.col("minima").alias("y")), "right")
    found = both.select("left", "right", estimate(F.col("x"), F.col("y")).alias("jaccard")).where(F.col("jaccard") >= least)
    return found, classes.select(F.col("__group").alias(group), "class")


def overlap_penalty(candidates: DataFrame, active: DataFrame, group: str, size: int = BAND) -> DataFrame:
    """M3: (group, penalty): the highest similarity of each candidate to any active group that shares a band of ``size``
    minima with it and has a sketch of the same width, else 0.

    With bands of 1 no similarity is missed, but a minimum that very many groups have joins them all; bands of 2 miss next
    to none of 0.5 or more. Groups of the same minima are compared once.
    """
    asked, known = (sketch_classes(x, group).withColumnRenamed(group, "__group") for x in (candidates, active))
    a = bands(asked, size).select("band", "key", F.col("class").alias("c"))
    b = bands(known, size).select("band", "key", F.col("class").alias("k"))
    pairs = a.join(b, ["band", "key"]).select("c", "k").distinct()
    x, y = (one.where(F.col("__group") == F.col("class")).select(F.col("class").alias(name), F.col("minima").alias(f"m_{name}")) for one, name in ((asked, "c"), (known, "k")))
    met = pairs.join(x, "c").join(y, "k").where(F.size("m_c") == F.size("m_k"))
    highest = met.groupBy(F.col("c").alias("class")).agg(F.max(estimate(F.col("m_c"), F.col("m_k"))).alias("penalty"))
    return asked.join(highest, "class", "left").select(F.col("__group").alias(group), F.coalesce("penalty", F.lit(0.0)).alias("penalty"))


#: bits of a fan-out sketch; its counts can only be too low, by what falls onto a bit that is set
FANOUT_BITS = 63


def fanout(children: DataFrame, keys: list[str], child: str) -> DataFrame:
    """G31 as a sketch: (keys, sketch, children): one bit for each child, by a hash, so that a key of any fan-out is one
    number. Sketches of batches merge; a child that comes again changes nothing."""
    bit = F.conv(F.substring(F.md5(F.col(child)), 1, 15), 16, 10).cast("long") % FANOUT_BITS
    set_bits = F.expr("shiftleft(1L, CAST(__bit AS INT))")
    rows = children.where(F.col(child).isNotNull()).withColumn("__bit", bit).groupBy(*keys).agg(F.bit_or(set_bits).alias("sketch"))
    return rows.withColumn("children", F.bit_count("sketch").cast("long"))


def merged_fanout(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of several batches as one pass over all of them would give."""
    return sketches.groupBy(*keys).agg(F.bit_or("sketch").alias("sketch")).withColumn("children", F.bit_count("sketch").cast("long"))


def distinct_sketch(children: DataFrame, keys: list[str], child: str, lg: int = 12) -> DataFrame:
    """(keys, sketch): an HLL sketch of the distinct children, 2**lg registers: for counts beyond what 63 bits tell, with a
    standard error of about 1.04 / sqrt(2**lg), 1.6 %."""
    return children.groupBy(*keys).agg(F.hll_sketch_agg(child, lg).alias("sketch"))


def merged_distinct(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, sketch, children) of the HLL sketches of several batches."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch")).withColumn("children", F.hll_sketch_estimate("sketch"))


def intersection(left: Column, right: Column, jaccard: Column) -> Column:
    """U8: the size of an intersection from two sizes and a Jaccard estimate, no larger than either."""
    return F.least(left.cast("double"), right.cast("double"), jaccard * (left + right) / (1 + jaccard))


def containment(size: Column, other: Column, jaccard: Column) -> Column:
    """M4: the share of a set that another covers."""
    return F.coalesce(F.least(F.lit(1.0), F.try_divide(intersection(size, other, jaccard), size.cast("double"))), F.lit(0.0))

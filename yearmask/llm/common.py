"""Helpers that several operators share: reading tables, scratch tables, integer-keyed components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: bytes that end a word, by the rule ``[^\x20\x09-\x0D]+`` on text with A-Z lower-cased
LOWER_ASCII = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: A-Z in lower case; what is no digit, letter or byte above 0x7F becomes a space: words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``
WORDS = bytes(LOWER_ASCII[c] if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as there are cores: a few files of one row group would otherwise be as few tasks,
    however dear the work on a row is. Tables with more partitions than cores stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names. Without it, a local session gets a folder of its own, which goes
    with the process; on a cluster that would scatter files over machines, so it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        root = getattr(scratch_root, "own", None)
        if root is None:
            folder = tempfile.TemporaryDirectory(prefix="spark-", dir="/tmp")
            scratch_root.held, root = folder, "file://" + folder.name
            scratch_root.own = root
    return root.rstrip("/")


def materialize(df: DataFrame, what: str) -> tuple[DataFrame, str]:
    """Writes df once as Parquet in the shared folder and reads it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [v or b"" for v in column.cast(pa.large_binary()).to_pylist()]


def each_batch(f: Callable[[pa.RecordBatch], dict], schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function from a function of one batch to columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = f(batch)
                yield pa.RecordBatch.from_arrays([pa.array(out[x.name], x.type) if not isinstance(out[x.name], pa.Array) else out[x.name] for x in schema], schema=schema)

    return run


def word_pieces(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in order (``WORDS``), in lists from about ``size`` bytes of it at a time: however long the text
    is, its words are never all held. No word is cut."""
    at = 0
    while at < len(text):
        end = min(at + size, len(text))
        while end < len(text) and WORDS[text[end]] != 32:
            end += 1
        yield text[at:end].translate(WORDS).split()
        at = end


def row_numbers(n: int, seen: list[int]) -> np.ndarray:
    """Numbers for the next n rows of this task, unique over all tasks and the same when a task runs again."""
    first = (TaskContext.get().partitionId() << 36) + seen[0]
    seen[0] += n
    return np.arange(first, first + n, dtype=np.int64)


def crc_mod(column: str, n: int):
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(n)


#: rows that are broadcast at most, where their number isn't fixed
FEW = 100_000


def broadcast_if_few(rows: DataFrame, most: int = FEW) -> DataFrame:
    """rows, to be broadcast if they are counted to be few; more are joined like any other table."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def numbered(rows: DataFrame, order: list[Column], name: str, within: str | None = None, keep_part: bool = False) -> DataFrame:
    """Adds the place of each row in an order, from 0 without gaps: over the whole table, or for each value of a column
    that is never null. Rows that tie are numbered as they were read.

    No value and no run of ties is sorted in one task: rows are dealt into ranges of value, order and the row's own number,
    written sorted, and each range adds what the ranges before it hold, one small row for each range and value. Rows are
    shuffled once, so they should be narrow, and read twice, so they should be a table. ``__part``, the range of each row,
    stays if it is asked for.
    """
    keys = [*([F.col(within)] if within else []), *order, F.col("__row")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    stored, _ = materialize(dealt.withColumn("__at", F.monotonically_increasing_id()).drop("__row"), "numbered")
    stored = stored.withColumns({"__part": F.shiftright("__at", 33), "__within": F.col(within) if within else F.lit(0)})
    held = stored.groupBy("__within", "__part").agg(F.min("__at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("__within").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    held = held.select("__within", "__part", (before - F.col("first")).alias("__shift"))  # at most a row for each range and one for each value
    return stored.join(broadcast_if_few(held), ["__within", "__part"]).withColumn(name, F.col("__at") + F.col("__shift")).drop("__within", "__at", "__shift", *([] if keep_part else ["__part"]))


def carried(rows: DataFrame, order: list[Column], within: str, size: str, name: str) -> DataFrame:
    """Adds the sum of ``size`` (a long) over the rows before each row in an order, inside each value of a column that is
    never null: what ``numbered`` does for counts, and split in the same way."""
    at = numbered(rows, order, "__n", within, keep_part=True)
    held = at.groupBy(within, "__part").agg(F.sum(size).alias("__sum"))
    before = F.coalesce(F.sum("__sum").over(Window.partitionBy(within).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum(size).over(Window.partitionBy(within, "__part").orderBy("__n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = held.select(within, "__part", before.alias("__shift"))
    return at.withColumn("__inside", inside).join(shift, [within, "__part"]).withColumn(name, (F.col("__inside") + F.col("__shift")).cast("long")).drop("__n", "__part", "__inside", "__shift")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its part) for each node that isn't the smallest: the same parts with fewer edges."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = index[: len(a)], index[len(a) :]
    label = np.arange(len(nodes))
    while True:  # hooks onto smaller labels, then shortens paths
        x, y = label[left], label[right]
        low, high = np.minimum(x, y), np.maximum(x, y)
        if not (apart := low < high).any():
            break
        np.minimum.at(label, high[apart], low[apart])
        while (label != (up := label[label])).any():
            label = up
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def contract(batches: Iterator[pa.RecordBatch], at_most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Replaces the edges of a task, in chunks of bounded size, by a spanning star of each part (a > b)."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0

    def out() -> Iterable[pa.RecordBatch]:
        if held:
            a, b = forest(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=EDGES)

    for batch in batches:
        held.append((batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)))
        n += batch.num_rows
        if n >= at_most:
            yield from out()
            held, n = [], 0
    yield from out()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node with an edge: root is the smallest node that it reaches.

    Alternating stars: each round links every larger neighbour of a node to the node's smallest neighbour, then every
    node's smaller neighbours to the smallest of them. Minima are pre-aggregated, written, and joined as a plain table, so
    adaptive skew joins can split a node with very many neighbours; none is gathered. Edges may repeat and may be loops.
    """
    spark = edges.sparkSession
    now, path = materialize(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").mapInArrow(contract, "a long, b long"), "edges")
    while not is_stars(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low, low_path = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m")), "lows")
        # a node u with smallest neighbour m: its larger neighbours v go to m
        large = both.where("b > a").join(low, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        # now each node has only smaller neighbours on its right; all of them go to the smallest
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least.withColumnRenamed("a", "k"), F.col("a") == F.col("k")).select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        after, new_path = materialize(small.where("a <> b").distinct().mapInArrow(contract, "a long, b long"), "edges")
        for old in (path, low_path):
            discard(spark, old)
        now, path = after, new_path
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root")).distinct()
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def is_stars(edges: DataFrame) -> bool:
    """Whether no node has two parents and no parent has a parent."""
    n, nodes = edges.distinct().agg(F.count("*"), F.countDistinct("a")).first()
    return n == nodes and edges.select("b").distinct().join(edges.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()

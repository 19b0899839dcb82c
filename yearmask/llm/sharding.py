"""Sharding by weighted rendezvous hashing of stable record keys.

Every shard bids for every record; the record goes to the shard of the highest bid. A bid depends on nothing but the
record's key and the shard, so a new shard takes only the records that it outbids all others for, and a shard that goes
(weight 0) gives up only its own. A bid is ln(u) / weight for a number u in (0, 1) drawn by a digest of key and shard, so
a shard gets records in proportion to its weight. Built-in column functions throughout: the law is computed where records
are read, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearmask.llm.common import materialize, numbered

#: shards that draw from one digest of 64 hexadecimal digits, and the digits that each takes: 52 bits, exact in doubles
DRAWS, DIGITS = 4, 13


def stable_key(key: Column, text: Column) -> Column:
    """The key as text. A record without a key is known by size and checksum of its text, so that records without keys are
    dealt over all shards, equal texts to one."""
    return F.coalesce(key.cast("string"), F.concat_ws(":", F.lit("none"), F.octet_length(text), F.crc32(text.cast("binary"))))


def bid(digests: Column, shard: int, weight: float) -> Column:
    """(bid, place) of one shard; of equal bids the lower shard's is the greater."""
    at = 16 * (shard % DRAWS) + 1
    u = (F.conv(F.substring(digests[shard // DRAWS], at, DIGITS), 16, 10).cast("double") + 0.5) / float(1 << (4 * DIGITS))
    return F.struct((F.log(u) / weight).alias("bid"), F.lit(-shard).alias("place"))


def with_shard(records: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text", name: str = "shard", grown: float | None = None) -> DataFrame:
    """Adds the shard (int, from 0) of each record by its key, over shards of these weights; with ``grown``, also
    ``grown_<name>``: the shard if there were one more, of that weight. It is either the same or the new one.

    Null keys are replaced by size and checksum of the text (a null text counts as empty), empty keys are keys like any
    other. Repeated keys share a shard, so a key that holds a third of all records makes its shard that large. Columns of
    the new names are replaced. An empty table stays empty. Weights below zero, or all zero, are an error.
    """
    if min(weights, default=0) < 0 or max(weights, default=0) <= 0 or (grown is not None and grown <= 0):
        raise ValueError("weights are at least 0, and some weight is above")
    number = len(weights) + (grown is not None)
    of = stable_key(F.col(key), F.coalesce(F.col(text), F.lit("")))
    digests = F.array(*[F.sha2(F.concat_ws(":", "__key", F.lit(str(n))), 256) for n in range(-(-number // DRAWS))])
    drawn = records.drop(name, f"grown_{name}").withColumn("__key", of).withColumn("__digests", digests)
    bids = [bid(F.col("__digests"), i, w) for i, w in enumerate(weights) if w > 0]
    won = drawn.withColumn("__best", F.array_max(F.array(*bids))).withColumn(name, -F.col("__best.place"))
    if grown is not None:
        won = won.withColumn(f"grown_{name}", -F.greatest("__best", bid(F.col("__digests"), len(weights), grown))["place"])
    return won.drop("__key", "__digests", "__best")


def listing(records: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text", grown: float = 1.0) -> DataFrame:
    """(key, size, text_crc32, shard, grown_shard, slot) of each record: its bytes of UTF-8 and 8 more, the unsigned CRC-32
    of its text (null: empty), its shard, the one if there were one more, and its place in its shard, from 0 without gaps.

    Slots go by key (null first), size and checksum; rows equal in all of them are alike, so any order of theirs gives the
    same listing. Texts are read once and stay where they are; neither a large shard nor a key that holds a third of the
    records is numbered in one task (``numbered``).
    """
    body = F.coalesce(F.col(text), F.lit(""))
    dealt = with_shard(records.select(key, F.col(text).alias("__text")), weights, key, "__text", grown=grown).withColumn(text, F.col("__text"))
    narrow = dealt.select(key, (F.octet_length(body) + F.lit(8)).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"), "shard", "grown_shard")
    stored, _ = materialize(narrow, "shards")
    return numbered(stored, [F.col(key).asc_nulls_first(), F.col("size"), F.col("text_crc32")], "slot", within="shard")


def write_shards(records: DataFrame, path: str, weights: Sequence[float], key: str = "doc_id", text: str = "text", rows_per_file: int = 100_000) -> DataFrame:
    """Writes the records as Parquet, a folder ``shard=i`` for each shard, in files of bounded rows in the order of the
    keys, and returns the manifest (shard, rows, bytes). Records are shuffled once, by ranges of shard, key and the row's
    own number, so that large shards and hot keys are written by many tasks. A column named shard is replaced."""
    dealt = with_shard(records, weights, key, text)
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("shard"), F.col(key).asc_nulls_first(), F.col("__row")]
    sorted_rows = dealt.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("__row")
    sorted_rows.write.partitionBy("shard").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return manifest(records.sparkSession.read.parquet(path), text)


def manifest(sharded: DataFrame, text: str = "text") -> DataFrame:
    """(shard, rows, bytes) of a sharded table; shards without rows aren't listed."""
    size = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long")
    return sharded.groupBy(F.col("shard").cast("int").alias("shard")).agg(F.count("*").alias("rows"), F.sum(size).alias("bytes"))

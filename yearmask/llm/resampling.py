"""Importance resampling towards a target distribution, by bit-sliced sums.

Texts and target are counted in hashed buckets of words and word pairs; a bucket's gain is the scaled logarithm of how much
likelier the target makes it. A document's counts are stored as bit planes, one bit a bucket, and so are the gains, signs
apart: the sum of count times gain is then the number of bits that a count plane and a gain plane share, times the power
of two that the two planes stand for, summed over pairs of planes. It is exact, in integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearmask.llm.common import materialize, numbered, spread, text_bytes, word_pieces

BUCKETS = 10_000
#: documents whose planes are worked on together
SLICE = 64


def features(text: bytes) -> tuple[int, np.ndarray]:
    """(words, the bucket of each run of one or two words, repeats included)."""
    n, found, last = 0, [], []
    for words in word_pieces(text):
        if words:
            pairs = [*last, *words]
            hashes = [*map(crc32, words), *map(crc32, map(b" ".join, zip(pairs, pairs[1:], strict=False)))]
            found.append((np.array(hashes, dtype=np.uint32) % BUCKETS).astype(np.int16))
            n, last = n + len(words), words[-1:]
    return n, np.concatenate(found) if found else np.zeros(0, dtype=np.int16)


def bucket_totals(texts: DataFrame, text: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket. Each batch leaves as at most BUCKETS rows, pre-aggregated
    before the shuffle; the driver gets BUCKETS rows, whatever the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for t in text_bytes(batch.column(0)):
                counts += np.bincount(features(t)[1], minlength=BUCKETS)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(counts[held])], names=["bucket", "n"])

    out = np.zeros(BUCKETS, dtype=np.int64)
    for bucket, n in spread(texts.select(text)).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket: floor(1000 ln((t + 1)(S + BUCKETS) / ((s + 1)(T + BUCKETS)))), in doubles."""
    everything, wanted = float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (everything + BUCKETS) / ((float(s) + 1) * (wanted + BUCKETS)))) for s, t in zip(source, target, strict=True)], dtype=np.int64)


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of rows of numbers at or above 0: (bits, rows, 64-bit words), the lowest bit first."""
    bits = int(values.max(initial=0)).bit_length()
    values = values.astype(np.min_scalar_type((1 << bits) - 1))
    width = -(-values.shape[1] // 64) * 8
    out = np.zeros((bits, len(values), width), dtype=np.uint8)
    for k in range(bits):
        packed = np.packbits((values >> k) & 1 != 0, axis=1)
        out[k, :, : packed.shape[1]] = packed
    return out.view(np.uint64)


def sums(counts: np.ndarray, plus: np.ndarray, minus: np.ndarray) -> np.ndarray:
    """Of each row of counts, the sum of count times gain: shared bits of planes, times powers of two."""
    total = np.zeros(len(counts), dtype=np.int64)
    for k, count in enumerate(planes(counts)):
        for sign, side in ((1, plus), (-1, minus)):
            for j, gain in enumerate(side):
                total += sign * (np.bitwise_count(count & gain).sum(axis=1, dtype=np.int64) << (k + j))
    return total


NEW = "n_words long, n_features long, weight long"


def with_weight(docs: DataFrame, gain: np.ndarray, text: str = "text") -> DataFrame:
    """Adds n_words, n_features and weight, the mean gain of a text's features rounded down (without any: 0).

    A null text counts as empty; very long texts are taken apart in pieces. Repeated rows stay. Columns of the new names
    are replaced. No shuffle; the gains, BUCKETS numbers, are broadcast.
    """
    kept = docs.drop("n_words", "n_features", "weight")
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plus, minus = (planes(np.maximum(sign * shared.value, 0)[None, :])[:, 0] for sign in (1, -1))
        for batch in batches:
            for part in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                n_words, found = zip(*(features(t) for t in text_bytes(part.column(part.schema.get_field_index(text)))), strict=True)
                counts = np.stack([np.bincount(f, minlength=BUCKETS) for f in found])
                n = np.array([len(f) for f in found], dtype=np.int64)
                weight = sums(counts, plus, minus) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n_words, pa.int64()), pa.array(n), pa.array(weight)], names=[*part.schema.names, "n_words", "n_features", "weight"])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *T._parse_datatype_string(NEW).fields]))


def noise(key: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln(u))) for a number u in (0, 1) drawn by a digest of seed and key: drawing the highest sums of log
    weight and such noise is drawing by weight without putting back. A null key counts as empty."""
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0))).cast("long")


def drawn(docs: DataFrame, target: DataFrame, percent: int = 25, seed: int = 7, least_words: int = 20, key: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """Every document's key with n_words, n_features, weight, score (weight and noise) and rank: floor(percent * N / 100)
    documents of the highest scores are drawn, of the N with at least ``least_words`` words, and ranked from 1, ties to the
    smaller key (null: the largest); other documents have no rank.

    All texts are counted and weighed. Null, empty and wordless texts have no features, weight 0 and no rank. Rows of one
    key are documents of their own with the same noise; equal rows get ranks in the order they were read. An empty target
    makes all gains depend on the documents alone; without documents there are no rows. Texts are read twice and never
    shuffled; narrow rows are shuffled once, to be ranked in ranges, however many tie.
    """
    gain = gains(bucket_totals(docs, text), bucket_totals(target, target_text))
    narrow = spread(docs.select(F.col(key), F.col(text).alias("__text")))
    weighed, _ = materialize(with_weight(narrow, gain, "__text").drop("__text").withColumn("score", F.col("weight") + noise(F.col(key), seed)), "weighed")
    able = F.col("n_words") >= least_words
    n = weighed.where(able).count() * percent // 100
    placed = numbered(weighed, [(~able).asc(), F.col("score").desc(), F.col(key).asc_nulls_last()], "__place")
    return placed.withColumn("rank", F.when(F.col("__place") < n, F.col("__place") + 1)).drop("__place")


def resampled(docs: DataFrame, target: DataFrame, percent: int = 25, seed: int = 7, least_words: int = 20, key: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """The drawn documents with all their columns and ``rank``; the key has to be unique. A column rank is replaced."""
    chosen = drawn(docs, target, percent, seed, least_words, key, text, target_text).where("rank is not null").select(F.col(key).alias("__key"), "rank")
    return docs.drop("rank").join(chosen, F.col(key).eqNullSafe(F.col("__key"))).drop("__key")

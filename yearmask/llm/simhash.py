"""SimHash near-duplicates by bit-sliced comparison.

Texts become 64-bit fingerprints. Equal fingerprints are one node. Any two that differ in at most 4 bits agree on at
least two of six bit blocks, so each node goes into fifteen tables, one for each pair of blocks, and only nodes that
share a table's key are compared: exact, whatever the data. A comparison stores the fingerprints as 64 bit planes,
adds differing bits of 64 lanes at once with carry-save adders, and abandons a word of lanes when all 64 are past the
radius.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearmask.llm.common import LOWER_ASCII, components, contract, materialize, text_bytes

#: (first bit, bits) of the six blocks
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
#: a run of equal keys up to this length is compared in its task; a longer one is dealt out in pairs of pieces
PIECE = 20_000
SMALL = 64
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, width: int = 4, seed: int = 42) -> int:
    """The fingerprint, as a signed 64-bit number. A text without words has 0; one of fewer words is one shingle."""
    words = text.translate(LOWER_ASCII).split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_digest
    counts = np.zeros((8, 256), dtype=np.int64)
    for at in range(0, n, 100_000):
        part = words[at : at + 100_000 + width - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(width)), strict=False)) if n > 1 or len(words) == width else [b" ".join(words)]
        raw = np.frombuffer(b"".join([digest(s, seed) for s in shingles]), dtype=np.uint8)
        counts += np.bincount((raw.reshape(-1, 8) + np.arange(0, 2048, 256)).ravel(), minlength=2048).reshape(8, 256)
    ones = (counts @ BYTE_BITS).ravel()
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint (bigint) of each whole text; a column of that name is replaced. One pass, no shuffle."""
    kept = docs.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                got = pa.array([fingerprint(t) for t in text_bytes(part.column(part.schema.get_field_index(text)))], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, got], names=[*part.schema.names, name])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(name, T.LongType())]))


def add3(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save adder: sum and carry of three bit vectors."""
    u = a ^ b
    return u ^ c, (a & b) | (u & c)


def past(ones: np.ndarray, twos: np.ndarray, fours: np.ndarray, over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count, in three bits and an overflow, is above the radius (below 8)."""
    above, equal = over, ~over
    for bits, k in ((fours, 4), (twos, 2), (ones, 1)):
        if radius & k:
            equal = equal & bits
        else:
            above = above | (equal & bits)
            equal = equal & ~bits
    return above


def near(plane: Callable[[int, np.ndarray], np.ndarray], words: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, lanes still within the radius) of those words of 64 lanes that have any.

    ``plane(b, at)`` gives the lanes that differ in bit b, for the words ``at``.
    """
    at = np.arange(words)
    ones = twos = fours = over = np.zeros(words, dtype=np.uint64)
    for b in range(0, 64, 8):
        x = [plane(b + i, at) for i in range(8)]
        ones, t0 = add3(ones, x[0], x[1])
        ones, t1 = add3(ones, x[2], x[3])
        twos, f0 = add3(twos, t0, t1)
        ones, t0 = add3(ones, x[4], x[5])
        ones, t1 = add3(ones, x[6], x[7])
        twos, f1 = add3(twos, t0, t1)
        fours, eight = add3(fours, f0, f1)
        over = over | eight
        gone = past(ones, twos, fours, over, radius)
        live = gone != ALL
        if not live.all():  # abandon words in which every lane is past the radius
            at, ones, twos, fours, over, gone = at[live], ones[live], twos[live], fours[live], over[live], gone[live]
            if not len(at):
                break
    return at, ~gone if len(at) else np.zeros(0, dtype=np.uint64)


def slices(values: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of each value, 64 values a word; the last word is filled with zeros."""
    n = -(-len(values) // 64) * 64
    padded = np.zeros(n, dtype="<u8")
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits, axis=0, bitorder="little").T).view("<u8").reshape(64, n // 64)


def lanes(word: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into word, lane) for each set bit."""
    bits = np.unpackbits(mask.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.nonzero(bits)


def near_pairs(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Which of the pairs (a[i], b[i]) are within the radius, compared 64 pairs at a time."""
    planes = slices(a ^ b)
    word, mask = near(lambda bit, at: planes[bit, at], planes.shape[1], radius)
    i, lane = lanes(word, mask)
    hit = word[i] * 64 + lane
    return hit[hit < len(a)]


def near_blocks(left: np.ndarray, right: np.ndarray, radius: int, queries: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within the radius between left and right, some queries of left at a time against the planes of right."""
    planes = slices(right)
    wide = planes.shape[1]
    for first in range(0, len(left), queries):
        some = left[first : first + queries]
        flips = [np.where(some >> np.uint64(bit) & np.uint64(1), ALL, np.uint64(0)) for bit in range(64)]
        word, mask = near(lambda bit, at, f=flips: planes[bit, at % wide] ^ f[bit][at // wide], wide * len(some), radius)
        i, lane = lanes(word, mask)
        j = word[i] % wide * 64 + lane
        real = j < len(right)
        yield some[word[i][real] // wide], right[j[real]]


def pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    a, b = a.astype(np.uint64).view(np.int64), b.astype(np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])


FOUND = "a long, b long, k long, piece long, fingerprints binary"
NAMES = ["a", "b", "k", "piece", "fingerprints"]


def compare_runs(radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over rows (k, fingerprint) sorted by k: a spanning star of the links found in each run of equal k; of runs longer
    than PIECE, pieces instead, which are compared afterwards, each with each, in tasks of their own."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | tuple[int, int, bytes]]:
        k, f = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        long_key, number = None, 0
        for batch in chain(batches, [None]):
            if batch is not None:
                k = np.concatenate([k, batch.column(0).to_numpy(zero_copy_only=False)])
                f = np.concatenate([f, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
                if not len(k):
                    continue
            if not len(k):
                break
            starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            ends = np.append(starts[1:], len(k))
            if batch is not None:  # the last run may go on in the next batch
                done = starts[-1]
                if len(k) - done >= PIECE:
                    if long_key != k[done]:
                        long_key, number = k[done], 0
                    cut = done + (len(k) - done) // PIECE * PIECE
                    for at in range(done, cut, PIECE):
                        yield int(long_key), number, f[at : at + PIECE].tobytes()
                        number += 1
                    rest = (k[cut:], f[cut:])
                else:
                    rest = (k[done:], f[done:])
                starts, ends = starts[:-1], ends[:-1]
            else:
                done, rest = len(k), (k[:0], f[:0])
            long_runs = ends - starts > SMALL
            if long_key is not None:
                long_runs |= k[starts] == long_key
            for s, e in zip(starts[long_runs], ends[long_runs], strict=True):
                if k[s] == long_key:
                    yield int(long_key), number, f[s:e].tobytes()
                    number += 1
                elif e - s > PIECE:
                    for n, at in enumerate(range(s, e, PIECE)):
                        yield int(k[s]), n, f[at : min(e, at + PIECE)].tobytes()
                else:
                    for a, b in near_blocks(f[s:e], f[s:e], radius):
                        yield pair_batch(a[a < b], b[a < b])
            short = np.repeat(~long_runs, ends - starts)
            kk, ff = k[:done][short], f[:done][short]
            left, right = [], []
            for step in range(1, SMALL):  # pairs inside short runs, by their distance in the sorted order
                same = np.flatnonzero(kk[step:] == kk[:-step])
                if not len(same):
                    break
                left.append(ff[same])
                right.append(ff[same + step])
            if left:
                a, b = np.concatenate(left), np.concatenate(right)
                hit = near_pairs(a, b, radius)
                yield pair_batch(a[hit], b[hit])
            k, f = rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def stars() -> Iterator[pa.RecordBatch]:
            for x in contract(iter(held)):
                none = pa.nulls(x.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([*x.columns, none, none, pa.nulls(x.num_rows, pa.binary())], names=NAMES)
            held.clear()

        for x in found(batches):
            if isinstance(x, tuple):
                none = pa.nulls(1, pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, pa.array([x[0]], pa.int64()), pa.array([x[1]], pa.int64()), pa.array([x[2]], pa.binary())], names=NAMES)
                continue
            held.append(x)
            if sum(y.num_rows for y in held) > 1_000_000 or len(held) > 1000:
                held[:] = [y for y in contract(iter(held))]
                if sum(y.num_rows for y in held) > 500_000:
                    yield from stars()
        yield from stars()

    return run


def compare_pieces(radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for a, b in near_blocks(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64), radius):
                    yield pair_batch(a[a != b], b[a != b])

    return lambda batches: contract(edges(batches))


def table_keys(name: str) -> F.Column:
    """The keys of the fifteen tables, each with its table's number on top."""
    block = [F.shiftrightunsigned(F.col(name), s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in BLOCKS]
    return F.array(*[F.shiftleft(block[i], 11) + block[j] + F.lit(t << 32) for t, (i, j) in enumerate(combinations(range(6), 2))])


def links(nodes: DataFrame, radius: int = 4) -> DataFrame:
    """(a, b): links between distinct fingerprints (one column, distinct) that keep every component whole."""
    if radius > 4:
        raise ValueError("two of six blocks stay equal only up to a radius of 4")
    keyed = nodes.select(F.explode(table_keys("fingerprint")).alias("k"), "fingerprint")
    found, _ = materialize(keyed.repartition("k").sortWithinPartitions("k", "fingerprint").mapInArrow(compare_runs(radius), FOUND), "runs")
    edges = found.where("k is null").select("a", "b")
    pieces = found.where("k is not null").select("k", "piece", "fingerprints")
    if not pieces.isEmpty():
        x, y = pieces.alias("x"), pieces.alias("y")
        both = x.join(y, (F.col("x.k") == F.col("y.k")) & (F.col("x.piece") <= F.col("y.piece")))
        dealt = both.select(F.col("x.fingerprints").alias("l"), F.col("y.fingerprints").alias("r"), F.xxhash64("x.k", "x.piece", "y.piece").alias("h")).repartition("h").select("l", "r")
        edges = edges.unionByName(dealt.mapInArrow(compare_pieces(radius), "a long, b long"))
    return edges


def near_duplicates(prints: DataFrame, radius: int = 4) -> DataFrame:
    """Adds component_id, the smallest doc_id reachable by links of at most ``radius`` differing bits, and group, the
    smallest fingerprint of the component, to rows of (doc_id, fingerprint). Rows with a null doc_id take part and are
    never named; a component of such rows alone has null.

    Rows collapse to distinct fingerprints first, so exact copies cost one node however many there are. Repeated rows stay,
    other columns too, but for those of the new names, which are replaced; an empty table gives none.
    """
    prints = prints.drop("component_id", "group")
    nodes, _ = materialize(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "nodes")
    parts = components(links(nodes.select("fingerprint"), radius))
    linked = parts.join(nodes, F.col("node") == F.col("fingerprint"))
    named = linked.groupBy("root").agg(F.min("first").alias("reached"))
    reached = linked.select("fingerprint", "root").join(named, "root")
    labels = nodes.join(reached, "fingerprint", "left").select("fingerprint", F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("reached")).alias("component_id"), F.coalesce("root", "fingerprint").alias("group"))
    labels, _ = materialize(labels, "labels")  # a plain table: the join below can then split the copies of one text
    return prints.join(labels, "fingerprint", "left")

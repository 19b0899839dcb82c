"""Embedding near-duplicates by lattice hashing.

In each table a unit vector is projected at random into blocks of 8 dimensions, and each block is decoded to the nearest
point of the E8 lattice. The points of all blocks name the home cell; the next nearest point of the block that lies
closest to its border names a neighbouring cell, which is probed too. More vectors take finer lattices or more blocks, and
more tables with them, so cells stay small and near pairs still meet.

Cells are gathered by ids and sketches of 128 signs alone. Only vectors that have a likely partner in a cell are fetched, and
compared by cosine in double precision; a pair is counted in the first table, and there in the smallest cell, in which it
meets, so counts need no list of pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearmask.llm.common import components, contract, materialize

SEED = 6
#: (vectors up to which it serves, blocks, scale of the lattice, tables): by simulation a pair at a cosine of exactly 0.9
#: meets with probability 0.98 or more, and a vector meets some 30 unrelated ones at a step's end up to 1,000,000 vectors,
#: and some 1,000 at 1,000,000,000
PLANS = ((5_000, 1, 2.4, 8), (20_000, 2, 2.1, 22), (50_000, 2, 1.95, 28), (120_000, 2, 1.8, 36), (1_000_000, 3, 2.1, 64), (10_000_000, 3, 1.8, 145), (None, 4, 2.1, 196))
SKETCH = 128
#: entries of one cell up to this number are compared in its task; more are dealt out in pairs of pieces
PIECE = 8192
#: cells beyond this number of entries are groups of near vectors: all of their vectors are fetched
CROWD = 1024
#: rows and columns of vectors that are multiplied at once
TILE = 512


def d8(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest and the next point of D8 (whole coordinates of even sum) for each row."""
    near = np.rint(x)
    off = x - near
    step = np.where(off >= 0, 1.0, -1.0)
    odd = near.sum(axis=1) % 2 != 0
    order, row = np.argsort(-np.abs(off), axis=1, kind="stable"), np.arange(len(x))
    first, second = order[:, 0], order[:, 1]
    a, b = near.copy(), near
    a[row, first] += np.where(odd, step[row, first], 0)
    b[row, second] += step[row, second]
    b[row, first] += np.where(odd, 0, step[row, first])
    return a, b


MIX = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD3A2646C, 0xFD7046C5, 0xB55A4F09)


def points(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (rows, 2) of the nearest E8 point and of the next of the points considered, D8 and D8 + 1/2, and how much
    further the next one is."""
    a, b = d8(x)
    c, d = d8(x - 0.5)
    near = np.stack([a, b, c + 0.5, d + 0.5], axis=1)
    far = ((x[:, None, :] - near) ** 2).sum(axis=2)
    order = np.argsort(far, axis=1, kind="stable")[:, :2]
    best = np.rint(2 * np.take_along_axis(near, order[:, :, None], axis=1)).astype(np.int64)
    two = np.take_along_axis(far, order, axis=1)
    return scrambled((best * np.array(MIX)).sum(axis=2).astype(np.uint64)), two[:, 1] - two[:, 0]


def scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def codes(unit: np.ndarray, blocks: int, scale: float, tables: int) -> np.ndarray:
    """(rows, tables, 2): home and probe cell of each unit vector in each table."""
    out = np.empty((len(unit), tables, 2), dtype=np.uint32)
    row = np.arange(len(unit))
    for t in range(tables):
        name = np.empty((len(unit), blocks, 2), dtype=np.uint64)
        gap = np.empty((len(unit), blocks))
        for j in range(blocks):
            p = np.random.default_rng([SEED, t, j, unit.shape[1]]).normal(size=(unit.shape[1], 8)) / scale
            name[:, j], gap[:, j] = points(unit @ p)
        home, probe = name[:, :, 0], name[:, :, 0].copy()
        probe[row, gap.argmin(axis=1)] = name[row, gap.argmin(axis=1), 1]
        for side, cell in enumerate((home, probe)):
            mixed = (cell * np.array([2 * j + 1 for j in range(blocks)], dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
            out[:, t, side] = (scrambled(mixed) >> np.uint64(32)).astype(np.uint32)
    return out


def sketches(unit: np.ndarray) -> np.ndarray:
    """(rows, 2): the signs of SKETCH random projections of each unit vector, as two numbers."""
    p = np.random.default_rng([SEED, unit.shape[1]]).normal(size=(unit.shape[1], SKETCH))
    return np.packbits(unit @ p > 0, axis=1).view("<i8")


def sketch_radius(least: float) -> int:
    """Differing signs that a pair at cosine ``least`` passes with less than 1 in 10,000."""
    share = float(np.arccos(np.clip(least, -1, 1))) / np.pi
    return int(np.ceil(SKETCH * share + 4 * np.sqrt(SKETCH * share * (1 - share))))


def readable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, class, v, size): the class of a usable vector is a digest of its numbers, null for any other vector.
    v holds the numbers in single precision where that is exact, else in double precision."""
    for batch in batches:
        for part in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
            out: list[tuple[str, bytes, int] | tuple[None, None, None]] = []
            for x in part.column(1).to_pylist():
                a = np.array(x, dtype=np.float64) + 0.0 if x and None not in x else np.zeros(0)  # + 0.0: one zero
                if not len(a) or not np.isfinite(a).all() or not a.any():
                    out.append((None, None, None))
                    continue
                with np.errstate(over="ignore"):
                    single = a.astype("<f4")
                out.append((xxhash.xxh3_128_hexdigest(a.tobytes()), (single if np.array_equal(single, a) else a).tobytes(), len(a)))
            key, v, size = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(key, pa.string()), pa.array(v, pa.binary()), pa.array(size, pa.int32())], names=["vec_id", "class", "v", "size"])


def unit_rows(raw: list[bytes], width: int, kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), width).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


CODED = "id long, w long, size int, v binary, codes binary, first long, second long"


def coded(blocks: int, scale: float, tables: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (id, w, size, v) to the same with all cells and the sketch of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
                size = part.column(2).to_numpy(zero_copy_only=False)
                raw = part.column(3).to_pylist()
                wide = np.array([len(x) for x in raw])
                cells: list[bytes] = [b""] * part.num_rows
                sketch = np.zeros((part.num_rows, 2), dtype=np.int64)
                for s, b in {(int(x), int(y)) for x, y in zip(size, wide, strict=True)}:
                    at = np.flatnonzero((size == s) & (wide == b))
                    u = unit_rows([raw[i] for i in at], s, "<f4" if b == 4 * s else "<f8")
                    sketch[at] = sketches(u)
                    for i, c in zip(at, codes(u, blocks, scale, tables), strict=True):
                        cells[i] = c.tobytes()
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cells, pa.binary()), *map(pa.array, np.ascontiguousarray(sketch.T))], names=[x.split()[0] for x in CODED.split(", ")])

    return run


def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (id, size, codes, first, second), one row for each cell of each vector: key k (shape, table and cell), the id, the
    sketch, and whether it is at home there."""
    for batch in batches:
        for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
            c = np.frombuffer(b"".join(part.column(2).to_pylist()), dtype="<u4").reshape(part.num_rows, -1, 2)
            size = part.column(1).to_numpy().astype(np.int64) & 0xFFFFF
            k = c.astype(np.int64) + (np.arange(c.shape[1])[None, :, None] << 32) + (size << 40)[:, None, None]
            each = c.shape[1] * 2
            yield pa.RecordBatch.from_arrays([
                pa.array(k.ravel()), pa.array(np.repeat(part.column(0).to_numpy(), each)), *[pa.array(np.repeat(part.column(i).to_numpy(), each)) for i in (3, 4)], pa.array(np.tile([True, False], len(k) * c.shape[1]))
            ], names=["k", "id", "first", "second", "home"])


def hopeful(radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over rows (k, id, first, second, home) sorted by k: (k, id) of those that have a partner in their cell within the radius,
    one of the two at home. Cells beyond CROWD pass as they are."""

    def likely(k: np.ndarray, first: np.ndarray, second: np.ndarray, home: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(k), dtype=bool)
        for step in range(1, CROWD):
            i = np.flatnonzero(k[step:] == k[:-step])  # pairs of a cell by their distance in the sorted order
            if not len(i):
                break
            i = i[(home[i] | home[i + step]) & (np.bitwise_count(first[i] ^ first[i + step]) + np.bitwise_count(second[i] ^ second[i + step]) <= radius)]
            keep[i] = keep[i + step] = True
        return keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        crowd: int | None = None  # the cell at hand, once it is known to be one

        def out(columns: list[np.ndarray], keep: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(columns[0][keep]), pa.array(columns[1][keep])], names=["k", "id"])

        for batch in chain(batches, [None]):
            if batch is None:
                if held is None:
                    return
                columns, rest = held, [x[:0] for x in held]
            else:
                new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
                columns = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
                if not len(columns[0]):
                    continue
                last = int(np.searchsorted(columns[0], columns[0][-1]))
                if len(columns[0]) - last > CROWD:
                    crowd, last = int(columns[0][-1]), len(columns[0])
                elif columns[0][-1] == crowd:
                    last = len(columns[0])
                columns, rest = [x[:last] for x in columns], [x[last:] for x in columns]
            k = columns[0]
            if len(k):
                start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
                many = np.repeat((np.diff(np.append(start, len(k))) > CROWD) | (k[start] == crowd), np.diff(np.append(start, len(k))))
                keep = many.copy()
                few = ~many
                keep[few] = likely(k[few], columns[2][few].view(np.uint64), columns[3][few].view(np.uint64), columns[4][few])
                yield out(columns, keep)
            held = rest

    return run


class Cell:
    """The vectors of one cell, or of a piece of one, those with equal homes together."""

    def __init__(self, ids: list[int], w: list[int], v: list[bytes], codes: list[bytes], size: int):
        c = np.frombuffer(b"".join(codes), dtype="<u4").reshape(len(ids), -1, 2)
        order = np.lexsort(c[:, :4, 0].T[::-1])
        self.ids, self.w = np.array(ids, dtype=np.int64)[order], np.array(w, dtype=np.int64)[order]
        self.home, self.probe = np.ascontiguousarray(c[order, :, 0]), np.ascontiguousarray(c[order, :, 1])
        f4 = np.array([len(x) == 4 * size for x in v])[order]
        self.u = np.empty((len(v), size))
        for mask, kind in ((f4, "<f4"), (~f4, "<f8")):
            if mask.any():
                self.u[mask] = unit_rows([v[i] for i in order[mask]], size, kind)

    def tiles(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Slices, with the least and the greatest home of each table in them."""
        for at in range(0, len(self.ids), TILE):
            home = self.home[at : at + TILE]
            yield slice(at, at + TILE), home.min(axis=0), home.max(axis=0)


def linked(left: Cell, right: Cell, table: int, cell: int, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, weights of the others, ids of the others, own weights) of the pairs that are counted here."""
    for a, low, high in left.tiles():
        for b, low_b, high_b in right.tiles():
            same = left is right
            if same and b.start < a.start:
                continue
            if ((low == high) & (low_b == high_b) & (low == low_b))[:table].any():
                continue  # all of these have met before
            i, j = np.nonzero(left.u[a] @ right.u[b].T >= least)
            i, j = i + a.start, j + b.start
            if same:
                i, j = i[i < j], j[i < j]
            home_i, home_j = left.home[i, table], right.home[j, table]
            at_i, at_j = home_i == cell, home_j == cell
            # one is at home here; when each is at home in the other's probe cell, the smaller cell counts the pair
            other = np.where(at_i, home_j, home_i)
            twice = (at_i ^ at_j) & (np.where(at_i, left.probe[i, table], right.probe[j, table]) == other) & (other < cell)
            keep = (at_i | at_j) & ~twice & (left.ids[i] != right.ids[j])
            i, j = i[keep], j[keep]
            for t in range(table):
                if not len(i):
                    break
                p, q = left.home[i, t], right.home[j, t]
                met = (p == q) | (p == right.probe[j, t]) | (q == left.probe[i, t])
                i, j = i[~met], j[~met]
            if len(i):
                yield left.ids[i], right.w[j], right.ids[j], left.w[i]


NAMES = ["a", "b", "n", "k", "piece", "size", "ids", "ws", "vs", "codes"]
FOUND = "a long, b long, n long, k long, piece long, size int, ids array<long>, ws array<long>, vs array<binary>, codes array<binary>"


def rows(**columns: pa.Array) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    types = [pa.int64()] * 5 + [pa.int32()] + [pa.list_(pa.int64())] * 2 + [pa.list_(pa.binary())] * 2
    return pa.RecordBatch.from_arrays([columns.get(x, pa.nulls(n, t)) for x, t in zip(NAMES, types, strict=True)], names=NAMES)


class Tally:
    """Links and weights of a task: links shrink to stars, weights to sums, whenever a bounded number has come in."""

    def __init__(self) -> None:
        self.links: list[pa.RecordBatch] = []
        self.ids: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []
        self.n = 0

    def add(self, a: np.ndarray, wb: np.ndarray, b: np.ndarray, wa: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.links.append(pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"]))
        self.ids += [a, b]
        self.weights += [wb, wa]
        self.n += len(a)
        if self.n > 1_000_000:
            yield from self.out()

    def out(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            for x in contract(iter(self.links)):
                yield rows(a=x.column(0), b=x.column(1))
            ids, at = np.unique(np.concatenate(self.ids), return_inverse=True)
            total = np.zeros(len(ids), dtype=np.int64)
            np.add.at(total, at, np.concatenate(self.weights))
            yield rows(a=pa.array(ids), n=pa.array(total))
            self.__init__()


def place(k: int) -> tuple[int, int]:
    return k >> 32 & 0xFF, k & 0xFFFFFFFF


def compare_cells(least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over rows (k, id, w, v, codes, size) sorted by k: links (a, b) and weights (a, n); of cells beyond PIECE, pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        key, held, number = None, [], 0

        def piece() -> pa.RecordBatch:
            ids, w, v, c, s = map(list, zip(*held, strict=True))
            numbers, raw = pa.list_(pa.int64()), pa.list_(pa.binary())
            return rows(k=pa.array([key]), piece=pa.array([number]), size=pa.array(s[:1], pa.int32()), ids=pa.array([ids], numbers), ws=pa.array([w], numbers), vs=pa.array([v], raw), codes=pa.array([c], raw))

        def done() -> Iterator[pa.RecordBatch]:
            if number and held:
                yield piece()
            elif len(held) > 1:
                ids, w, v, c, s = map(list, zip(*held, strict=True))
                cell = Cell(ids, w, v, c, s[0])
                for x in linked(cell, cell, *place(key), least):
                    yield from tally.add(*x)

        for batch in batches:
            for k, *entry in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    yield from done()
                    key, held, number = k, [], 0
                held.append(entry)
                if len(held) == PIECE:
                    yield piece()
                    held, number = [], number + 1
        yield from done()
        yield from tally.out()

    return run


#: a cell of more than about so many pieces is dealt out before it is sorted; how many vectors are looked at to find such cells
CROWDED, SAMPLE = 2, 50_000


def crowded(known: DataFrame, n: int) -> DataFrame:
    """(k, pieces) of the cells that hold more than about CROWDED pieces, by the entries of a sample of the vectors: how a
    cell is dealt out changes no link, so a cell that is missed is only slower. Few can be that large: a row for each."""
    each = max(1, n // SAMPLE)
    some = known.where(F.pmod(F.xxhash64("id", F.lit(6)), F.lit(each)) == 0)
    counts = some.select("id", "size", "codes", "first", "second").mapInArrow(entries, "k long, id long, first long, second long, home boolean").groupBy("k").agg((F.count("*") * each).alias("n"))
    return counts.where(F.col("n") > CROWDED * PIECE).select("k", F.ceil(F.col("n") / PIECE).cast("long").alias("pieces"))


def as_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k, piece, id, w, v, codes, size) of crowded cells, sorted by cell and piece, to pieces of PIECE at most."""
    at, held, number = None, [], 0

    def out() -> pa.RecordBatch:
        ids, w, v, c, s = map(list, zip(*held, strict=True))
        numbers, raw = pa.list_(pa.int64()), pa.list_(pa.binary())
        return rows(k=pa.array([at[0]]), piece=pa.array([(at[1] << 20) + number]), size=pa.array(s[:1], pa.int32()), ids=pa.array([ids], numbers), ws=pa.array([w], numbers), vs=pa.array([v], raw), codes=pa.array([c], raw))

    for batch in batches:
        for k, piece, *entry in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (k, piece) != at or len(held) == PIECE:
                if held:
                    yield out()
                number = number + 1 if (k, piece) == at else 0
                at, held = (k, piece), []
            held.append(entry)
    if held:
        yield out()


def compare_pieces(least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            for i in range(batch.num_rows):
                k, p, q, s, *both = (c[i].as_py() for c in batch.columns)
                left = Cell(*both[:4], s)
                for x in linked(left, left if p == q else Cell(*both[4:], s), *place(k), least):
                    yield from tally.add(*x)
        yield from tally.out()

    return run


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least: float = 0.9, plans: tuple = PLANS) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of vectors.

    Links are pairs with a cosine of at least ``least`` that meet in a cell. Vectors that are null, empty, zero or hold
    null or non-finite numbers link with nothing, nor do rows with a null id; vectors of different lengths never link.
    Equal vectors are one node with a weight: copies link with each other and with what any of them links with. The
    component is the smallest id reachable; a row with a null id has none and is not kept.

    ``plans`` are for cosines of about 0.9; the number of distinct vectors chooses one.
    """
    base = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("e")).mapInArrow(readable, "vec_id long, class string, v binary, size int")
    nodes = base.where("class is not null and vec_id is not null").groupBy("class").agg(F.min("vec_id").alias("rep"), F.count("*").alias("w"), F.first("v").alias("v"), F.first("size").alias("size"))
    nodes, _ = materialize(nodes, "vectors")
    n = nodes.count()
    blocks, scale, tables = next(p[1:] for p in plans if p[0] is None or n <= p[0])
    known, _ = materialize(nodes.select(F.col("rep").alias("id"), "w", "size", "v").mapInArrow(coded(blocks, scale, tables), CODED), "codes")
    keyed = known.select("id", "size", "codes", "first", "second").mapInArrow(entries, "k long, id long, first long, second long, home boolean")
    crowds, _ = materialize(crowded(known, n), "crowds")
    crowds_there = not crowds.isEmpty()
    rest = keyed.join(crowds, "k", "left_anti") if crowds_there else keyed
    hopes = rest.repartition("k").sortWithinPartitions("k").mapInArrow(hopeful(sketch_radius(least)), "k long, id long")
    fetched = hopes.join(known.select("id", "w", "v", "codes", "size"), "id").select("k", "id", "w", "v", "codes", "size")
    found, _ = materialize(fetched.repartition("k").sortWithinPartitions("k").mapInArrow(compare_cells(least), FOUND), "cells")
    pieces = found.where("k is not null").select("k", "piece", "size", "ids", "ws", "vs", "codes")
    found = found.where("k is null").select("a", "b", "n")
    if crowds_there:  # neither sorted by cell nor gathered: each piece has its own place, and pieces meet by their numbers
        members = keyed.join(crowds, "k").select("k", F.pmod(F.xxhash64("id"), F.col("pieces")).alias("piece"), "id").join(known.select("id", "w", "v", "codes", "size"), "id")
        many, _ = materialize(members.select("k", "piece", "id", "w", "v", "codes", "size").repartition("k", "piece").sortWithinPartitions("k", "piece").mapInArrow(as_pieces, FOUND), "crowds")
        pieces = pieces.unionByName(many.select(pieces.columns))
    if not pieces.isEmpty():
        names = pieces.select("k", "piece")
        meet = names.alias("x").join(names.alias("y"), (F.col("x.k") == F.col("y.k")) & (F.col("x.piece") <= F.col("y.piece"))).select("x.k", F.col("x.piece").alias("p"), F.col("y.piece").alias("q"))
        left, right = (pieces.select("k", F.col("piece").alias(number), *(["size"] if side == "x" else []), *[F.col(c).alias(f"{side}_{c}") for c in ("ids", "ws", "vs", "codes")]) for side, number in (("x", "p"), ("y", "q")))
        both = meet.join(left, ["k", "p"]).join(right, ["k", "q"])
        dealt = both.select("k", "p", "q", "size", *[f"{side}_{c}" for side in "xy" for c in ("ids", "ws", "vs", "codes")]).repartition("k", "p", "q")
        more, _ = materialize(dealt.mapInArrow(compare_pieces(least), FOUND).select("a", "b", "n"), "cells")
        found = found.unionByName(more)
    weights = found.where("n is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    parts = components(found.where("b is not null").select("a", "b")).withColumnsRenamed({"node": "rep"})
    labels = nodes.select("class", "rep", "w").join(weights, "rep", "left").join(parts, "rep", "left")
    labels = labels.select("class", (F.col("w") - 1 + F.coalesce("n", F.lit(0))).alias("n"), F.coalesce("root", "rep").alias("root"))
    labels, _ = materialize(labels, "labels")  # a plain table: the join below can then split the copies of one vector
    joined = base.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("class")).alias("class")).join(labels, "class", "left")
    return joined.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "vec_id").alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

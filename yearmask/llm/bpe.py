"""Byte-level BPE: encoding and decoding with a two-tier lookup.

Tier one is a minimal perfect hash over the vocabulary: a whole pre-token that is a vocabulary entry gets its id from
one probe and one comparison. Tier two merges bytes: pairs stand in a heap by rank, the bytes form a linked list, and
stale heap entries are skipped, so a pre-token of n bytes takes n log n steps however long it is.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

#: texts are cut at these spaces before anything else: no match of the pattern spans one, whatever stands around it
SPACE = re.compile(r" (?=[^\s\x1c-\x1f])")

#: odd multipliers that spread the displacements
MIX_A, MIX_B, MASK = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, (1 << 64) - 1


def read_ranks(path: str) -> list[bytes]:
    """The vocabulary of a rank file, by id. A vocabulary is a fixed file of some 10**5 entries, so it may be broadcast."""
    with open(path, "rb") as f:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without a gap")
    return [ranks[i] for i in range(len(ranks))]


class PerfectHash:
    """Minimal perfect hash by displacement: n keys, n slots. Buckets are placed from the largest on; each gets the first
    displacement that sends its keys to free slots, and a bucket of one key names its slot itself (as a negative number)."""

    def __init__(self, keys: list[bytes], per_bucket: int = 4):
        self.n, self.buckets = len(keys), max(1, len(keys) // per_bucket)
        groups: dict[int, list[tuple[int, int]]] = {}
        for i, key in enumerate(keys):
            h = xxhash.xxh64_intdigest(key)
            groups.setdefault(h % self.buckets, []).append((h, i))
        self.shift, self.slots = [0] * self.buckets, [-1] * self.n
        free = np.ones(self.n, dtype=bool)
        tries = np.arange(1 << 11, dtype=np.uint64)
        for bucket, members in sorted(groups.items(), key=lambda g: (-len(g[1]), g[0])):
            if len(members) == 1:
                break
            hashes = np.array([[h] for h, _ in members], dtype=np.uint64)
            for first in range(0, 1 << 24, len(tries)):
                at = np.sort((((hashes ^ (tries + np.uint64(first)) * np.uint64(MIX_A)) * np.uint64(MIX_B)) >> np.uint64(32)) % np.uint64(self.n), axis=0).astype(np.int64)
                good = free[at].all(axis=0) & (at[1:] != at[:-1]).all(axis=0)
                if good.any():
                    break
            else:
                raise ValueError("no displacement found: keys repeat")
            self.shift[bucket] = d = first + int(good.argmax())
            for h, i in members:
                self.slots[self.place(h, d)] = i
            free[at[:, good.argmax()]] = False
        rest = iter(np.flatnonzero(free).tolist())
        for bucket, members in groups.items():
            if len(members) == 1:
                slot = next(rest)
                self.shift[bucket], self.slots[slot] = -slot - 1, members[0][1]

    def place(self, h: int, d: int) -> int:
        return (((h ^ (d * MIX_A & MASK)) * MIX_B & MASK) >> 32) % self.n

    def slot(self, key: bytes) -> int:
        h = xxhash.xxh64_intdigest(key)
        d = self.shift[h % self.buckets]
        return -d - 1 if d < 0 else self.place(h, d)


class Codec:
    """Encodes and decodes. Caches are bounded and only save time: a full cache is emptied."""

    def __init__(self, vocabulary: list[bytes], pattern: str, cache: int = 800_000):
        self.words, self.pattern, self.most = vocabulary, pattern, cache
        self.hash = PerfectHash(vocabulary)
        self.start()

    def start(self) -> None:
        self.match = regex.compile(self.pattern).findall
        self.ranks = {w: i for i, w in enumerate(self.words)}
        self.byte = [self.ranks[bytes((x,))] for x in range(256)]
        self.two = [[self.ranks.get(bytes((x, y)), -1) for y in range(256)] for x in range(256)]
        self.name_of = [b"%d" % i for i in range(len(self.words))]
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.chunks: dict[str, tuple[int, ...]] = {}  # what follows a space, by the text after it

    def __getstate__(self) -> tuple:
        return self.words, self.pattern, self.most, self.hash

    def __setstate__(self, state: tuple) -> None:
        self.words, self.pattern, self.most, self.hash = state
        self.start()

    def whole(self, piece: bytes) -> int:
        """The id of a piece that is a vocabulary entry, else -1."""
        i = self.hash.slots[self.hash.slot(piece)]
        return i if self.words[i] == piece else -1

    def merge(self, piece: bytes) -> list[int]:
        """Lowest rank first, the leftmost of equal ranks first. A heap entry is rank * n + place; it is stale, and
        skipped, once the pair at its place has another rank."""
        n, rank, two = len(piece), self.ranks.get, self.two
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ids = [self.byte[x] for x in piece]
        pair = [two[x][y] for x, y in zip(piece, piece[1:])]  # the rank of the pair that starts here, -1 if none
        pair.append(-1)
        heap = [r * n + i for i, r in enumerate(pair) if r >= 0]
        heapify(heap)
        while heap:
            r, i = divmod(heappop(heap), n)
            if pair[i] != r:
                continue
            ids[i] = r  # a merged token's id is its rank
            gone = after[i]
            j = after[i] = after[gone]
            pair[gone] = -1
            if j < n:
                before[j] = i
                pair[i] = r = rank(piece[i : after[j]], -1)
                if r >= 0:
                    heappush(heap, r * n + i)
            else:
                pair[i] = -1
            p = before[i]
            if p >= 0:
                pair[p] = r = rank(piece[p:j], -1)
                if r >= 0:
                    heappush(heap, r * n + p)
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    def fresh(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode()
        i = self.whole(raw)
        return (i,) if i >= 0 else tuple(self.merge(raw))

    def piece(self, text: str) -> tuple[int, ...]:
        """The ids of one match of the pattern. Those that begin with a space share the cache of what follows a space."""
        cache, key = (self.chunks, text[1:]) if text[0] == " " else (self.pieces, text)
        got = cache.get(key)
        if got is None:
            got = self.fresh(text)
            self.keep(cache, key, got)
        return got

    def keep(self, cache: dict[str, tuple[int, ...]], key: str, ids: tuple[int, ...]) -> None:
        if len(key) < 64:
            if len(cache) >= self.most:
                cache.clear()
            cache[key] = ids

    def spaced(self, text: str) -> tuple[int, ...]:
        """The ids of a space and the text after it. Letters alone are one match of the pattern."""
        whole = " " + text
        got = self.fresh(whole) if text.isalpha() else tuple(chain.from_iterable(map(self.piece, self.match(whole))))
        self.keep(self.chunks, text, got)
        return got

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        first, *rest = SPACE.split(text)
        out = list(chain.from_iterable(map(self.piece, self.match(first))))
        got = list(map(self.chunks.get, rest))
        if None in got:
            spaced = self.spaced
            got = [spaced(t) if g is None else g for g, t in zip(got, rest, strict=True)]
        out.extend(chain.from_iterable(got))
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.words.__getitem__, ids))


def with_tokens(docs: DataFrame, codec: Codec, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Adds the ids of each whole text (a null text: those of an empty text) and, if named, the text that they decode to.

    Every row stays, repeated ones too. One pass without a shuffle; the codec (vocabulary and hash) is broadcast, and its
    size is that of the vocabulary file. A column that already has one of the new names is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(codec)
    kept = docs.drop(ids, *([decoded] if decoded else []))
    new = [T.StructField(ids, T.ArrayType(T.IntegerType(), False))] + ([T.StructField(decoded, T.StringType())] if decoded else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                got = [c.encode(t or "") for t in part.column(part.schema.get_field_index(text)).to_pylist()]
                columns = {n: part.column(i) for i, n in enumerate(part.schema.names)} | {ids: pa.array(got, pa.list_(pa.int32()))}
                if decoded:
                    columns[decoded] = pa.array([c.decode(x).decode() for x in got], pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *new]))


def token_digests(docs: DataFrame, codec: Codec, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids and of what they decode to, for each row of docs (doc_id, text).

    A null text counts as empty; a null doc_id stays null; repeated rows stay. Ids and bytes stay inside a task, so the
    result is small however long texts are, unless ``keep_ids`` adds the column ids.
    """
    shared = docs.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        name, digest = c.name_of.__getitem__, hashlib.sha256
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                n, of_ids, of_bytes, kept = [], [], [], []
                for t in part.column(1):
                    ids = c.encode(t.as_py() or "")
                    n.append(len(ids))
                    of_ids.append(digest(b",".join(map(name, ids))).hexdigest())
                    of_bytes.append(digest(c.decode(ids)).hexdigest())
                    if keep_ids:
                        kept.append(np.array(ids, dtype=np.int32))
                columns = {"doc_id": part.column(0).cast(pa.int64()), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(of_ids, pa.string()), "decoded_sha256": pa.array(of_bytes, pa.string())}
                if keep_ids:
                    ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                    columns["ids"] = pa.ListArray.from_arrays(ends, np.concatenate(kept))
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", "text").mapInArrow(run, OUT + (", ids array<int>" if keep_ids else ""))

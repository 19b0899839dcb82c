"""Brown class-based bigrams: P(word | previous) = P(class | previous class) * P(word | class).

Exchange clustering assigns every training word to a class. The most frequent words are exchanged among themselves first,
one after the other. Then all words of a bounded table change classes in sweeps, each by the counts of its neighbours,
which lie in a Spark table; last, each word beyond the table gets the class that suits its own neighbours and
its ending best. Only words that training lacks are placed by their ending alone. Classes of words beyond the table come
to their places in the texts by a join, so transitions and scores see the class of every word.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearmask.llm.common import LOWER_ASCII, discard, materialize, row_numbers

#: classes of words; one more is that of the end of a text alone
CLASSES = 128
END = CLASSES
ALL = CLASSES + 1
#: while words are exchanged, what lies beyond the table is a class of its own
REST, WIDE = CLASSES + 1, CLASSES + 2
HOLE = 255
#: words of the table that travels to all tasks, and those of them that are exchanged first
FREQUENT, SEEDS = 1 << 17, 1024
#: words of the table are dealt to this many buckets, so one holds at most 64 words; neighbours that one row holds
BUCKETS, ROW = 2048, 256
#: sweeps end when one gains less than this share of the likelihood
LEAST_GAIN = 2e-4
ENDINGS = 511
#: what the ending counts against a word's neighbours, for words beyond the table
ENDING_WEIGHT = 10.0
ADD, ADD_PAIR, SMALL = 0.1, 0.5, 0.3


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LOWER_ASCII).split()


def ending(word: bytes) -> int:
    """A bucket of the last letters, without closing marks."""
    return zlib.crc32((word.rstrip(b".,;:?!\"')") or word)[-3:]) % ENDINGS


def word_counts(texts: DataFrame, most: int = 150_000) -> DataFrame:
    """(word, n) over all rows of texts (one column), and a null word with the number of texts. Tasks count first and let
    go of their counts at ``most`` words, in small batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        texts_seen = 0

        def out() -> Iterator[pa.RecordBatch]:
            while seen:
                some = [seen.popitem() for _ in range(min(len(seen), 20_000))]
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.binary()).cast(pa.string()), pa.array([n for _, n in some], pa.int64())], names=["word", "n"])

        for batch in batches:
            texts_seen += batch.num_rows
            for t in batch.column(0):
                seen.update(words_of(t.as_py()))
                if len(seen) >= most:
                    yield from out()
        yield from out()
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), pa.array([texts_seen], pa.int64())], names=["word", "n"])

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(vocabulary: DataFrame, most: int = FREQUENT) -> list[tuple[str, int]]:
    """About ``most`` words at most, by falling count: those from a count on for which they fit, filled up by a hash of
    the word from the counts just below."""
    words = vocabulary.where("word is not null")
    step = F.floor(F.log("n") * 20)
    steps = words.groupBy(step.alias("step")).agg(F.count("*").alias("words")).orderBy(F.desc("step")).collect()  # some hundred rows at most
    left, chosen = most, F.lit(True)
    for s in steps:
        if s.words > left:
            chosen = (step > s.step) | ((step == s.step) & (F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < F.lit(int(left / s.words * (1 << 30)))))
            break
        left -= s.words
    return sorted(((r.word, r.n) for r in words.where(chosen).collect()), key=lambda x: (-x[1], x[0]))


class Table:
    """The frequent words, by falling count: one string of bytes and one of counts when it travels, a dictionary at work."""

    def __init__(self, words: list[str], counts: list[int]):
        self.words, self.counts = "\n".join(words).encode(), np.array(counts, dtype=np.int64)
        self.place: dict[bytes, int] | None = None

    def __len__(self) -> int:
        return len(self.counts)

    def __getstate__(self) -> tuple:
        return self.words, self.counts

    def __setstate__(self, state: tuple) -> None:
        self.words, self.counts = state
        self.place = None

    def places(self) -> dict[bytes, int]:
        if self.place is None:
            self.place = {w: i for i, w in enumerate(self.words.split(b"\n"))} if len(self) else {}
        return self.place

    def endings(self) -> np.ndarray:
        return np.array([ending(w) for w in self.words.split(b"\n")] if len(self) else [], dtype=np.int64)


def planes(values: np.ndarray) -> bytes:
    """Whole numbers below 2 ** 32 as their lowest bytes, then the next, and so on: high bytes are mostly zeros."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unplanes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)

PARTS = "bucket int, side int, steps binary, n binary"
NEIGHBOURS = "word int, side int, other binary, n binary"


def names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def neighbour_counts(texts: DataFrame, words: Table, most: int = 1_000_000) -> DataFrame:
    """(word, side, other, n): the words after (side 0) and before (side 1) each word of the table, as numbers in the
    table, with counts; at most ROW of them a row, the rows of a word one after the other. A word beyond the table counts
    as number ``len(words)``, the end of a text as the next number. Tasks sum up ``most`` places before they let go of
    them; what has to be summed at once is the neighbours of 64 words."""
    shared = texts.sparkSession.sparkContext.broadcast(words)
    size = len(words)
    each = (size // BUCKETS + 1) * (size + 2)  # numbers of one bucket

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value.places()
        held: list[np.ndarray] = []
        n = 0

        def out() -> Iterator[pa.RecordBatch]:
            ids = np.concatenate(held)
            held.clear()
            for side, own, other in ((0, ids[:-1], ids[1:]), (1, ids[1:], ids[:-1])):
                own, other = own[own < size], other[own < size]
                key, count = np.unique((own % BUCKETS) * each + own // BUCKETS * (size + 2) + other, return_counts=True)
                bucket = key // each
                starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
                ends = np.append(starts[1:], len(key))
                for at in range(0, len(starts), 500):
                    blobs = [(planes(np.diff(key[s:e], prepend=bucket[s] * each)), planes(count[s:e])) for s, e in zip(starts[at : at + 500], ends[at : at + 500], strict=True)]
                    numbers = pa.array(bucket[starts[at : at + 500]], pa.int32())
                    yield pa.RecordBatch.from_arrays([numbers, pa.array(np.full(len(numbers), side, dtype=np.int32)), *[pa.array(x, pa.binary()) for x in zip(*blobs, strict=True)]], names=names(PARTS))

        for batch in batches:
            for t in batch.column(0):
                found = words_of(t.as_py())
                # one end before and one after, so neighbouring texts do not meet
                held.append(np.fromiter(itertools.chain([size + 1], map(place.get, found, itertools.repeat(size)), [size + 1]), dtype=np.int64, count=len(found) + 2))
                n += len(held[-1])
                if n >= most:
                    yield from out()
                    n = 0
        if held:
            yield from out()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket: int | None = None
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        waiting = 0

        def add_up() -> tuple[np.ndarray, np.ndarray]:
            nonlocal waiting
            key, at = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.bincount(at, np.concatenate(counts), minlength=len(key)).astype(np.int64)
            keys[:], counts[:], waiting = [key], [n], 0
            return key, n

        def rows() -> Iterator[pa.RecordBatch]:
            key, n = add_up()
            keys.clear()
            counts.clear()
            head, other = np.divmod(key, size + 2)  # word and side, neighbour
            first = np.flatnonzero(np.concatenate([[True], head[1:] != head[:-1]]))
            inside = np.arange(len(head)) - np.repeat(first, np.diff(np.append(first, len(head))))
            start = np.flatnonzero(inside % ROW == 0)
            end = np.append(start, len(head))

            def binary(values: np.ndarray, kind: str) -> pa.Array:
                v = values.astype(kind)
                return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer((end * v.itemsize).astype("<i4")), pa.py_buffer(v)])

            yield pa.RecordBatch.from_arrays([
                pa.array((head[start] // 2 * BUCKETS + bucket).astype(np.int32)), pa.array((head[start] % 2).astype(np.int32)), binary(other, "<i4"), binary(n, "<i8")
            ], names=names(NEIGHBOURS))

        for batch in batches:
            for b, side, steps, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != bucket:
                    if bucket is not None:
                        yield from rows()
                    bucket = b
                own, other = np.divmod(np.cumsum(unplanes(steps)), size + 2)
                keys.append((own * 2 + side) * (size + 2) + other)
                counts.append(unplanes(n))
                waiting += len(keys[-1])
                if waiting > 2_000_000:
                    add_up()
        if bucket is not None:
            yield from rows()

    return texts.mapInArrow(parts, PARTS).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merged, NEIGHBOURS)


def flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(numbers in each row, all numbers) of a column of bytes."""
    size = np.dtype(kind).itemsize
    at = np.frombuffer(column.buffers()[1], dtype="<i4")[column.offset : column.offset + len(column) + 1]
    return np.diff(at) // size, np.frombuffer(column.buffers()[2], dtype=np.uint8)[at[0] : at[-1]].view(kind)


#: labels of the rows in order, and for each entry its row, side (0: after, 1: before), class of the neighbour, and count
Entries = tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def neighbour_entries(batches: Iterator[pa.RecordBatch], place: np.ndarray) -> Iterator[Entries]:
    for batch in batches:
        for part in (batch.slice(i, 4000) for i in range(0, batch.num_rows, 4000)):
            length, other = flat(part.column(2), "<i4")
            row = np.repeat(np.arange(part.num_rows), length)
            yield part.column(0), row, part.column(1).to_numpy()[row], place[other], flat(part.column(3), "<i8")[1]


def class_vectors(entries: Iterator[Entries]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(labels, counts of the classes after, counts of the classes before), each label once; equal labels are in a row."""
    held: tuple[pa.Array, np.ndarray, np.ndarray] | None = None
    for label, row, side, group, n in entries:
        if not len(label):
            continue
        new = np.concatenate([[True], pc.not_equal(label.slice(1), label.slice(0, len(label) - 1)).to_numpy(zero_copy_only=False)])
        at = np.cumsum(new) - 1
        m = int(at[-1]) + 1
        both = np.bincount((at[row] * 2 + side) * WIDE + group, n, minlength=m * 2 * WIDE).reshape(m, 2, WIDE)
        label, after, before = label.filter(pa.array(new)), both[:, 0], both[:, 1]
        if held is not None:
            if held[0][0] == label[0]:
                after[0] += held[1][0]
                before[0] += held[2][0]
            else:
                yield held
        yield label.slice(0, m - 1), after[:-1], before[:-1]
        held = label.slice(m - 1), after[-1:].copy(), before[-1:].copy()
    if held is not None:
        yield held


def summed(rows: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """The sum over all tasks of arrays of ``size`` numbers: at most so many rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = count(batches)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at].astype(np.float64))], names=["at", "n"])

    out = np.zeros(size)
    got = rows.mapInArrow(run, "at long, n double").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out[got["at"].to_numpy(dtype=np.int64)] = got["n"].to_numpy()
    return out


def pair_table(neighbours: DataFrame, place: np.ndarray, wide: int) -> np.ndarray:
    """Counts (wide, wide) of neighbouring groups; ``place`` has the group of each word, then of words beyond the table,
    then of the end. Pairs of two words beyond the table are not counted: they stay what they are wherever words move."""
    shared = neighbours.sparkSession.sparkContext.broadcast(place)

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        of = shared.value.astype(np.int64)
        total = np.zeros(wide * wide)
        for batch in batches:
            length, other = flat(batch.column(2), "<i4")
            n = flat(batch.column(3), "<i8")[1]
            word, side = (np.repeat(batch.column(i).to_numpy(), length) for i in (0, 1))
            after, outside = side == 0, (side == 1) & (other >= len(of) - 2)  # other pairs stand with the word before
            for left, right, some in ((word, other, after), (other, word, outside)):
                total += np.bincount(of[left[some]] * wide + of[right[some]], n[some], minlength=wide * wide)
        return total

    return summed(neighbours, count, wide * wide).reshape(wide, wide)


def f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(table: np.ndarray) -> float:
    return float(f(table).sum() - f(table.sum(axis=0)).sum() - f(table.sum(axis=1)).sum())


def exchange(bigrams: np.ndarray, classes: int, sweeps: int | None = None, least_gain: float = 0.0) -> np.ndarray:
    """The class of each unit. The last unit, the end of a text, keeps the last class to itself.

    Each sweep takes the units by falling count, out of their class and into the one that gives the greatest likelihood;
    it ends when no unit moves, when a sweep gains less than the share ``least_gain`` of the likelihood, or after
    ``sweeps`` where they are given. Each move gains more than rounding can feign, so the end is reached.
    """
    n, own = len(bigrams), classes - 1
    order = np.argsort(-bigrams.sum(axis=1), kind="stable")
    order = order[order != n - 1]
    member = np.zeros(n, dtype=np.int64)
    member[order] = np.arange(len(order)) % own
    member[n - 1] = own
    one = np.zeros((n, classes))
    one[np.arange(n), member] = 1
    big = bigrams.astype(float)
    to, by = big @ one, (one.T @ big).T  # unit -> class, and class -> unit as (unit, class)
    table = one.T @ to
    least = max(1e-9, 1e-12 * float(f(big.sum())))
    for _ in itertools.count() if sweeps is None else range(sweeps):
        moved, before = 0, likelihood(table)
        for u in order:
            a, self_count = member[u], big[u, u]
            r, k = to[u].copy(), by[u].copy()
            r[a] -= self_count
            k[a] -= self_count
            table[a] -= r
            table[:, a] -= k
            table[a, a] -= self_count
            rows, columns = table.sum(axis=1), table.sum(axis=0)
            base = f(table)
            gain_r, gain_k = f(table + r) - base, f(table + k[:, None]) - base
            d = np.arange(classes)
            gain = gain_r.sum(axis=1) - gain_r[d, d] + gain_k.sum(axis=0) - gain_k[d, d] + f(table[d, d] + r + k + self_count) - base[d, d]
            gain -= f(rows + r.sum() + k + self_count) - f(rows) + f(columns + k.sum() + r + self_count) - f(columns)
            # k also lands in the rows and r in the columns of the other classes, the same wherever u goes
            rows_k, columns_r = f(rows + k) - f(rows), f(columns + r) - f(columns)
            gain -= (rows_k.sum() - rows_k) + (columns_r.sum() - columns_r)
            c = int(gain[:own].argmax())
            if gain[c] <= gain[a] + least:
                c = a
            table[c] += r
            table[:, c] += k
            table[c, c] += self_count
            if c != a:
                moved += 1
                member[u] = c
                to[:, a] -= big[:, u]
                to[:, c] += big[:, u]
                by[:, a] -= big[u]
                by[:, c] += big[u]
        if not moved or likelihood(table) - before < least_gain * abs(before):
            break
    return member


def gains(after: np.ndarray, before: np.ndarray, table: np.ndarray) -> np.ndarray:
    """(words, CLASSES): what each class would gain from each word's neighbours, to first order, with smoothed counts."""
    pairs = np.log(table + SMALL)
    rows, columns = (np.log(table.sum(axis=i) + SMALL * WIDE)[:CLASSES] for i in (1, 0))
    return after @ pairs[:CLASSES].T - after.sum(axis=1)[:, None] * rows + before @ pairs[:, :CLASSES] - before.sum(axis=1)[:, None] * columns


def own_gains(after: np.ndarray, before: np.ndarray, own: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The same for the class that each word is in, without the word."""
    a, b = after.sum(axis=1), before.sum(axis=1)
    pairs = (after * np.log(np.maximum(table[own] - after, 0) + SMALL)).sum(axis=1) + (before * np.log(np.maximum(table[:, own].T - before, 0) + SMALL)).sum(axis=1)
    return pairs - a * np.log(np.maximum(table.sum(axis=1)[own] - a, 0) + SMALL * WIDE) - b * np.log(np.maximum(table.sum(axis=0)[own] - b, 0) + SMALL * WIDE)


def moves(neighbours: DataFrame, place: np.ndarray, table: np.ndarray, some: int | None) -> np.ndarray:
    """``place`` after each word (those of parity ``some``, if given) went to the class that gains most from it. One row
    a task's chunk of words reaches the driver, in all a number and a class for each word of the table."""
    shared = neighbours.sparkSession.sparkContext.broadcast((place, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, table = shared.value
        for word, after, before in class_vectors(neighbour_entries(batches, place)):
            if not len(word):
                continue
            word = word.to_numpy()
            gain = gains(after, before, table)
            own = place[word].astype(np.int64)
            old = np.flatnonzero(own < CLASSES)
            stay = np.full(len(word), -np.inf)
            stay[old] = gain[old, own[old]] = own_gains(after[old], before[old], own[old], table)
            best = gain.argmax(axis=1)
            go = gain[np.arange(len(word)), best] > stay + 1e-9
            if some is not None:
                go &= word % 2 == some
            yield pa.RecordBatch.from_arrays([pa.array([word[go].astype("<i4").tobytes()], pa.binary()), pa.array([best[go].astype(np.uint8).tobytes()], pa.binary())], names=["word", "class"])

    out = place.copy()
    for r in neighbours.mapInArrow(run, "word binary, class binary").collect():
        out[np.frombuffer(r["word"], dtype="<i4")] = np.frombuffer(r["class"], dtype=np.uint8)
    return out


def classes_of(neighbours: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The class of each word of the table (then REST and END), and the counts (WIDE, WIDE) of neighbouring classes."""
    seeds = min(size, SEEDS)
    first = np.minimum(np.arange(size + 2), seeds)
    first[-1] = seeds + 1
    pairs = np.delete(np.delete(pair_table(neighbours, first, seeds + 2), seeds, 0), seeds, 1)
    place = np.full(size + 2, REST, dtype=np.uint8)
    place[:seeds], place[-1] = exchange(pairs.astype(np.int64), ALL, least_gain=10 * LEAST_GAIN)[:seeds], END
    table = pair_table(neighbours, place, WIDE)
    best = -np.inf
    for sweep in itertools.count():
        # words that were exchanged wait for the others to join; from then on every second word may move at once
        moved = moves(neighbours, place, table, None if sweep < 2 else sweep % 2)
        if sweep == 0:
            moved[:seeds] = place[:seeds]
        after = pair_table(neighbours, moved, WIDE)
        now = likelihood(after)
        if sweep and now <= best:
            break
        gained, best, place, table = now - best, now, moved, after
        if sweep > 2 and gained < LEAST_GAIN * abs(now):
            break
    return place, table


@dataclass
class ClassModel:
    """What scoring needs besides the counts and classes of words beyond the table, which stay in Spark."""

    table: Table
    tokens: int
    types: int
    ends: int
    place: np.ndarray  # the class of each word of the table
    unseen: np.ndarray = field(default_factory=lambda: np.zeros(ENDINGS, dtype=np.uint8))  # by ending
    transition: np.ndarray = field(default_factory=lambda: np.zeros((ALL, ALL)))  # log10 P(class | class)
    size: np.ndarray = field(default_factory=lambda: np.zeros(ALL))  # log10 of what a class's word counts are divided by

    @property
    def base(self) -> float:
        return float(np.log10(self.tokens + ADD * (self.types + 1)))


SEQUENCES = "__row long, doc_id long, held_out boolean, n_tokens long, known long, log double, classes binary, words array<string>, holes binary, endings binary"


def sequences(docs: DataFrame, model: ClassModel) -> DataFrame:
    """Each text as the classes of its words, a byte each, with holes for words beyond the table: those words, once each,
    which of them fills each hole, and their endings. ``log`` sums log10(count + ADD) of the words without a hole."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, seen = shared.value, [0]
        place, size = m.table.places(), len(m.table)
        group = np.concatenate([m.place[:size], [END, HOLE]]).astype(np.uint8)
        log = np.concatenate([np.log10(np.append(m.table.counts, m.ends) + ADD), [0.0]])
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                out: dict[str, list] = {k: [] for k in names(SEQUENCES)[3:]}
                for t in part.column(1):
                    words = words_of(t.as_py())
                    at = np.fromiter(itertools.chain(map(place.get, words, itertools.repeat(-1)), [size]), dtype=np.int64, count=len(words) + 1)
                    rare = [words[i] for i in np.flatnonzero(at < 0)]
                    number: dict[bytes, int] = {}
                    holes = [number.setdefault(w, len(number)) for w in rare]
                    row = len(at), len(at) - len(rare) - (m.ends == 0), float(log[at].sum()), group[at].tobytes(), [w.decode() for w in number], np.array(holes, dtype="<i4").tobytes(), np.array([ending(w) for w in number], dtype="<i4").tobytes()
                    for k, v in zip(out, row, strict=True):
                        out[k].append(v)
                columns = [pa.array(row_numbers(part.num_rows, seen)), part.column(0).cast(pa.int64()), part.column(2)]
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.list_(pa.string()), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)]], names=names(SEQUENCES))

    return docs.select("doc_id", "text", "held_out").mapInArrow(run, SEQUENCES)


def rare_words(seqs: DataFrame, place: np.ndarray, table: np.ndarray, endings: np.ndarray) -> DataFrame:
    """(word, n, class) of all words beyond the table, from the sequences of the training texts. A word's places shrink to
    counts of pairs of classes before they are shuffled, and its rows stream by; none of these words is frequent."""
    likely = np.zeros((ENDINGS, CLASSES))
    np.add.at(likely, (endings[SEEDS:], place[: len(endings)][SEEDS:]), 1)
    share = likely.sum(axis=0) + 1 / CLASSES
    likely = ENDING_WEIGHT * np.log((likely + share / share.sum()) / (likely.sum(axis=1, keepdims=True) + 1))
    shared = seqs.sparkSession.sparkContext.broadcast((table, likely))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                words, keys, before = [], [], 0
                for c, w, h in zip(*(part.column(i) for i in range(3)), strict=True):
                    if len(w):
                        groups = np.frombuffer(c.as_py(), dtype=np.uint8).astype(np.int64)
                        at = np.flatnonzero(groups == HOLE)
                        groups[at] = REST
                        keys.append(((np.frombuffer(h.as_py(), dtype="<i4") + before) * WIDE + np.where(at > 0, groups[at - 1], END)) * WIDE + groups[at + 1])
                        words.append(w.values)
                        before += len(w)
                if words:
                    key, n = np.unique(np.concatenate(keys), return_counts=True)
                    word = pa.concat_arrays(words).take(pa.array(key // WIDE**2))
                    yield pa.RecordBatch.from_arrays([word, pa.array((key % WIDE**2).astype(np.int32)), pa.array(n)], names=["word", "pair", "n"])

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[Entries]:
        for batch in batches:
            for part in (batch.slice(i, 4000) for i in range(0, batch.num_rows, 4000)):
                pair, n, row = part.column(1).to_numpy(), part.column(2).to_numpy(), np.arange(part.num_rows)
                yield part.column(0), np.tile(row, 2), np.repeat([0, 1], len(row)), np.concatenate([pair % WIDE, pair // WIDE]), np.tile(n, 2)

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, likely = shared.value
        for word, after, before in class_vectors(entries(batches)):
            if len(word):
                last = np.array([ending(w.encode()) for w in word.to_pylist()])
                best = (gains(after, before, table) + likely[last]).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([word, pa.array(after.sum(axis=1).astype(np.int64)), pa.array(best.astype(np.int32))], names=["word", "n", "class"])

    found = seqs.select("classes", "words", "holes").mapInArrow(places, "word string, pair int, n long")
    return found.repartition("word").sortWithinPartitions("word").mapInArrow(classed, "word string, n long, class int")


FILLED = "doc_id long, held_out boolean, n_tokens long, known long, log double, classes binary"


def filled(seqs: DataFrame, rare: DataFrame, unseen: np.ndarray) -> DataFrame:
    """The sequences without holes: words beyond the table are joined to their counts and classes and go back to their
    rows; those that training lacks have count 0 and the class of their ending. A row's own words have to fit a task."""
    shared = seqs.sparkSession.sparkContext.broadcast(unseen)
    asked = seqs.select("__row", F.posexplode("words").alias("i", "word")).join(rare, "word", "left")
    answers = asked.groupBy("__row").agg(F.collect_list(F.struct("i", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("class", F.lit(-1)).alias("class"))).alias("answers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                known, log, groups = part.column(3).to_numpy().copy(), part.column(4).to_numpy().copy(), []
                for r, (c, h, e, a) in enumerate(zip(*(part.column(i) for i in range(5, 9)), strict=True)):
                    own = np.frombuffer(c.as_py(), dtype=np.uint8)
                    if a.is_valid:
                        i, n, k = (a.values.field(x).to_numpy() for x in range(3))
                        count, group = np.empty(len(i)), of[np.frombuffer(e.as_py(), dtype="<i4")]
                        count[i] = n
                        group[i[k >= 0]] = k[k >= 0]
                        holes = np.frombuffer(h.as_py(), dtype="<i4")
                        own = own.copy()
                        own[own == HOLE] = group[holes]
                        known[r] += int((count[holes] > 0).sum())
                        log[r] += float(np.log10(count[holes] + ADD).sum())
                    groups.append(own.tobytes())
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(known), pa.array(log), pa.array(groups, pa.binary())], names=names(FILLED))

    joined = seqs.select("__row", "doc_id", "held_out", "n_tokens", "known", "log", "classes", "holes", "endings").join(answers, "__row", "left").drop("__row")
    return joined.mapInArrow(run, FILLED)


def known_words(rare: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(words of each class, weights (ENDINGS, CLASSES)) over the words beyond the table; rare ones weigh more."""

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(CLASSES + ENDINGS * CLASSES)
        for batch in batches:
            group = batch.column(2).to_numpy()
            total[:CLASSES] += np.bincount(group, minlength=CLASSES)
            at = np.array([ending(w.encode()) for w in batch.column(0).to_pylist()], dtype=np.int64) * CLASSES + group
            total[CLASSES:] += np.bincount(at, 1 / batch.column(1).to_numpy(), minlength=ENDINGS * CLASSES)
        return total

    got = summed(rare, count, CLASSES + ENDINGS * CLASSES)
    return got[:CLASSES], got[CLASSES:].reshape(ENDINGS, CLASSES)


def transitions(full: DataFrame) -> np.ndarray:
    """Counts (ALL, ALL) of neighbouring classes over full sequences; a text stands between two ends."""

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(ALL * ALL)
        for batch in batches:
            for c in batch.column(0):
                g = np.concatenate([[END], np.frombuffer(c.as_py(), dtype=np.uint8)]).astype(np.int64)
                total += np.bincount(g[:-1] * ALL + g[1:], minlength=ALL * ALL)
        return total

    return summed(full.select("classes"), count, ALL * ALL).reshape(ALL, ALL)


def train(docs: DataFrame) -> tuple[ClassModel, DataFrame, DataFrame]:
    """A model of the rows of docs (doc_id, text, held_out) that are not held out (null: they are not), the words beyond
    its table (word, n, class), and the sequences of all rows without holes. A null text is empty.

    Only fixed-size things reach the driver: the table, classes of its words, and tables of classes.
    """
    texts = docs.where(~F.coalesce("held_out", F.lit(False))).select("text")
    vocabulary, path = materialize(word_counts(texts), "vocabulary")
    ends, tokens, types = vocabulary.agg(F.sum(F.when(F.col("word").isNull(), F.col("n"))), F.sum(F.when(F.col("word").isNotNull(), F.col("n"))), F.count("word")).first()
    ends, tokens = ends or 0, tokens or 0
    words = Table(*map(list, zip(*frequent_words(vocabulary), strict=True))) if types else Table([], [])
    discard(docs.sparkSession, path)
    model = ClassModel(words, tokens + ends, types + min(ends, 1), ends, np.zeros(0, dtype=np.uint8))
    if types:
        neighbours, path = materialize(neighbour_counts(texts, words), "neighbours")
        model.place, table = classes_of(neighbours, len(words))
        discard(docs.sparkSession, path)
    else:
        table = np.zeros((WIDE, WIDE))
    seqs, _ = materialize(sequences(docs, model), "sequences")
    rare, _ = materialize(rare_words(seqs.where(~F.coalesce("held_out", F.lit(False))), model.place, table, words.endings()), "rare")
    in_class, by_ending = known_words(rare)
    place = model.place[: len(words)].astype(np.int64)
    in_class += np.bincount(place, minlength=CLASSES)
    np.add.at(by_ending, (words.endings(), place), 1 / words.counts)
    model.unseen = (by_ending + 1e-9 * in_class).argmax(axis=1).astype(np.uint8)  # without such an ending: the largest class
    full, _ = materialize(filled(seqs, rare, model.unseen), "filled")
    pairs = transitions(full.where(~F.coalesce("held_out", F.lit(False))))
    model.transition = np.log10((pairs + ADD_PAIR) / (pairs.sum(axis=1, keepdims=True) + ADD_PAIR * ALL))
    # the end is one known token: nothing unknown shares its class
    model.size = np.log10(np.maximum(pairs.sum(axis=0) + ADD * np.append(in_class + 1, min(ends, 1)), ADD))
    return model, rare, full


def scored(full: DataFrame, model: ClassModel) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity for each row of sequences
    without holes. A null text is the end alone; repeated rows stay."""
    shared = full.sparkSession.sparkContext.broadcast((model.transition, model.size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transition, size = shared.value
        for batch in batches:
            out = []
            for c in batch.column(5):
                g = np.frombuffer(c.as_py(), dtype=np.uint8)
                out.append(float(transition[np.concatenate([[END], g[:-1]]), g].sum() - size[g].sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(out, pa.float64())], names=[*names(FILLED)[:5], "model"])

    got = full.mapInArrow(run, FILLED.replace("classes binary", "model double"))
    score = F.col("log") + F.col("model")
    return got.select(
        "doc_id", "held_out", "n_tokens", F.col("known").alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("log") - F.col("n_tokens") * F.lit(model.base)).alias("base_score"), score.alias("score"), F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )


def scores_of(docs: DataFrame, model: ClassModel, rare: DataFrame) -> DataFrame:
    """``scored`` for other rows (doc_id, text, held_out) than those that the model came from."""
    seqs, _ = materialize(sequences(docs, model), "sequences")
    return scored(filled(seqs, rare, model.unseen), model)

"""Ranked lexical search by a dual-tree walk: the best documents of every item, exactly.

A document is a vector of term impacts, an item a vector of term counts; a score is their product, in 64-bit integers.
Items and documents hang in hierarchies whose nodes hold the maximum of each coordinate below them. For a pair of nodes
the product of the maxima bounds every score below the pair, and where the bound is under the weakest kth score of the
items below, the pair goes, documents and items at once. What is left at the leaves is scored.

Texts are read once for a block of items: their vectors over the block's terms are written, and the search reads those.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearmask.llm.common import materialize, spread, text_bytes, word_pieces

#: bytes of terms (with 16 more each) in one block of items: what is broadcast; an item isn't split
BLOCK_BYTES = 4_000_000
#: distinct terms of a group of items that share a tree (an item of more is a group of its own), numbers in the matrix of a
#: chunk of documents, documents sorted at a time
GROUP_TERMS, MATRIX, BUFFER = 4_096, 4_000_000, 16_384
#: items and nodes of a node, documents of a leaf
FAN, LEAF = 4, 16
#: documents that a first, sampled search looks at for scores to begin pruning with; this changes the speed, never a result
SEED_ROWS = 20_000
NO_ID = np.iinfo(np.int64).max

Vector = tuple[np.ndarray, np.ndarray]


def term_counts(rows: DataFrame, item: str, text: str) -> DataFrame:
    """(item, term, times): the terms of each item. Rows of one id that differ are one item, equal rows count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, t in enumerate(text_bytes(batch.column(1))):
                for words in word_pieces(t):
                    held = Counter(words)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.full(len(held), n))), pa.array(list(held), pa.binary()), pa.array(held.values(), pa.int64())], names=["item", "term", "times"])

    asked = rows.select(F.col(item).alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text")).distinct()
    kind = T.StructType([T.StructField("item", asked.schema["item"].dataType), T.StructField("term", T.BinaryType()), T.StructField("times", T.LongType())])
    return asked.mapInArrow(run, kind).groupBy("item", "term").agg(F.sum("times").alias("times"))


def item_blocks(counts: DataFrame) -> Iterator[list]:
    """The items, dealt by a hash of the id into blocks of about BLOCK_BYTES of terms; one block at a time is collected."""
    size = counts.agg(F.sum(F.length("term") + 16)).first()[0] or 0
    number = -(-size // BLOCK_BYTES)
    for b in range(number):
        block = counts.where(F.pmod(F.xxhash64("item"), F.lit(number)) == b).collect()
        if block:
            yield block


def vectors(docs: DataFrame, key: str, text: str, terms: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every text: its number of terms, and how often it has those of a block."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                sizes, own, times = [], [], []
                for t in text_bytes(part.column(1)):
                    n, held = 0, Counter()
                    for words in word_pieces(t):
                        n += len(words)
                        held.update(filter(known.__contains__, words))
                    sizes.append(n)
                    own.append([known[w] for w in held])
                    times.append(list(held.values()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(own, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "tfs"])

    return spread(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))).mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def joined(nodes: list[Vector]) -> Vector:
    """The maximum of each coordinate of some vectors, each of which has its coordinates in order."""
    places, index = np.unique(np.concatenate([t for t, _ in nodes]), return_inverse=True)
    most = np.zeros(len(places), dtype=np.int64)
    np.maximum.at(most, index, np.concatenate([q for _, q in nodes]))
    return places, most


@dataclass
class Group:
    """Items that share a tree: their numbers, the block's terms that they use, and the levels of the tree over places in
    those terms, items first and the root last."""

    items: np.ndarray
    terms: np.ndarray
    levels: list[list[Vector]]


def groups_of(items: list[Vector], weight: np.ndarray) -> list[Group]:
    """Items with the same heaviest terms stand together, and are cut where they have more than GROUP_TERMS terms."""
    order = sorted(range(len(items)), key=lambda i: [(-int(weight[t]), int(t)) for t in items[i][0][np.argsort(-weight[items[i][0]], kind="stable")[:2]]])
    out: list[Group] = []
    held: list[int] = []
    seen: set[int] = set()

    def close() -> None:
        terms = np.array(sorted(seen), dtype=np.int64)
        levels = [[(np.searchsorted(terms, items[i][0]), items[i][1]) for i in held]]
        while len(levels[-1]) > 1:
            levels.append([joined(levels[-1][j : j + FAN]) for j in range(0, len(levels[-1]), FAN)])
        out.append(Group(np.array(held), terms, levels))

    for i in order:
        own = set(items[i][0].tolist())
        if held and len(seen | own) > GROUP_TERMS:
            close()
            held, seen = [], set()
        held.append(i)
        seen |= own
    if held:
        close()
    return out


@dataclass
class Best:
    """The k best documents found of each item, and the score that the next one has to reach."""

    k: int
    least: np.ndarray
    scores: list[np.ndarray]
    ids: list[np.ndarray]
    scored: int = 0
    bounded: int = 0

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        self.scored += len(scores)
        able = scores >= self.least[item]
        if able.any():
            s, d = np.concatenate([self.scores[item], scores[able]]), np.concatenate([self.ids[item], ids[able]])
            first = np.lexsort((d, -s))[: self.k]
            self.scores[item], self.ids[item] = s[first], d[first]
            if len(first) == self.k:
                self.least[item] = max(self.least[item], s[first[-1]])


@dataclass
class Search:
    """A block of items, prepared once and sent to the tasks."""

    groups: list[Group]
    weight: np.ndarray
    documents: int
    words: int
    k: int
    least: np.ndarray

    def begin(self) -> Best:
        none = np.zeros(0, dtype=np.int64)
        return Best(self.k, self.least.copy(), [none] * len(self.least), [none] * len(self.least))

    def impacts(self, n: list[int], sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> np.ndarray:
        """What each term of each document adds to a score, for one occurrence in an item."""
        m = np.repeat(np.array([75 + 25 * x * self.documents // self.words for x in n], dtype=np.int64), sizes)
        return self.weight[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 12 * m))

    def look(self, best: Best, ids: np.ndarray, n: list[int], sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> None:
        """Searches some documents: their terms and counts stand one document after the other."""
        impacts = self.impacts(n, sizes, terms, tfs)
        row = np.repeat(np.arange(len(ids)), sizes)
        # documents with the same heaviest terms stand together
        by = np.lexsort((terms, -impacts, row))
        firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        heaviest = terms[by[firsts]]
        second = terms[by[np.minimum(firsts + 1, firsts + sizes - 1)]]
        place = np.empty(len(ids), dtype=np.int64)
        order = np.lexsort((second, heaviest))
        place[order] = np.arange(len(ids))
        row = place[row]
        ids = ids[order]
        for group in self.groups:
            where = np.full(len(self.weight), -1, dtype=np.int64)
            where[group.terms] = np.arange(len(group.terms))
            local = where[terms]
            mine = local >= 0
            r, t, x = row[mine], local[mine], impacts[mine]
            step = max(LEAF, MATRIX // len(group.terms) // LEAF * LEAF)
            chunk = r // step
            for c in np.unique(chunk):
                inside = chunk == c
                own = ids[c * step : (c + 1) * step]
                level = np.zeros((-(-len(own) // LEAF) * LEAF, len(group.terms)), dtype=np.int64)
                level[r[inside] - c * step, t[inside]] = x[inside]
                levels = [level]
                while len(levels[-1]) > 1:
                    fan = LEAF if len(levels) == 1 else FAN
                    below = levels[-1]
                    levels.append(np.maximum.reduceat(below, np.arange(0, len(below), fan), axis=0))
                Walk(group, levels, own, best).visit(len(group.levels) - 1, 0, len(levels) - 1, np.zeros(1, dtype=np.int64))


@dataclass
class Walk:
    """One tree of items against one tree of documents, a matrix a level: documents first, the root last."""

    group: Group
    levels: list[np.ndarray]
    ids: np.ndarray
    best: Best

    def weakest(self, a: int, i: int) -> int:
        width = FAN**a
        return self.best.least[self.group.items[i * width : (i + 1) * width]].min()

    def visit(self, a: int, i: int, b: int, nodes: np.ndarray) -> None:
        """Node i of the items' level a against nodes of the documents' level b."""
        terms, times = self.group.levels[a][i]
        bounds = self.levels[b][np.ix_(nodes, terms)] @ times
        self.best.bounded += len(nodes)
        able = bounds >= self.weakest(a, i)
        nodes, bounds = nodes[able], bounds[able]
        if not len(nodes):
            return
        if a and (a >= b or b == 1):
            for child in range(i * FAN, min((i + 1) * FAN, len(self.group.levels[a - 1]))):
                self.visit(a - 1, child, b, nodes)
        elif b > 1:
            self.visit(a, i, b - 1, self.below(b, nodes))
        else:  # an item and leaves: the most promising first, until none can reach the item's weakest score
            item, order = self.group.items[i], np.argsort(-bounds, kind="stable")
            nodes, bounds = nodes[order], bounds[order]
            for at in range(0, len(nodes), FAN):
                if bounds[at] < self.best.least[item]:
                    break
                rows = self.below(b, nodes[at : at + FAN])
                rows = rows[rows < len(self.ids)]
                self.best.add(item, self.levels[0][np.ix_(rows, terms)] @ times, self.ids[rows])

    def below(self, b: int, nodes: np.ndarray) -> np.ndarray:
        fan = LEAF if b == 1 else FAN
        found = (nodes[:, None] * fan + np.arange(fan)).ravel()
        return found[found < len(self.levels[b - 1])]


def candidates(found: DataFrame, search: Search) -> DataFrame:
    """(item number, doc_id, score): at most k documents of each item from each task."""
    shared = found.sparkSession.sparkContext.broadcast(search)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = shared.value
        best = one.begin()
        for batch in joined_batches(batches, BUFFER):
            ids = batch.column(0).fill_null(NO_ID).to_numpy()
            terms, tfs = batch.column(2), batch.column(3)
            one.look(best, ids, batch.column(1).to_pylist(), terms.value_lengths().to_numpy().astype(np.int64), terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy())
        for item, (scores, ids) in enumerate(zip(best.scores, best.ids, strict=True)):
            if len(scores):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), item, dtype=np.int32)), pa.array(ids), pa.array(scores)], names=["item", "doc_id", "score"])

    return found.where(F.size("terms") > 0).mapInArrow(run, "item int, doc_id long, score long")


def joined_batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            if held and sum(x.num_rows for x in held) + part.num_rows > rows:
                yield pa.concat_batches(held)
                held = []
            held.append(part)
    if held and any(x.num_rows for x in held):
        yield pa.concat_batches(held)


def ranked(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def search_block(docs: DataFrame, block: list, k: int, key: str, text: str, item: str, item_type: T.DataType) -> DataFrame:
    """(item, rank, doc_id, score) of the items of one block."""
    spark = docs.sparkSession
    terms = {t: n for n, t in enumerate(sorted({bytes(r["term"]) for r in block}))}
    names: dict = {}
    held: list[tuple[list[int], list[int]]] = []
    for r in block:
        number = names.setdefault(r["item"], len(names))
        if number == len(held):
            held.append(([], []))
        held[number][0].append(terms[bytes(r["term"])])
        held[number][1].append(r["times"])
    found, _ = materialize(vectors(docs, key, text, terms), "vectors")
    rows, documents, words = found.agg(F.count("*"), F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    having = np.zeros(len(terms), dtype=np.int64)
    for t, n in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most a row for each term of the block
        having[t] = n
    weight = np.floor(1000 * np.log((2.0 * documents + 2) / (2.0 * having + 1))).astype(np.int64)
    items = []
    for own, times in held:
        order = np.argsort(own)
        items.append((np.array(own, dtype=np.int64)[order], np.array(times, dtype=np.int64)[order]))
    search = Search(groups_of(items, weight), weight, documents, max(words, 1), k, np.ones(len(items), dtype=np.int64))
    if rows > 2 * SEED_ROWS:
        sample = found.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(rows // SEED_ROWS)) == 0)
        for number, score in ranked(candidates(sample, search), k).where(F.col("rank") == k).select("item", "score").collect():
            search.least[number] = max(search.least[number], score)
    best = ranked(candidates(found, search), k)
    kind = T.StructType([T.StructField("item", T.IntegerType()), T.StructField(item, item_type)])
    named = spark.createDataFrame([(n, i) for i, n in names.items()], kind)
    doc_id = F.when(F.col("doc_id") != int(NO_ID), F.col("doc_id")).alias("doc_id")
    return best.join(F.broadcast(named), "item").select(item, F.col("rank").cast("int").alias("rank"), doc_id, "score")


def best_documents(docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item, rank, doc_id, score): the k documents of the highest scores above 0 of each item, ranks from 1, equal scores
    by ascending doc_id (an integer; null comes last).

    Terms are runs of digits, letters and characters beyond ASCII, A-Z in lower case; null has none. Every row of docs is a
    document, repeated ids included; rows of one item id that differ are one item, equal rows count once; an id may be
    null. Items without a term that some document has aren't in the result; empty tables give no rows. Very long texts are
    taken apart in pieces. Other columns of either table are left out.

    Blocks of items are worked on one after the other. For each, texts are read once and turned into narrow vectors, which
    are written; no vector is shuffled. A task passes on at most k rows of each item.
    """
    counts, _ = materialize(term_counts(items, item, item_text), "items")
    parts: list[DataFrame] = []
    for block in item_blocks(counts):
        part, _ = materialize(search_block(docs, block, k, key, text, item, counts.schema["item"].dataType), "found")
        parts.append(part)
    if not parts:
        kind = T.StructType([T.StructField(item, counts.schema["item"].dataType), *T._parse_datatype_string("rank int, doc_id long, score long").fields])
        return docs.sparkSession.createDataFrame([], kind)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

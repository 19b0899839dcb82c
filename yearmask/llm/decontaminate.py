"""Benchmark decontamination: one Aho-Corasick automaton over the normalised windows of all benchmark items.

Text is normalised to its words, lower-cased and parted by single spaces, and scanned once. What the automaton finds is
mapped back: to words of the text, and to code points of the text as it was.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearmask.llm.common import WORDS, materialize, text_bytes

WORD = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")

#: bytes of windows and item ids in one automaton, which takes some 45 bytes of memory for each; a larger benchmark is
#: scanned for in several passes
BLOCK_BYTES = 4_000_000

HIT = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"
#: a span by its words too: the first, and the one after the last
PLACED = HIT.replace("end:long", "end:long,first:long,last:long")


def normalised(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


def windows(text: bytes, width: int) -> Iterator[bytes]:
    """The item's windows in order, each as its words with a space before, between and after them."""
    words = normalised(text)
    if words:
        for i in range(max(1, len(words) - width + 1)):
            yield b" " + b" ".join(words[i : i + width]) + b" "


def item_windows(benchmark: DataFrame, item: str, text: str, width: int) -> DataFrame:
    """(window, item): the distinct windows of each item. A long item's windows leave its task in small batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in zip(batch.column(0), text_bytes(batch.column(1)), strict=True):
                found = windows(t, width)
                while some := list(set(islice(found, 5_000))):
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary()), pa.array([i.as_py()] * len(some), pa.string())], names=["window", "item"])

    return benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).mapInArrow(run, "window binary, item string").distinct()


class Blocks:
    """The windows of a benchmark, dealt by a hash of window and item into blocks of about BLOCK_BYTES at most, ids
    included: neither a long item nor a window that very many items share can outgrow one. Only one block at a time
    reaches the driver."""

    def __init__(self, benchmark: DataFrame, item: str, text: str, width: int):
        self.pairs, _ = materialize(item_windows(benchmark, item, text, width), "windows")
        size = self.pairs.agg(F.sum(F.length("window") + F.coalesce(F.octet_length("item"), F.lit(0)))).first()[0] or 0
        self.number = -(-size // BLOCK_BYTES)

    def __iter__(self) -> Iterator[dict[bytes, list[str]]]:
        place = F.pmod(F.xxhash64("window", "item"), F.lit(self.number)) if self.number else F.lit(0)
        for b in range(self.number):
            held: dict[bytes, list[str]] = {}
            for r in self.pairs.where(place == b).collect():
                held.setdefault(bytes(r["window"]), []).append(r["item"])
            if held:
                yield held


AUTOMATA: dict[str, ahocorasick.Automaton] = {}


def automaton(shared: Broadcast) -> ahocorasick.Automaton:
    """Built once in a worker process; the windows, not the automaton, are broadcast."""
    key, block = shared.value
    if key not in AUTOMATA:
        AUTOMATA.clear()
        a = ahocorasick.Automaton()
        for w, items in block.items():
            a.add_word(w.decode("latin-1"), (len(w), items))
        a.make_automaton()
        AUTOMATA[key] = a
    return AUTOMATA[key]


def in_order(items: set[str | None]) -> list[str | None]:
    """The ids, sorted; one that is null comes last."""
    return [*sorted(i for i in items if i is not None), *([None] if None in items else [])]


def scan(text: bytes, a: ahocorasick.Automaton, spans: bool) -> tuple[int, int, list[str | None], list[dict]]:
    """(words, hit words, sorted item ids, spans) of one text."""
    words = normalised(text)
    if not words:
        return 0, 0, [], []
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    found: set[str | None] = set()
    runs: list[list[int]] = []
    for end, (size, items) in a.iter(line):
        found.update(items)
        start = end - size + 1
        while runs and start <= runs[-1][0]:  # ends come in order, so a longer window may cover earlier ones
            runs.pop()
        if runs and start <= runs[-1][1]:
            runs[-1][1] = end
        else:
            runs.append([start, end])
    if not runs:
        return len(words), 0, [], []
    hit = sum(line.count(" ", s, e + 1) - 1 for s, e in runs)
    out = []
    if spans:
        places = [m.span() for m in WORD.finditer(text)]
        points = np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)  # code points up to each byte
        for s, e in runs:
            first = line.count(" ", 0, s + 1) - 1
            last = first + line.count(" ", s, e + 1) - 2
            out.append({"start": int(points[places[first][0]]) - 1, "end": int(points[places[last][1] - 1]), "first": first, "last": last + 1})
    return len(words), hit, in_order(found), out


def hit_types(placed: bool) -> dict[str, pa.DataType]:
    span = pa.struct([(x, pa.int64()) for x in (("start", "end", "first", "last") if placed else ("start", "end"))])
    return {"n_words": pa.int64(), "n_hit": pa.int64(), "items": pa.list_(pa.string()), "spans": pa.list_(span)}


def one_pass(docs: DataFrame, block: dict[bytes, list[str]], text: str, spans: bool, placed: bool = False) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, block))
    kept = docs.drop("n_words", "n_hit", "items", "spans")
    types = hit_types(placed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(shared)
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                rows = [scan(t, a, spans) for t in text_bytes(part.column(part.schema.get_field_index(text)))]
                new = [pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True), types.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *types])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *T._parse_datatype_string(PLACED if placed else HIT).fields]))


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", width: int = 10, spans: bool = True) -> DataFrame:
    """Adds n_words, n_hit (words inside any occurrence of a benchmark window), items (sorted ids, as strings, of items
    with such windows) and spans (start and end in code points of the text as it is, joined where windows touch).

    A window is ``width`` consecutive words of an item; an item of fewer words, but not none, is one window. Null or
    wordless texts have no words and no hits; items without words never match; items with a null id are one item, which
    comes last and has no name in a digest. Repeated rows stay, repeated items count once. Columns of the new names are
    replaced, all others stay.

    Windows are made, counted and dealt into blocks in Spark. One block, of bounded bytes, is broadcast, and texts are
    scanned once, without a shuffle. A benchmark past the bound takes one pass a block; what the passes find are narrow rows
    of word and character numbers, which are put together without the texts and joined to the rows by number.
    """
    blocks = Blocks(benchmark, item, item_text, width)
    if blocks.number < 2:
        return one_pass(docs, next(iter(blocks), {b" \n ": []}), text, spans)
    row = "__row"
    while row in docs.columns:
        row += "_"
    kept = docs.drop("n_words", "n_hit", "items", "spans")
    numbered, _ = materialize(kept.withColumn(row, F.monotonically_increasing_id()), "rows")
    texts = numbered.select(F.col(row).alias("row"), F.col(text).alias("text"))
    passes: list[DataFrame] = []
    for block in blocks:
        found = one_pass(texts, block, "text", True, placed=True).drop("text")
        hits, _ = materialize(found if not passes else found.where("n_hit > 0"), "hits")
        passes.append(hits)
    every = passes[0]
    for hits in passes[1:]:
        every = every.unionByName(hits)
    gathered = every.groupBy("row").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("items")).alias("items"), F.array_sort(F.flatten(F.collect_list(F.transform("spans", lambda x: F.struct(x["first"].alias("first"), x["last"].alias("last"), x["start"].alias("start"), x["end"].alias("end")))))).alias("spans")
    )  # a row a text, with no more spans than a text has words for each block
    merged = gathered.mapInArrow(put_together, f"row long, {HIT}").withColumnRenamed("row", row)
    return numbered.join(merged, row).select(*kept.columns, "n_words", "n_hit", "items", "spans")


def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row, n_words, items, spans in order) of several passes: each item once, and spans joined where they touch."""
    types = {"row": pa.int64(), **hit_types(False)}
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            out = []
            for row, n_words, items, spans in zip(*(c.slice(at, 1000).to_pylist() for c in batch.columns), strict=True):
                joined: list[dict] = []
                for s in spans:
                    if joined and s["first"] <= joined[-1]["last"]:
                        if s["last"] > joined[-1]["last"]:
                            joined[-1].update(last=s["last"], end=s["end"])
                    else:
                        joined.append(dict(s))
                out.append((row, n_words, sum(s["last"] - s["first"] for s in joined), in_order(set(items)), [{"start": s["start"], "end": s["end"]} for s in joined]))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*out, strict=True), types.values(), strict=True)], names=list(types))


def items_digest(items: str = "items"):
    """sha256, lowercase hex, of the sorted ids joined by commas."""
    return F.sha2(F.array_join(items, ","), 256)


def brute_force(text: str | None, benchmark: list[tuple[object, str | None]], width: int = 10) -> tuple[int, int, int, str]:
    """The contract by plain search, for tests: (n_words, n_hit, n_items, items_sha256)."""
    words = normalised((text or "").encode())
    hit, items = set(), set()
    for item, t in benchmark:
        own = normalised((t or "").encode())
        size = min(width, len(own))
        grams = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in grams:
                hit.update(range(i, i + size))
                items.add(None if item is None else str(item))
    return len(words), len(hit), len(items), hashlib.sha256(",".join(sorted(i for i in items if i is not None)).encode()).hexdigest()

"""Places in files: line numbers, and the records of WARC and ARC files, over splits of files of any size.

Tasks read splits. What a split can't know (how many lines and bytes stand before it, in which record it begins) is one
small row for each split, and is added afterwards. No file is a row, and of a file that can be split no task reads all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yearmask.functions.hosts import bit, in_window
from yearmask.streaming.evidence import work_folder

#: rows that are broadcast at most: one a split; more are joined like any other table
SMALL = 200_000


def bounded(rows: DataFrame) -> DataFrame:
    """rows, to be broadcast if they are few."""
    return F.broadcast(rows) if rows.limit(SMALL + 1).count() <= SMALL else rows


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """A1: (value, file, line, locator) of text files, lines from 1, locator ``path:line``. Compressed files too.

    Lines are numbered as they are read: a line's place in its split, and the lines of the splits before it. The lines
    themselves aren't shuffled; their splits are counted in a pass of their own, a row for each split.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__split"), F.monotonically_increasing_id().alias("__id"))
    splits = lines.groupBy("file", "__split").agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("file").orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = splits.select("file", "__split", (before - F.col("__first") + 1).alias("__shift"))
    line = (F.col("__id") + F.col("__shift")).alias("line")
    return lines.join(bounded(shift), ["file", "__split"]).select("value", "file", line, F.concat_ws(":", "file", line).alias("locator"))


#: candidates of a part of a split; more are another part
PART_RECORDS = 50_000
#: longer lines are no headers
LONGEST = 1 << 16
BEGINS = r"^WARC/1\.[01]$"
BEGIN_LINE = re.compile(BEGINS)
FIELD = r"(?i)^(?:WARC-Target-URI|WARC-Date|WARC-Type|Content-Length)\s*:.*$"
#: address, IP address, date, type, in version 2 more, and length
ARC = r"^[A-Za-z][A-Za-z0-9+.-]*:\S+ \S+ \d{12,14} \S+ (?:\S+ \S+ \S+ \d+ \S+ )?\d+$"
ARC_LINE = re.compile(ARC)

ROWS = (
    "file string, split long, part int, start long, length long, url string, date string, type string, low int, high int, "
    "bytes long, starts array<long>, lows array<int>, exits array<long>, head array<string>, head_end long, tail array<string>, tail_start long"
)
FOUND = "file string, split long, part int, low int, base long, offset long, length long, url string, date string, type string"


def header(lines: list[str]) -> tuple[int, str | None, str | None, str | None]:
    """(content length, url, date, type) of a record's header lines, the first of which begins it. Without a length the
    record ends with its header, and the next header begins another."""
    if ARC_LINE.match(lines[0]):
        parts = lines[0].split(" ")
        return int(parts[-1]), parts[0], parts[2], "arc"
    known: dict[str, str] = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        known.setdefault(name.strip().lower(), value.strip())
    size = known.get("content-length", "")
    return int(size) if re.fullmatch(r"[0-9]{1,18}", size) else 0, known.get("warc-target-uri", "").strip("<>") or None, known.get("warc-date"), known.get("warc-type")


@dataclass
class Part:
    """What is seen of a split, or of a part of it: candidates for records, in order, and what is open at either end."""

    file: str
    split: int
    part: int
    at: int = 0
    records: list[tuple] = field(default_factory=list)
    open: list[str] | None = None
    open_at: int = 0
    head: list[str] | None = field(default_factory=list)
    head_end: int | None = None

    def line(self, start: int, end: int, text: str) -> None:
        arc = bool(ARC_LINE.match(text))
        if arc or BEGIN_LINE.match(text):
            self.open, self.open_at = [text], start
            if self.head_end is None and self.head is not None:
                self.head = None  # no rest of a header goes over such a line
            if arc:
                self.close(end)
        elif text == "":
            if self.head is not None and self.head_end is None:
                self.head_end = end
            if self.open is not None:
                self.close(end)
        elif self.open is not None:
            self.open.append(text)
        elif self.head is not None and self.head_end is None:
            self.head.append(text)

    def close(self, end: int) -> None:
        size, *more = header(self.open)
        self.records.append((self.open_at, end - self.open_at + size, *more))
        self.open = None

    def rows(self) -> pa.RecordBatch:
        """A row for each candidate and one for the part.

        A candidate's next one is the first that begins at or after its end. That makes a forest; ``low`` and ``high`` are
        numbers such that a record is reached from the one with low number x just if its low <= x < high.
        """
        starts = np.array([r[0] for r in self.records] + ([self.open_at] if self.open is not None else []), dtype=np.int64)
        n = len(starts)
        ends = np.array([r[0] + r[1] for r in self.records] + ([-1] if self.open is not None else []), dtype=np.int64)
        up = np.searchsorted(starts, ends)
        exits = np.maximum(ends - self.at, 0)
        if self.open is not None:
            up[-1], exits[-1] = n, -1
        under, low, free, roots = [1] * n, [0] * n, [0] * n, 0
        for i in range(n):
            if up[i] < n:
                under[up[i]] += under[i]
        for i in range(n - 1, -1, -1):
            p = up[i]
            if p == n:
                low[i], roots = roots, roots + under[i]
            else:
                low[i], free[p] = free[p], free[p] + under[i]
                exits[i] = exits[p]
            free[i] = low[i] + 1
        rows = [dict(zip(("start", "length", "url", "date", "type"), r, strict=True)) | {"low": low[i], "high": low[i] + under[i]} for i, r in enumerate(self.records)]
        rows.append({"bytes": self.at, "starts": starts.tolist(), "lows": low, "exits": exits.tolist(), "head": self.head or [], "head_end": self.head_end, "tail": self.open, "tail_start": self.open_at if self.open is not None else None})
        return pa.RecordBatch.from_pylist([r | {"file": self.file, "split": self.split, "part": self.part} for r in rows], schema=SCHEMA)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


SCHEMA, FOUND_SCHEMA = _arrow(ROWS), _arrow(FOUND)


def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (file, split, bytes with the line's end, text or null) in the order of the file to candidates and parts."""
    now: Part | None = None
    for batch in batches:
        files, splits = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
        code = files.indices.to_numpy()
        cut = np.flatnonzero((np.diff(splits) != 0) | (np.diff(code) != 0)) + 1
        for low, high in zip([0, *cut], [*cut, batch.num_rows], strict=True):
            if low == high:
                continue
            file, split = files.dictionary[int(code[low])].as_py(), int(splits[low])
            if now is None or (now.file, now.split) != (file, split):
                if now is not None:
                    yield now.rows()
                now = Part(file, split, 0)
            ends = np.cumsum(batch.column(2).slice(low, high - low).to_numpy())
            texts = batch.column(3).slice(low, high - low)
            base = now.at
            for i in np.flatnonzero(pc.is_valid(texts).to_numpy(zero_copy_only=False)):
                start, end = base + int(ends[i - 1] if i else 0), base + int(ends[i])
                text = texts[int(i)].as_py()
                if len(now.records) >= PART_RECORDS and now.open is None and (BEGIN_LINE.match(text) or ARC_LINE.match(text)):
                    now.at = start
                    yield now.rows()
                    now = Part(file, split, now.part + 1)
                    base -= start
                    start, end = 0, end - start
                now.line(start, end, text)
            now.at = base + int(ends[-1])
    if now is not None:
        yield now.rows()


def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Goes through the parts of each file in order, from record to record: where each part is entered, and the records
    whose header lies in two parts or more. Of a file only the place of the next record is held."""
    file, pointer, base, pending, pending_at = None, 0, 0, None, 0
    for batch in batches:
        out = []
        for p in batch.to_pylist():
            if p["file"] != file:
                file, pointer, base, pending = p["file"], 0, 0, None
            if pending is not None:
                pending += p["head"]
                if p["head_end"] is not None:
                    size, url, date, kind = header(pending)
                    out.append({"file": file, "offset": pending_at, "length": base + p["head_end"] + size - pending_at, "url": url, "date": date, "type": kind})
                    pointer, pending = p["head_end"] + size, None
                elif p["starts"]:
                    pending, pointer = None, 0
            if pending is None:
                i = int(np.searchsorted(np.array(p["starts"], dtype=np.int64), pointer)) if pointer < p["bytes"] else len(p["starts"])
                if i < len(p["starts"]):
                    out.append({"file": file, "split": p["split"], "part": p["part"], "low": p["lows"][i], "base": base})
                    pointer = p["exits"][i]
                    if pointer < 0:
                        pending, pending_at = p["tail"], base + p["tail_start"]
                else:
                    pointer = max(pointer - p["bytes"], 0)
            base += p["bytes"]
        yield pa.RecordBatch.from_pylist(out, schema=FOUND_SCHEMA)


def read_archive_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, length, type, url, date) of the records of WARC/1.0, WARC/1.1 and ARC files, plain or gzipped
    (a member a record or not). Offsets are those of the plain bytes; length is header and content.

    Records are framed by their lengths, so content that quotes headers makes no record. After a damaged record the next
    header at or after its end counts; a record without a length ends with its header, a header that the file cuts off is
    none. Empty files have no records. Plain files are read in splits: each finds what may be a record and which other it
    leads to, a pass over one small row for each split goes from record to record, and a join keeps what it reaches.
    """
    v = F.regexp_replace("value", "\r$", "")
    short = F.octet_length("value") < LONGEST
    told = F.when(short & (v == ""), "").when(short & (v.rlike(BEGINS) | v.rlike(FIELD) | v.rlike(ARC)), v)
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), (F.octet_length("value") + 1).cast("long").alias("bytes"), told.alias("text"))
    folder = work_folder(spark, "records")
    lines.mapInArrow(seen, ROWS).write.parquet(folder)
    rows = spark.read.schema(ROWS).parquet(folder)
    parts = rows.where("bytes is not null").select("file", "split", "part", "bytes", "starts", "lows", "exits", "head", "head_end", "tail", "tail_start")
    walked = work_folder(spark, "entries")
    parts.repartition("file").sortWithinPartitions("file", "split", "part").mapInArrow(follow, FOUND).write.parquet(walked)
    entries = spark.read.schema(FOUND).parquet(walked)
    reached = entries.where("low is not null").select("file", "split", "part", F.col("low").alias("entry"), F.col("base").alias("base"))
    whole = rows.where("bytes is null").drop("bytes", "starts", "lows", "exits", "head", "head_end", "tail", "tail_start")
    whole = whole.join(bounded(reached), ["file", "split", "part"]).where("low <= entry and entry < high").withColumn("offset", F.col("base") + F.col("start"))
    columns = ["file", "offset", "length", "type", "url", "date"]
    return whole.select(columns).unionByName(entries.where("low is null").select(columns))


def read_warc_headers(spark: SparkSession, path: str) -> DataFrame:
    """Target URI of each record, and its capture year as a hint. Direct masks are always 0; records without a target
    are left out."""
    year = in_window(F.substring("date", 1, 4).try_cast("int"))
    return read_archive_records(spark, path).where("url is not null").select("url", year.alias("year"), bit(year).alias("hint_mask"), F.lit(0).alias("direct_mask"))

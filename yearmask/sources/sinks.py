"""Sinks and manifests."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearmask.functions.hosts import bit


def write_annual(host_years: DataFrame, path: str) -> None:
    """One ordered host list a year under ``year=<year>``; ranges keep a large year in several files."""
    rows = host_years.select("year", F.col("host").alias("value")).distinct()
    rows.repartitionByRange("year", "value").sortWithinPartitions("year", "value").write.partitionBy("year").text(path)


def evidence_rows(captures: DataFrame) -> DataFrame:
    """The proof of each host-year that goes into the lists: host, year and the columns of its first capture by ``seq``
    (source_id, provider, kind, lane)."""
    first = captures.groupBy("host", "year").agg(F.min_by(F.struct("source_id", "provider", "kind", "lane"), "seq").alias("p"), F.min("seq").alias("seq"))
    return first.select("host", "year", "seq", "p.*")


def write_submission(captures: DataFrame, path: str) -> DataFrame:
    """The annual lists under ``lists``, beside them ``evidence`` (a row for each line of the lists, in files by year)
    and ``lanes`` (host-years of each year and lane); returns the lanes. Proofs are chosen once, written, and lists and
    counts are made of what was written."""
    spark = captures.sparkSession
    rows = evidence_rows(captures)
    rows.repartitionByRange("year", "host").sortWithinPartitions("year", "host").write.partitionBy("year").parquet(f"{path}/evidence")
    kept = spark.read.schema(rows.schema).parquet(f"{path}/evidence")
    write_annual(kept, f"{path}/lists")
    lanes = kept.groupBy("year", "lane").agg(F.count("*").alias("host_years"))
    lanes.write.parquet(f"{path}/lanes")
    return lanes


def audit_submission(spark: SparkSession, path: str, masks: DataFrame) -> DataFrame:
    """J21, J22 over what was written: a row a year with its lines, evidence rows, lines without evidence, evidence without
    a line, host-years that ``masks`` (host, year_mask) doesn't allow, lines that don't follow the one before, and whether
    the lanes sum up to the lines."""
    lists = spark.read.text(f"{path}/lists").select(F.col("year").cast("int").alias("year"), F.col("value").alias("host"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    evidence = spark.read.parquet(f"{path}/evidence").select(F.col("year").cast("int").alias("year"), "host", F.lit(True).alias("proven"))
    both = lists.withColumn("listed", F.lit(True)).join(evidence, ["year", "host"], "full_outer").join(masks.select("host", "year_mask"), "host", "left")
    allowed = F.coalesce(F.col("year_mask").bitwiseAND(bit(F.col("year"))) != 0, F.lit(False))
    counts = both.groupBy("year").agg(
        F.count("listed").alias("lines"), F.count("proven").alias("evidence_rows"), F.count_if(F.col("listed").isNotNull() & F.col("proven").isNull()).alias("unproven"),
        F.count_if(F.col("listed").isNull()).alias("unlisted"), F.count_if(F.col("listed").isNotNull() & ~allowed).alias("not_allowed"),
    )
    # files hold ranges in order, so a file's lines are compared with one another, and the files by their first and last
    edges = lists.groupBy("year", "file").agg(F.min("host").alias("low"), F.max("host").alias("high"), F.min_by("host", "at").alias("first"), F.max_by("host", "at").alias("last"), F.count("*").alias("n"), F.countDistinct("host").alias("d"))
    wrong = edges.groupBy("year").agg(F.count_if((F.col("low") != F.col("first")) | (F.col("high") != F.col("last")) | (F.col("n") != F.col("d"))).alias("files_out_of_order"))
    lanes = spark.read.parquet(f"{path}/lanes").groupBy("year").agg(F.sum("host_years").alias("in_lanes"))
    out = counts.join(wrong, "year", "left").join(lanes, "year", "left")
    return out.withColumn("sound", (F.col("lines") == F.col("in_lanes")) & (F.col("unproven") + F.col("unlisted") + F.col("not_allowed") + F.col("files_out_of_order") == 0)).drop("in_lanes")


def write_candidates(split: DataFrame, path: str) -> None:
    """The hosts of each bucket (active, reference, excluded, unparsed) under ``bucket=<bucket>``."""
    split.select("bucket", F.col("host").alias("value")).distinct().write.partitionBy("bucket").text(path)


def write_outcomes(outcomes: DataFrame, path: str) -> None:
    """One JSON object a source."""
    outcomes.write.json(path)


#: endings of files that are unpacked when they are read as lines: their bytes come whole
PACKED = r"\.(?:gz|bz2|lz4|snappy|zst|deflate)$"


def lines_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, length, sha256) of files whose lines (path, size, bytes) come one file after the other, in order. Only the state
    of one hash is held; the size says whether the last line has an end."""
    path, size, seen, state = None, 0, 0, None

    def row() -> pa.RecordBatch:
        if seen == size:
            state.update(b"\n")
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()), pa.array([state.hexdigest()])], names=["path", "length", "sha256"])

    for batch in batches:
        names = batch.column(0).dictionary_encode()
        cuts = np.flatnonzero(np.diff(names.indices.to_numpy())) + 1
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if low == high:
                continue
            own, lines = batch.column(0)[int(low)].as_py(), batch.column(2).slice(low, high - low).to_pylist()
            if own != path:
                if state is not None:
                    yield row()
                path, size, seen, state = own, batch.column(1)[int(low)].as_py(), 0, hashlib.sha256()
            elif seen:
                state.update(b"\n")
            body = b"\n".join(lines)
            state.update(body)
            seen += len(body) + 1
    if state is not None:
        yield row()


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and sha256 of files of any size, a task for each file.

    SHA-256 takes a file's bytes in order, so a file isn't split, but it streams through the hash line by line and is never
    a row; only a line has to fit one. Packed files are rows, which limits them to 2 GB each. Empty files count too.
    """
    files = list_files(spark, path)
    rows = spark.createDataFrame([(p, 0, hashlib.sha256().hexdigest()) for p, n in files if n == 0], "path string, length long, sha256 string")
    packed = [p for p, n in files if n and re.search(PACKED, p)]
    plain = [p for p, n in files if n and not re.search(PACKED, p)]
    if packed:
        rows = rows.unionByName(spark.read.format("binaryFile").load(packed).select("path", "length", F.sha2("content", 256).alias("sha256")))
    if plain:
        apart = spark.newSession()  # its splits are whole files, the caller's stay as they are
        for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
            apart.conf.set(key, str(1 << 40))
        apart.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 26))  # long lines make small batches
        lines = apart.read.option("lineSep", "\n").text(plain).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"), F.col("value").cast("binary").alias("value"))
        rows = lines.mapInArrow(lines_digest, "path string, length long, sha256 string").unionByName(rows)
    return rows


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, size) of the files that a pattern names, or that lie in folders that it names; hidden ones aside."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for s in files.globStatus(where) or []:
        for f in files.listStatus(s.getPath()) if s.isDirectory() else [s]:
            if f.isFile() and not f.getPath().getName().startswith(("_", ".")):
                found.append((f.getPath().toString(), f.getLen()))
    return found


def digest(files: DataFrame) -> DataFrame:
    """One digest over (path, sha256) in order: the identity of a set of inputs. A manifest has a row a file."""
    rows = F.array_sort(F.collect_list(F.concat_ws("\t", "path", "sha256")))
    return files.agg(F.sha2(F.array_join(rows, "\n"), 256).alias("digest"), F.count("*").alias("files"))


def select_listing(listing: DataFrame, most_bytes: int, most_files: int) -> DataFrame:
    """The smallest files of a listing (path, length) within a size bound."""
    return listing.where(F.col("length").between(1, most_bytes)).orderBy("length", "path").limit(most_files)

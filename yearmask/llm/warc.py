"""WARC fixity: Merkle trees over the records and ordered offset ranges of archives.

A leaf is a record, hashed with its offset and length. A node covers a range of offsets and is the hash of its children
in order; ranges widen by a factor from level to level, up to one root an archive. Two replicas are compared at the
roots, and only the branches that differ are descended, down to the records.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearmask.llm.common import carried, materialize

#: bytes of a lowest range, and how many ranges of a level make one of the next
RANGE, FAN = 1 << 15, 16


def records_of(pages: DataFrame, per_archive: int = 256) -> DataFrame:
    """(archive, record_id, length, sha256, record): each page as one WARC resource record, dealt to archives.

    Archives hold ``per_archive`` consecutive page ids, so their size is bounded; pages with a null id are dealt out by a
    hash over archives with negative numbers. Null urls and contents count as empty; repeated rows are repeated records.
    """
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    name = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), name, F.lit(">\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"))
    archive = F.coalesce(F.floor(F.col("page_id") / per_archive).cast("long"), (-1 - F.pmod(F.xxhash64(url, html), F.lit(4096))).cast("long"))
    made = pages.select(archive.alias("archive"), F.col("page_id").alias("record_id"), F.concat(head, html, F.lit("\r\n\r\n")).alias("record"))
    return made.select("archive", "record_id", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("sha256"), "record")


def laid_out(records: DataFrame, *more: str, by: str = "sha256") -> DataFrame:
    """(archive, record_id, offset, length, sha256, more): where each record begins in its archive.

    Records are ordered by id, then by digest, or by another column that says how they were written; equal ones as they
    were read. Only these narrow rows are shuffled: the records' bytes are hashed where they are read. An archive of very many
    records, as repeated or null ids make it, is laid out in ranges (``carried``), never in one task.
    """
    narrow, _ = materialize(records.select("archive", "record_id", "length", "sha256", *more), "records")
    return carried(narrow, [F.col("record_id"), F.col(by)], "archive", "length", "offset")


def leaves(records: DataFrame) -> DataFrame:
    """(archive, level, node, hash): level 0, one leaf a record, its node the offset. A record that lies at the offset of
    another (repeated rows of a replica's listing) is hashed with it."""
    own = records.select("archive", F.col("offset").alias("node"), F.sha2(F.concat_ws(":", F.lit("leaf"), "offset", "length", "sha256"), 256).alias("hash"))
    words = [F.conv(F.substring("hash", at, 15), 16, 10).cast("decimal(20,0)") for at in (1, 16, 31, 46)]
    # sums of a digest's parts: the same in any order, added up before the shuffle, and never a list
    sums = own.groupBy("archive", "node").agg(F.count("*").alias("n"), *[F.sum(w).alias(f"w{i}") for i, w in enumerate(words)])
    return sums.select("archive", F.lit(0).alias("level"), "node", F.sha2(F.concat_ws(":", "n", "w0", "w1", "w2", "w3"), 256).alias("hash"))


def grow(level: DataFrame, n: int) -> DataFrame:
    """Level n from level n - 1: a node is hashed over its children (place and hash) in the order of their offsets. A
    node of the lowest range holds the records that begin in RANGE bytes; any other has FAN children at most."""
    node = F.floor(F.col("node") / (RANGE if n == 1 else FAN)).cast("long")
    inside = F.array_sort(F.collect_list(F.struct("node", "hash")))
    return level.groupBy("archive", node.alias("up")).agg(F.sha2(F.array_join(F.transform(inside, lambda x: F.concat_ws(":", x.node, x.hash)), ";"), 256).alias("h")).select("archive", F.lit(n).alias("level"), F.col("up").alias("node"), F.col("h").alias("hash"))


def tree(records: DataFrame, levels: int) -> list[DataFrame]:
    """The levels of all archives' trees, leaves first; the last has node 0 alone, the root."""
    out = [leaves(records)]
    for n in range(1, levels):
        out.append(grow(out[-1], n))
    stored, _ = materialize(reduce(DataFrame.unionByName, out), "tree")
    return [stored.where(F.col("level") == n) for n in range(levels)]


def levels_for(size: int) -> int:
    """Levels, leaves and root included, for archives of up to ``size`` bytes."""
    n, ranges = 2, max(1, -(-size // RANGE))
    while ranges > 1:
        ranges, n = -(-ranges // FAN), n + 1
    return n


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """The records that differ between the listings (archive, offset, length, sha256, record_id) of two replicas: archive,
    offset, record_id, length, status (``corrupt``, ``missing`` from the replica, or ``extra`` in it) and both digests.

    Roots are compared first; the children of nodes that differ, or that one side lacks, are compared next, so equal
    branches are never visited below the point where they are known to be equal. Empty inputs give no rows.
    """
    most = max((df.agg(F.max(F.col("offset") + F.col("length"))).first()[0] or 0) for df in (primary, replica))
    levels = levels_for(most)
    left, right = tree(primary, levels), tree(replica, levels)
    differing = None
    for n in range(levels - 1, -1, -1):
        a, b = left[n].select("archive", "node", F.col("hash").alias("ha")), right[n].select("archive", "node", F.col("hash").alias("hb"))
        if differing is not None:
            up = F.floor(F.col("node") / (RANGE if n == 0 else FAN)).cast("long")
            a, b = (x.withColumn("up", up).join(differing, ["archive", "up"], "left_semi").drop("up") for x in (a, b))
        found = a.join(b, ["archive", "node"], "full_outer").where(~F.col("ha").eqNullSafe(F.col("hb"))).select("archive", F.col("node").alias("up"))
        differing, _ = materialize(found, "differing")  # what a level leaves is small; the next level starts from it
    at = differing.select("archive", F.col("up").alias("offset"))
    p = primary.join(at, ["archive", "offset"], "left_semi").groupBy("archive", "offset").agg(F.min("record_id").alias("id_a"), F.max("length").alias("len_a"), F.min("sha256").alias("sha256"))
    r = replica.join(at, ["archive", "offset"], "left_semi").groupBy("archive", "offset").agg(F.min("record_id").alias("id_b"), F.max("length").alias("len_b"), F.min("sha256").alias("replica_sha256"))
    both = p.join(r, ["archive", "offset"], "full_outer")
    status = F.when(F.col("replica_sha256").isNull(), "missing").when(F.col("sha256").isNull(), "extra").otherwise("corrupt")
    return both.select("archive", "offset", F.coalesce("id_a", "id_b").alias("record_id"), F.coalesce("len_a", "len_b").alias("length"), status.alias("status"), "sha256", "replica_sha256")


def damaged_digest() -> Column:
    """The digest of a record (record_id, record, sha256) in a replica with known faults, for audits of the audit: records
    of ids 13 modulo 97 have their last content byte changed, those of 7 modulo 193 are lost (null); null ids are sound."""
    hurt = F.concat(F.substring(F.col("record"), F.lit(1), F.length("record") - 5), F.lit("#\r\n\r\n"))
    lost = F.coalesce(F.pmod("record_id", F.lit(193)) == 7, F.lit(False))
    return F.when(~lost, F.when(F.pmod("record_id", F.lit(97)) == 13, F.sha2(hurt, 256)).otherwise(F.col("sha256")))


def damaged_records(records: DataFrame) -> DataFrame:
    """The records of a replica with the faults of ``damaged_digest``: (archive, record_id, length, sha256, record,
    written, lost). Lengths and digests are those of the replica's own bytes; ``written`` is the digest of the bytes as
    they were written, by which they were laid out, and ``lost`` marks records whose place in the archive is a hole."""
    body = F.col("record")
    hurt = F.concat(F.substring(body, F.lit(1), F.length(body) - 5), F.lit("#\r\n\r\n"))
    bytes_now = F.when(F.pmod("record_id", F.lit(97)) == 13, hurt).otherwise(body)
    lost = F.coalesce(F.pmod("record_id", F.lit(193)) == 7, F.lit(False))
    changed = records.select("archive", "record_id", bytes_now.alias("record"), F.sha2("record", 256).alias("written"), lost.alias("lost"))
    return changed.select("archive", "record_id", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("sha256"), "record", "written", "lost")

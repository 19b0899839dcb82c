"""A baseline index that stays: one row a host, bucketed and sorted by host, written once and probed often."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearmask.functions.hosts import bit
from yearmask.streaming.evidence import shared_root

def input_digest(spark: SparkSession, *paths: str) -> str:
    """What tells one state of some input files from another: names, sizes and times of change. Only listings are read."""
    jvm, seen = spark._jvm, []
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        files = where.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(where, True)
        while files.hasNext():
            f = files.next()
            seen.append(f"{f.getPath().toString()}|{f.getLen()}|{f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()[:24]


@dataclass(frozen=True)
class BaselineIndex:
    """A table of (host, year_mask, is_candidate) in ``buckets`` buckets by host, under a name that the input's digest is
    part of. A host is there once, whether it is known for years, a candidate, or both."""

    spark: SparkSession
    table: str
    path: str
    buckets: int

    @staticmethod
    def named(spark: SparkSession, digest: str, root: str | None = None, buckets: int | None = None) -> BaselineIndex:
        """The index of an input with this digest, in the shared folder, whether it is written yet or not."""
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        name = f"baseline_{digest}_{buckets}"
        return BaselineIndex(spark, name, f"{root or shared_root(spark)}/index/{name}", buckets)

    def written(self) -> bool:
        done = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_SUCCESS")
        return done.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(done)

    def build(self, host_years: DataFrame, candidates: DataFrame) -> BaselineIndex:
        """Writes the index of known (host, year) rows and of candidates (host), if it isn't written yet. Both are
        aggregated in one pass; a bucket is one file, sorted by host. Null hosts are left out. A build that was cut off
        leaves no index and is done again."""
        if not self.written():
            known = host_years.select("host", bit(F.col("year")).alias("year_mask"), F.lit(False).alias("is_candidate"))
            rows = known.unionByName(candidates.select("host", F.lit(0).alias("year_mask"), F.lit(True).alias("is_candidate"))).where("host is not null")
            merged = rows.groupBy("host").agg(F.bit_or("year_mask").alias("year_mask"), F.bool_or("is_candidate").alias("is_candidate"))
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
            merged.repartition(self.buckets, "host").write.mode("overwrite").option("path", self.path).bucketBy(self.buckets, "host").sortBy("host").saveAsTable(self.table)
        return self

    def rows(self) -> DataFrame:
        """The index as a bucketed table; a session that hasn't built it attaches the files that another wrote."""
        if not self.spark.catalog.tableExists(self.table):
            self.spark.sql(f"CREATE TABLE {self.table} (host STRING, year_mask INT, is_candidate BOOLEAN) USING parquet CLUSTERED BY (host) SORTED BY (host) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        return self.spark.table(self.table)

    def resolve(self, hosts: DataFrame) -> DataFrame:
        """Adds the baseline mask (0 if none) and whether a host is a candidate. The hosts asked for are dealt to the
        buckets, each of which is read once and neither shuffled nor sorted; hosts of a bucket are held while it is read."""
        index = self.rows().withColumnRenamed("year_mask", "baseline_mask")
        out = hosts.hint("shuffle_hash").join(index, "host", "left")
        return out.withColumns({"baseline_mask": F.coalesce("baseline_mask", F.lit(0)), "is_candidate": F.coalesce("is_candidate", F.lit(False))})

    def lookup(self, *hosts: str) -> DataFrame:
        """The rows of a few hosts: only their buckets are opened, and in these the row groups whose range has them."""
        return self.rows().where(F.col("host").isin(*hosts))

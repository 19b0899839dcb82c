"""A10, A11 for delimited files: which character parts the cells, whether there is a header, and which columns hold hosts
and times, by all lines of each file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearmask.functions.hosts import host_of, strip, year_of

DELIMITERS = (",", "\t", ";", "|")
#: fixed values: names of columns that say host, and of times that say when a capture was made
HOST_NAMES = ("hostname", "host", "domain", "url", "original", "original_url", "uri")
CAPTURE_TIME_NAMES = ("timestamp", "capture_timestamp", "capture_time", "capture_year", "warc_date", "crawl_date")


def cells(line: Column, delimiter: str) -> Column:
    """The cells of a line, bare. A cell in double quotes may hold delimiters, and doubled quotes for one."""
    pattern = f'(?:^|[{delimiter}])(\\s*"(?:[^"]|"")*"\\s*(?=[{delimiter}]|$)|[^{delimiter}]*)'

    def bare(x: Column) -> Column:
        inner = F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
        return strip(F.when(x.startswith('"') & x.endswith('"') & (F.length(x) > 1), inner).otherwise(x))

    return F.transform(F.regexp_extract_all(line, F.lit(pattern), 1), lambda x: bare(strip(x)))


def parted(line: Column, delimiter: Column) -> Column:
    """The cells of a line by its file's delimiter."""
    return reduce(lambda found, d: F.when(delimiter == d, cells(line, d)).otherwise(found), DELIMITERS, F.lit(None).cast("array<string>"))


def delimiters(lines: DataFrame, key: str = "file") -> DataFrame:
    """(key, delimiter): the one that parts most lines of a file into the same number of cells, two at least; of equals the
    one with most cells, then the first of comma, tab, semicolon and bar. Files without any are left out."""
    kinds = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(d).alias("delimiter"), F.size(cells(F.col("value"), d)).alias("n")) for i, d in enumerate(DELIMITERS)])
    each = lines.where(strip(F.col("value")) != "").select(key, F.explode(F.filter(kinds, lambda x: x.n > 1)).alias("x"))
    counts = each.groupBy(key, "x.place", "x.delimiter", "x.n").agg(F.count("*").alias("lines"))
    return counts.groupBy(key).agg(F.max_by("delimiter", F.struct("lines", "n", -F.col("place"))).alias("delimiter"))


def infer_columns(lines: DataFrame, key: str = "file", least: int = 3, share: float = 0.9) -> DataFrame:
    """(key, delimiter, has_header, host_column, time_column, records, matched, confidence, says_capture) of delimited files.

    lines: (key, line from 1, value). Rows without cells are passed over. A file's first row is its header if no two of
    its cells are a host and a time and there are more than ``least`` rows. Host and time column are the pair that most
    rows have; they are null where two pairs are equally good, or where fewer than ``least`` rows or less than ``share`` of
    them have the pair. ``says_capture``: the header names both columns so that the time is that of a capture. Every line
    counts, and pairs are counted before they are shuffled, so one large file is no single task.
    """
    rows = lines.where(strip(F.col("value")) != "").join(delimiters(lines, key), key).withColumn("c", parted(F.col("value"), F.col("delimiter")))
    hosts = F.filter(F.transform("c", lambda x, i: F.when(host_of(x).isNotNull(), i)), lambda i: i.isNotNull())
    times = F.filter(F.transform("c", lambda x, i: F.when(year_of(x).isNotNull(), i)), lambda i: i.isNotNull())
    pairs = F.flatten(F.transform(hosts, lambda h: F.transform(F.filter(times, lambda t: t != h), lambda t: F.struct(h.alias("h"), t.alias("t")))))
    told = rows.select(key, "line", "delimiter", F.transform("c", F.lower).alias("names"), pairs.alias("pairs"))
    totals = told.groupBy(key, "delimiter").agg(F.count("*").alias("n"), F.min_by(F.struct("line", "names", (F.size("pairs") == 0).alias("blank")), "line").alias("first"))
    files = totals.select(key, "delimiter", ((F.col("n") > least) & F.col("first.blank")).alias("has_header"), F.col("n"), F.col("first.names").alias("names"))
    counts = told.select(key, F.explode("pairs").alias("p")).groupBy(key, "p").agg(F.count("*").alias("matched"))
    by = Window.partitionBy(key).orderBy(F.desc("matched"), "p")
    best = counts.withColumns({"r": F.row_number().over(by), "next": F.lead("matched").over(by)}).where("r = 1")
    out = files.join(best.select(key, "p", "matched", F.coalesce(F.col("next") == F.col("matched"), F.lit(False)).alias("tied")), key, "left")
    records = F.col("n") - F.col("has_header").cast("int")
    good = (F.col("matched") >= least) & (F.col("matched") >= share * records) & ~F.col("tied")
    host, time = F.when(good, F.col("p.h")), F.when(good, F.col("p.t"))
    named = F.when(F.col("has_header"), F.get("names", host).isin(*HOST_NAMES) & F.get("names", time).isin(*CAPTURE_TIME_NAMES))
    return out.select(
        key, "delimiter", "has_header", host.alias("host_column"), time.alias("time_column"), records.alias("records"), F.coalesce("matched", F.lit(0)).alias("matched"),
        (F.coalesce("matched", F.lit(0)) / records).alias("confidence"), F.coalesce(named, F.lit(False)).alias("says_capture"),
    )


def infer_host_column(lines: DataFrame, key: str = "file", least: int = 3, share: float = 0.9) -> DataFrame:
    """A11 for delimited files: (key, delimiter, host_column): the column that holds a host in ``share`` of the rows, header
    aside; null if none or two are equally good."""
    rows = lines.where(strip(F.col("value")) != "").join(delimiters(lines, key), key).withColumn("c", parted(F.col("value"), F.col("delimiter")))
    told = rows.select(key, "line", "delimiter", F.filter(F.transform("c", lambda x, i: F.when(host_of(x).isNotNull(), i)), lambda i: i.isNotNull()).alias("hosts"))
    totals = told.groupBy(key, "delimiter").agg(F.count("*").alias("n"), F.min_by(F.size("hosts") == 0, "line").alias("blank"))
    counts = told.select(key, F.explode("hosts").alias("h")).groupBy(key, "h").agg(F.count("*").alias("matched"))
    by = Window.partitionBy(key).orderBy(F.desc("matched"), "h")
    best = counts.withColumns({"r": F.row_number().over(by), "next": F.lead("matched").over(by)}).where("r = 1")
    records = F.col("n") - (F.col("blank") & (F.col("n") > least)).cast("int")
    good = (F.col("matched") >= least) & (F.col("matched") >= share * records) & ~F.coalesce(F.col("next") == F.col("matched"), F.lit(False))
    return totals.join(best, key, "left").select(key, "delimiter", F.when(good, F.col("h")).alias("host_column"))

"""Scans: DataFrames of text lines to typed source records. Nothing here needs Python on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yearmask.functions.hosts import bit, host_of, in_window, normalize_host, strip, year_of


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A1: (value, file) of text files. Line numbers are not asked for: they would order every file in one task."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))


def ok_status(status: Column) -> Column:
    return F.substring(status, 1, 1).isin("2", "3")


def read_cdx(lines: DataFrame) -> DataFrame:
    """A3: year, timestamp, url and direct_mask of CDX rows: three fields at least, a year in the window, a URL with
    ``://``, and a 2xx or 3xx status if there is one."""
    f = F.split(strip(F.col("value")), r"\s+")
    rows = lines.withColumn("f", f).where(F.size("f") >= 3)
    rows = rows.withColumns({"timestamp": F.col("f")[1], "url": F.col("f")[2]}).where(F.col("timestamp").rlike(r"^\d{4}") & F.col("url").contains("://"))
    rows = rows.withColumn("year", in_window(F.substring("timestamp", 1, 4).cast("int"))).where(F.col("year").isNotNull())
    rows = rows.where((F.size("f") < 5) | ok_status(F.get("f", F.lit(4))))
    return rows.select("year", "timestamp", "url", bit(F.col("year")).alias("direct_mask"))


def read_cdxj(lines: DataFrame, years: tuple[int, ...] | None = None) -> DataFrame:
    """A4, A5: rows ``key timestamp {json}`` with a URL and no status but 2xx or 3xx. Years off the window stay, with
    mask 0, unless ``years`` names those allowed."""
    f = F.split(F.regexp_replace("value", r"[\r\n]+\z", ""), " ", 3)
    rows = lines.withColumn("f", f).where((F.size("f") == 3) & F.get("f", F.lit(1)).rlike(r"^\d{4}"))
    rows = rows.withColumns({"timestamp": F.col("f")[1], "url": strip(F.get_json_object(F.col("f")[2], "$.url")), "status": strip(F.get_json_object(F.col("f")[2], "$.status"))})
    rows = rows.where((F.col("url") != "") & (F.col("status").isNull() | ok_status(F.col("status")))).withColumn("year", F.substring("timestamp", 1, 4).cast("int"))
    if years is not None:
        rows = rows.where(F.col("year").isin(*years))
    return rows.select("year", "timestamp", "url", bit(F.col("year")).alias("direct_mask"))


#: fixed values: fields of JSON records that hold a host, and a time, in order of preference
HOST_FIELDS = ("hostname", "host", "domain", "url", "original", "original_url", "uri")
TIME_FIELDS = ("year", "source_year", "capture_year", "timestamp", "date", "warc_date", "crawl_date")


def read_jsonl(lines: DataFrame, host_field: str | None = None, time_field: str | None = None) -> DataFrame:
    """Host and year of JSON records: from the bound fields, else from the first usual ones that hold them."""
    fields = F.transform_keys(F.from_json("value", "map<string,string>"), lambda k, _: F.lower(strip(k)))
    rows = lines.withColumn("m", fields).where(F.col("m").isNotNull())
    hosts = ([host_field.lower()] if host_field else []) + list(HOST_FIELDS)
    times = ([time_field.lower()] if time_field else []) + list(TIME_FIELDS)
    rows = rows.withColumns({"host": F.coalesce(*[host_of(F.col("m")[k]) for k in hosts]), "year": F.coalesce(*[year_of(F.col("m")[k]) for k in times])})
    return rows.where(F.col("host").isNotNull()).select("host", "year")


def read_delimited(lines: DataFrame, delimiter: str = ",", host_column: int | None = None, year_column: int | None = None) -> DataFrame:
    """Host and year of delimited rows: of the bound columns, else of the first cells that hold one. A cell in double
    quotes may hold delimiters, and doubled quotes for one; a quote that is not closed on its line is an ordinary one."""
    cell = f'(?:^|[{delimiter}])(\\s*"(?:[^"]|"")*"\\s*(?=[{delimiter}]|$)|[^{delimiter}]*)'
    quoted = F.regexp_extract_all("value", F.lit(cell), 1)
    plain = F.transform(quoted, lambda x: F.when(strip(x).rlike('^".*"$') & (F.length(strip(x)) > 1), F.replace(F.substring(strip(x), F.lit(2), F.length(strip(x)) - 2), F.lit('""'), F.lit('"'))).otherwise(x))
    cells = F.transform(plain, strip)
    rows = lines.withColumn("c", cells)
    host = host_of(F.get("c", F.lit(host_column))) if host_column is not None else F.get(F.filter(F.transform("c", host_of), lambda x: x.isNotNull()), F.lit(0))
    year = year_of(F.get("c", F.lit(year_column))) if year_column is not None else F.get(F.filter(F.transform("c", year_of), lambda x: x.isNotNull()), F.lit(0))
    return rows.withColumns({"host": host, "year": year}).where(F.col("host").isNotNull()).select("host", "year")


URL_PATTERN = r"https?://[^\s<>\"']+"


def clean_urls(text: Column) -> Column:
    """The distinct HTTP URLs of a text in order, without closing punctuation."""
    urls = F.transform(F.regexp_extract_all(text, F.lit(f"(?i)({URL_PATTERN})"), 1), lambda u: F.regexp_replace(u, r"[.,;:!?)\]}>]+\z", ""))
    return F.array_distinct(F.filter(urls, lambda u: u.rlike(r"(?i)^https?://(?:[^/?#@]*@)?[^/?#:]+")))


def read_squid(lines: DataFrame) -> DataFrame:
    """URL and access year of proxy log rows: an epoch time in the window, and the first field that is a URL."""
    f = F.split(strip(F.col("value")), r"\s+")
    stamp = F.get("f", F.lit(0)).try_cast("double")
    rows = lines.withColumn("f", f).withColumn("year", in_window(F.year(F.timestamp_seconds(stamp)))).where((stamp >= 0) & F.col("year").isNotNull())
    field = F.get(F.filter(F.slice("f", F.lit(2), F.greatest(F.size("f"), F.lit(1))), lambda x: x.startswith("http://") | x.startswith("https://")), F.lit(0))
    return rows.withColumn("url", F.get(clean_urls(field), F.lit(0))).where(F.col("url").isNotNull()).select("url", "year")


def read_directory_dump(lines: DataFrame) -> DataFrame:
    """The URL of each ``ExternalPage about="..."`` row, entities resolved."""
    raw = F.regexp_extract("value", r"<ExternalPage\s+about=\"([^\"]+)\"", 1)
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        raw = F.replace(raw, F.lit(entity), F.lit(char))
    return lines.select(strip(raw).alias("url")).where(F.col("url").rlike(r"(?i)^https?://[^/?#:]+"))


def first(urls: Column, most: int | None) -> Column:
    return urls if most is None else F.slice(urls, 1, most)


def read_mail_urls(lines: DataFrame, most: int | None = None) -> DataFrame:
    """The URLs of each row, the first ``most`` if a bound is given, and nothing else of it."""
    return lines.select(F.explode(first(clean_urls(F.col("value")), most)).alias("url"))


def read_reference_list(lines: DataFrame) -> DataFrame:
    """Host and year of lists whose file name has the year."""
    return lines.select(normalize_host(F.col("value")).alias("host"), in_window(F.regexp_extract("file", r"(\d{4})[^/\d]*\z", 1).try_cast("int")).alias("year")).where("host is not null")


def window_years(source_id: Column) -> Column:
    """The target years of a source named after two years, ``..._1997_1998``."""
    a, b = (F.regexp_extract(source_id, r"(\d{4})_(\d{4})", i).try_cast("int") for i in (1, 2))
    return F.coalesce(F.when(a <= b, F.array_intersect(F.sequence(a, b), F.sequence(F.lit(1996), F.lit(2001)))), F.array().cast("array<int>"))


def accepted_years(rows: DataFrame, host: str, low: str, high: str) -> DataFrame:
    """Rows (key columns, host, original, timestamp, status) of response tables that prove a year of their request:
    the exact host, a year in the asked range, 2xx or 3xx."""
    year = year_of(F.col("timestamp"))
    return rows.withColumn("year", year).where((host_of(F.col("original")) == F.col(host)) & year.between(F.col(low), F.col(high)) & ok_status(F.col("status")))


def registration_years(responses: DataFrame) -> DataFrame:
    """Domain and year of the earliest registration event in (domain, payload), where the year is in the window."""
    events = F.from_json(F.get_json_object("payload", "$.events"), "array<struct<eventAction:string,eventDate:string>>")
    dates = F.transform(F.filter(events, lambda e: F.lower(e.eventAction) == "registration"), lambda e: e.eventDate)
    return responses.withColumn("date", F.array_min(dates)).withColumn("year", year_of(F.col("date"))).where("year is not null").select("domain", "year", "date")


def read_mailbox(spark: SparkSession, path: str) -> DataFrame:
    """(value, file) of the messages of mbox files: each begins after a line ``From ...``, which goes; a blank line or
    the start of the file stands before that line, and ``>From`` in a text is no such line. Files are split between tasks
    at those lines, never read whole."""
    cut = spark.read.option("lineSep", "\n\nFrom ").text(path).select("value", F.col("_metadata.file_path").alias("file"))
    envelope = F.regexp_replace("value", r"^(?:From )?[^\n]*(?:\n|\z)", "")
    return cut.select(envelope.alias("value"), "file").where("value <> ''")


def sniff(lines: DataFrame, key: str = "file", least: int = 3, share: float = 0.6, host_share: float = 0.5) -> DataFrame:
    """The format of each file by its lines, all of them, and the share of them that have it: the first of squid, cdxj,
    cdx, jsonl, delimited that ``least`` lines and ``share`` of them have, else lines if ``host_share`` of them are hosts,
    else null. A file whose lines begin WARC records, or an ARC file, is warc_arc."""
    v = strip(F.col("value"))
    is_format = {
        "squid": v.rlike(r"^\d{9,10}\.\d{3}\s+\d+\s+\S+\s+\S+/\d{3}\s"),
        "cdxj": v.rlike(r"^\S+ \d{4,14} \{"),
        "cdx": v.rlike(r"^\S+ \d{4,14} \S*://"),
        "jsonl": v.rlike(r"^\{.*\}\z"),
        "delimited": v.rlike(r"^[^,;|\t]+[,;|\t][^,;|\t]+"),
        "lines": host_of(v).isNotNull(),
    }
    record = v.rlike(r"^WARC/\d|^filedesc://")
    counts = lines.where(v != "").groupBy(key).agg(F.count("*").alias("n"), F.count_if(record).alias("records"), *[F.count_if(c).alias(k) for k, c in is_format.items()])
    name, part = F.lit(None).cast("string"), F.lit(None).cast("double")
    for k in reversed(is_format):
        good = (F.col(k) >= least) & (F.col(k) >= (host_share if k == "lines" else share) * F.col("n"))
        name, part = F.when(good, k).otherwise(name), F.when(good, F.col(k) / F.col("n")).otherwise(part)
    return counts.select(key, F.when(F.col("records") > 0, "warc_arc").otherwise(name).alias("format"), F.when(F.col("records") > 0, 1.0).otherwise(part).alias("confidence"))


#: fixed values: formats that a file's ending says, and that a content type says
NAMED = (
    ("warc_arc", (".warc", ".warc.gz", ".arc", ".arc.gz")), ("cdxj", (".cdxj", ".cdxj.gz")), ("cdx", (".cdx", ".cdx.gz")), ("jsonl", (".jsonl", ".jsonl.gz", ".ndjson", ".ndjson.gz")),
    ("delimited", (".csv", ".csv.gz", ".tsv", ".tsv.gz")), ("lines", (".txt", ".txt.gz", ".list", ".list.gz", ".urls", ".urls.gz")),
)
MEDIA = (
    ("warc_arc", ("application/warc", "application/x-warc", "application/arc", "application/x-arc")), ("jsonl", ("application/x-ndjson", "application/ndjson")),
    ("delimited", ("text/csv", "text/tab-separated-values")),
)


def named_format(path: Column) -> Column:
    """The format that the ending of a path or address says, else null."""
    bare = F.lower(F.regexp_extract(path, "^[^?#]*", 0))
    return F.coalesce(*[F.when(F.greatest(*[bare.endswith(e) for e in ends]), name) for name, ends in NAMED])


def media_format(media: Column) -> Column:
    """The format that a content type says, whatever its parameters, else null."""
    bare = F.lower(strip(F.substring_index(media, ";", 1)))
    return F.coalesce(*[F.when(bare.isin(*types), name) for name, types in MEDIA])


def detect(lines: DataFrame, files: DataFrame, key: str = "file") -> DataFrame:
    """(file, format, method, confidence) of files (file, path, media): by name, else by content type, else by their
    lines (file, value), which are only counted where the others say nothing; nulls where nothing is found."""
    told = files.withColumn("__name", named_format(F.col("path"))).withColumn("__type", media_format(F.col("media")))
    unknown = told.where("__name is null and __type is null").select(key)
    seen = sniff(lines.join(unknown, key, "left_semi"), key).select(key, F.col("format").alias("__seen"), F.col("confidence").alias("__share"))
    out = told.join(seen, key, "left")
    method = F.when(F.col("__name").isNotNull(), "locator").when(F.col("__type").isNotNull(), "content_type").when(F.col("__seen").isNotNull(), "content_signature")
    sure = F.when(F.col("__name").isNotNull(), 1.0).when(F.col("__type").isNotNull(), 0.96).otherwise(F.col("__share"))
    return out.select(key, F.coalesce("__name", "__type", "__seen").alias("format"), method.alias("method"), sure.alias("confidence"))


def infer_fields(lines: DataFrame, key: str = "file", least: int = 3, share: float = 0.9) -> DataFrame:
    """The host field of each file of JSON records, and its time field: of the fields that hold one in ``least``
    rows and in ``share`` of all rows, the one with most; none if two are equally good."""
    rows = lines.withColumn("m", F.from_json("value", "map<string,string>")).where("m is not null")
    cells = rows.select(key, F.explode("m").alias("field", "cell"))
    total = rows.groupBy(key).agg(F.count("*").alias("n"))
    counts = cells.groupBy(key, "field").agg(F.count_if(host_of(F.col("cell")).isNotNull()).alias("hosts"), F.count_if(year_of(F.col("cell")).isNotNull()).alias("times"))

    def best(kind: str) -> DataFrame:
        good = counts.join(total, key).where((F.col(kind) >= least) & (F.col(kind) >= share * F.col("n")))
        top = good.groupBy(key).agg(F.max(kind).alias("top"))
        return good.join(top, key).where(F.col(kind) == F.col("top")).groupBy(key).agg(F.when(F.count("*") == 1, F.max("field")).alias(f"{kind[:-1]}_field"))

    return total.select(key).join(best("hosts"), key, "left").join(best("times"), key, "left")

"""Scan queries: text lines made from the given tables, read back by the scans, and the scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearmask.functions import hosts as H
from yearmask.operators import scouting as C
from yearmask.operators import search as Q
from yearmask.operators import value as A
from yearmask.operators.eed import growth
from yearmask.plans import derived as D
from yearmask.plans.analytics import cells
from yearmask.plans.registry import query
from yearmask.sources import framing as R
from yearmask.sources import lines as L
from yearmask.sources import mail
from yearmask.sources import schema as S
from yearmask.sources import sinks
from yearmask.streaming.evidence import work_folder

_HOST_OF_URL = "regexp_extract(url, '^https?://([^/?#:]+)', 1)"
_STAMP = "strftime(ts, '%Y%m%d%H%M%S')"


def _stamp() -> F.Column:
    return F.date_format("ts", "yyyyMMddHHmmss")


def _status() -> F.Column:
    return F.element_at(F.array(*map(F.lit, ("200", "301", "404", "500"))), (F.col("seq") % 4 + 1).cast("int"))


@query("a3_cdx_scan", f"""
WITH {D.CAPTURES} SELECT year, {_STAMP} AS timestamp, concat('http://', trim(raw), '/') AS url, CAST(1 << (year - 1996) AS INT) AS direct_mask FROM captures WHERE year BETWEEN 1996 AND 2001 AND seq % 4 < 2""")
def a3_cdx_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A1, A3: captures written as CDX rows and scanned."""
    value = F.concat_ws(" ", F.lit("key"), _stamp(), F.concat(F.lit("http://"), F.trim("raw"), F.lit("/")), F.lit("text/html"), _status(), F.lit("DIGEST 120 0 f.warc"))
    return L.read_cdx(D.captures(spark, sf).select(value.alias("value")))


@query("a4_cdxj_scan", f"""
WITH {D.CAPTURES} SELECT year, {_STAMP} AS timestamp, concat('http://', trim(raw), '/') AS url, CAST(CASE WHEN year BETWEEN 1996 AND 2001 THEN 1 << (year - 1996) ELSE 0 END AS INT) AS direct_mask FROM captures WHERE seq % 4 < 2""")
def a4_cdxj_scan(spark: SparkSession, sf: str) -> DataFrame:
    body = F.to_json(F.struct(F.concat(F.lit("http://"), F.trim("raw"), F.lit("/")).alias("url"), _status().alias("status")))
    return L.read_cdxj(D.captures(spark, sf).select(F.concat_ws(" ", F.lit("key"), _stamp(), body).alias("value")))


@query("a5_cdxj_years", f"WITH {D.CAPTURES} SELECT year, count(*) AS n FROM captures WHERE seq % 4 < 2 AND year IN (1997, 1999) GROUP BY year")
def a5_cdxj_years(spark: SparkSession, sf: str) -> DataFrame:
    body = F.to_json(F.struct(F.concat(F.lit("http://"), F.trim("raw"), F.lit("/")).alias("url"), _status().alias("status")))
    rows = D.captures(spark, sf).select(F.concat_ws(" ", F.lit("key"), _stamp(), body).alias("value"))
    return L.read_cdxj(rows, years=(1997, 1999)).groupBy("year").agg(F.count("*").alias("n"))


@query("a6_jsonl_scan", f"""
WITH {D.CAPTURES} SELECT host, CASE WHEN year BETWEEN 1996 AND 2001 THEN year END AS year FROM captures WHERE host IS NOT NULL""")
def a6_jsonl_scan(spark: SparkSession, sf: str) -> DataFrame:
    record = F.struct(F.col("seq").alias("Id"), F.col("raw").alias("Host"), F.date_format("ts", "yyyy-MM-dd").alias("Date"))
    return L.read_jsonl(D.captures(spark, sf).select(F.to_json(record).alias("value")))


@query("a7_delimited_scan", f"WITH {D.CAPTURES} SELECT host, CASE WHEN year BETWEEN 1996 AND 2001 THEN year END AS year FROM captures WHERE host IS NOT NULL")
def a7_delimited_scan(spark: SparkSession, sf: str) -> DataFrame:
    value = F.concat_ws(";", F.lit("x"), "raw", F.date_format("ts", "yyyy-MM-dd"), F.lit("zz"))
    return L.read_delimited(D.captures(spark, sf).select(value.alias("value")), delimiter=";")


@query("a8_squid_scan", f"""
WITH {D.CAPTURES} SELECT concat('http://', trim(raw), '/a') AS url, year FROM captures WHERE year BETWEEN 1996 AND 2001""")
def a8_squid_scan(spark: SparkSession, sf: str) -> DataFrame:
    value = F.concat(F.unix_timestamp("ts"), F.lit(".123 87 10.0.0.1 TCP_MISS/200 512 GET http://"), F.trim("raw"), F.lit("/a - DIRECT/x text/html"))
    return L.read_squid(D.captures(spark, sf).select(value.alias("value")))


@query("a9_format_sniffing", """
SELECT CAST(r_regionkey AS INT) AS file, ['cdx', 'cdxj', 'jsonl', 'delimited', 'lines'][r_regionkey + 1] AS format, 1.0 AS confidence FROM region""")
def a9_format_sniffing(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written in five formats, one a region, are told apart."""
    nation = D.table(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("file"))
    customer = D.table(spark, sf, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    url = F.concat(F.lit("http://c"), "c_custkey", F.lit(".example.com/"))
    forms = [F.concat(F.lit("k 19980102000000 "), url, F.lit(" text/html 200")), F.concat(F.lit("k 19980102000000 "), F.to_json(F.struct(url.alias("url")))), F.to_json(F.struct(url.alias("url"))), F.concat(F.lit("c"), "c_custkey", F.lit(",1998,x")), F.concat(F.lit("c"), "c_custkey", F.lit(".example.com"))]
    return L.sniff(customer.select("file", F.element_at(F.array(*forms), F.col("file") + 1).alias("value")))


@query("a10_field_inference", """
SELECT CAST(r_regionkey AS INT) AS file, CASE WHEN r_regionkey = 4 THEN NULL ELSE 'site' END AS host_field, 'seen' AS time_field FROM region""")
def a10_field_inference(spark: SparkSession, sf: str) -> DataFrame:
    """Which fields of JSON records hold hosts and times; two equally good host fields are none."""
    nation = D.table(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("file"))
    customer = D.table(spark, sf, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    site = F.concat(F.lit("c"), "c_custkey", F.lit(".example.com"))
    record = F.struct(site.alias("site"), F.when(F.col("file") == 4, site).alias("mirror"), F.lit("1999-05-06").alias("seen"), F.col("c_acctbal").cast("string").alias("balance"))
    return L.infer_fields(customer.select("file", F.to_json(record).alias("value")))


@query("a10_delimited_inference", """
SELECT CAST(r_regionkey AS INT) AS file, [',', chr(9), ';', '|', ','][r_regionkey + 1] AS delimiter, r_regionkey % 2 = 0 AS has_header, CASE WHEN r_regionkey < 4 THEN 1 END AS host_column, CASE WHEN r_regionkey < 4 THEN 3 END AS time_column, r_regionkey = 0 AS says_capture, n AS records
FROM region JOIN (SELECT n_regionkey, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey) ON n_regionkey = r_regionkey""")
def a10_delimited_inference(spark: SparkSession, sf: str) -> DataFrame:
    """A10: the delimiter, header, host and time column of customers written as five files: quoted CSV, TSV, with semicolons,
    with bars, and one with two host columns."""
    nation = D.table(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("file"))
    rows = D.table(spark, sf, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    site, f = F.concat(F.lit("c"), "c_custkey", F.lit(".example.com")), F.col("file")
    d = F.element_at(F.array(*map(F.lit, S.DELIMITERS), F.lit(",")), f + 1)
    quoted = F.concat(F.lit('"'), F.replace(F.col("c_name"), F.lit("#"), F.lit(", ")), F.lit('"'))
    body = F.concat_ws("\x00", quoted, F.concat(F.lit("http://"), site, F.lit("/")), F.col("c_acctbal").cast("string"), F.lit("1999-05-06"), F.when(f == 4, site).otherwise("x"))
    head = F.concat_ws("\x00", F.lit("name"), F.when(f == 0, "url").otherwise("site"), F.lit("balance"), F.when(f == 0, "Timestamp").otherwise("seen"), F.lit("rest"))
    lines = rows.select("file", (F.col("c_custkey") + 2).alias("line"), F.replace(body, F.lit("\x00"), d).alias("value"))
    heads = nation.select("file").distinct().where("file % 2 = 0").select("file", F.lit(1).cast("long").alias("line"), F.replace(head, F.lit("\x00"), d).alias("value"))
    return S.infer_columns(lines.unionByName(heads)).select("file", "delimiter", "has_header", "host_column", "time_column", "says_capture", "records")


@query("a11_delimited_hosts", """
SELECT CAST(r_regionkey AS INT) AS file, [',', chr(9), ';', '|', ','][r_regionkey + 1] AS delimiter, CASE WHEN r_regionkey <> 2 THEN 2 END AS host_column FROM region""")
def a11_delimited_hosts(spark: SparkSession, sf: str) -> DataFrame:
    """The host column of delimited files without headers; none where two are equally good."""
    nation = D.table(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("file"))
    rows = D.table(spark, sf, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    site, f = F.concat(F.lit("c"), "c_custkey", F.lit(".example.com")), F.col("file")
    d = F.element_at(F.array(*map(F.lit, S.DELIMITERS), F.lit(",")), f + 1)
    value = F.replace(F.concat_ws("\x00", F.when(f == 2, site).otherwise("x"), F.col("c_acctbal").cast("string"), site), F.lit("\x00"), d)
    return S.infer_host_column(rows.select("file", F.col("c_custkey").alias("line"), value.alias("value")))


@query("a12_directory_dump", """
SELECT url FROM pages WHERE page_id % 3 <> 0""")
def a12_directory_dump(spark: SparkSession, sf: str) -> DataFrame:
    safe = F.replace(F.col("url"), F.lit("&"), F.lit("&amp;"))
    row = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('<link r:resource="'), safe, F.lit('"/>'))).otherwise(F.concat(F.lit('  <ExternalPage about="'), safe, F.lit('">')))
    return L.read_directory_dump(D.table(spark, sf, "pages").select(row.alias("value")))


@query("a13_mail_urls", """
SELECT url, count(*) AS n FROM (SELECT url FROM pages UNION ALL SELECT concat('http://other.example/', page_id) FROM pages) GROUP BY url""")
def a13_mail_urls(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.lit("See <"), "url", F.lit("> and "), F.lit("http://other.example/"), "page_id", F.lit(". Again <"), "url", F.lit(">, please"))
    return L.read_mail_urls(D.table(spark, sf, "pages").select(text.alias("value"))).groupBy("url").agg(F.count("*").alias("n"))


@query("a14_mailbox_messages", """
SELECT CAST(1996 + page_id % 6 AS INT) AS year, url FROM pages WHERE page_id % 4 <> 0""")
def a14_mailbox_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Messages with exactly one Date header, in the window, out of mailbox files that hold all of them: plain ones,
    nested ones with an attachment, and quoted-printable ones."""
    date = F.concat(F.lit("Date: Mon, 5 May "), (F.col("page_id") % 6 + 1996).cast("string"), F.lit(" 10:00:00 +0000\n"))
    plain = F.concat(F.lit("Subject: x\n\n>From here look <"), "url", F.lit("> now\n"))
    encoded = F.base64(F.concat(F.lit("see <"), "url", F.lit(">")).cast("binary"))
    attached = F.lit("--in\nContent-Type: text/plain\nContent-Disposition: attachment; filename=x.txt\n\nhttp://attached.example/\n--in--\n")
    nested = F.concat(
        F.lit("MIME-Version: 1.0\nContent-Type: multipart/mixed; boundary=out\n\n--out\nContent-Type: multipart/alternative; boundary=in\n\n--in\nContent-Type: text/html; charset=iso-8859-1\nContent-Transfer-Encoding: base64\n\n"),
        encoded, F.lit("\n"), attached, F.lit("--out--\n"),
    )
    quoted = F.concat(F.lit("MIME-Version: 1.0\nContent-Type: text/plain\nContent-Transfer-Encoding: quoted-printable\n\n=3C"), F.replace(F.replace(F.col("url"), F.lit("="), F.lit("=3D")), F.lit("/"), F.lit("=2F=\n")), F.lit("=3E\n"))
    form = F.col("page_id") % 3
    text = F.concat(F.lit("From a@b Mon May 5\n"), date, F.when(F.col("page_id") % 4 == 0, date).otherwise(""), F.when(form == 0, plain).when(form == 1, nested).otherwise(quoted))
    path = work_folder(spark, "mailbox")
    D.table(spark, sf, "pages").select(text.alias("value")).write.option("lineSep", "\n").text(path)
    return mail.mail_messages(L.read_mailbox(spark, path))


@query("a15_warc_headers", "SELECT url, CASE WHEN page_id % 8 < 6 THEN CAST(1996 + page_id % 8 AS INT) END AS year, CAST(CASE WHEN page_id % 8 < 6 THEN 1 << (page_id % 8)::INT ELSE 0 END AS INT) AS hint_mask, CAST(0 AS INT) AS direct_mask FROM pages")
def a15_warc_headers(spark: SparkSession, sf: str) -> DataFrame:
    """The headers of the records of WARC/1.0, WARC/1.1 (gzipped) and ARC files, contents of which quote headers."""
    path = _archives(spark, sf)
    return R.read_warc_headers(spark, f"{path}/*")


def _archives(spark: SparkSession, sf: str) -> str:
    """Pages as archive files: those of odd ids as WARC/1.0, of ids 0 modulo 4 as ARC, and 2 modulo 4 as WARC/1.1."""
    year, k = (F.col("page_id") % 8 + 1996).cast("string"), F.col("page_id")
    quoted = F.lit("WARC/1.0\r\nWARC-Target-URI: http://quoted.example/\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nhttp://quoted.example/ 10.0.0.1 19990101000000 text/html 3\nabc\n")
    body = F.concat(F.when(k % 5 == 0, quoted).otherwise(F.lit("")), F.coalesce("html", F.lit("")))
    length = F.octet_length(body).cast("string")

    def warc(version: str) -> F.Column:
        return F.concat(F.lit(f"WARC/{version}\r\nWARC-Type: response\r\nWARC-Target-URI: "), "url", F.lit("\r\nWARC-Date: "), year, F.lit("-03-04T05:06:07Z\r\nContent-Length: "), length, F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))

    arc = F.concat("url", F.lit(" 10.0.0.1 "), year, F.lit("0304050607 text/html "), length, F.lit("\n"), body)
    path, pages = work_folder(spark, "archives"), D.table(spark, sf, "pages")
    for name, rows, record, form in (("warc", k % 2 == 1, warc("1.0"), "none"), ("arc", k % 4 == 0, arc, "none"), ("members", k % 4 == 2, warc("1.1"), "gzip")):
        pages.where(rows).select(record.alias("value")).write.option("compression", form).text(f"{path}/{name}")
    return path


@query("a16_reference_list", f"WITH {D.CAPTURES} SELECT host, CASE WHEN year BETWEEN 1996 AND 2001 THEN year END AS year FROM captures WHERE host IS NOT NULL")
def a16_reference_list(spark: SparkSession, sf: str) -> DataFrame:
    return L.read_reference_list(D.captures(spark, sf).select(F.col("raw").alias("value"), F.concat(F.lit("lists/hosts-"), "year", F.lit(".txt")).alias("file")))


@query("a17_window_sources", """
SELECT s_suppkey, CAST(unnest(range(greatest(1996, 1994 + s_suppkey % 8), least(2001, 1995 + s_suppkey % 8) + 1)) AS INT) AS year FROM supplier""")
def a17_window_sources(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.lit("list_"), F.col("s_suppkey") % 8 + 1994, F.lit("_"), F.col("s_suppkey") % 8 + 1995)
    return D.table(spark, sf, "supplier").select("s_suppkey", F.explode(L.window_years(name)).alias("year"))


@query("a18_accepted_captures", f"""
WITH {D.CAPTURES} SELECT host, year, count(*) AS n FROM captures WHERE host IS NOT NULL AND seq % 4 < 2 AND seq % 5 <> 0 AND year BETWEEN greatest(1996, 1997) AND 2000 GROUP BY host, year""")
def a18_accepted_captures(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.captures(spark, sf).where("host is not null").select(
        "host", F.concat(F.lit("http://"), F.when(F.col("seq") % 5 == 0, F.concat(F.lit("x."), "host")).otherwise(F.col("host")), F.lit(":80/p")).alias("original"), _stamp().alias("timestamp"), _status().alias("status"), F.lit(1997).alias("low"), F.lit(2000).alias("high")
    )
    return L.accepted_years(rows, "host", "low", "high").groupBy("host", "year").agg(F.count("*").alias("n"))


@query("a19_registration_years", """
SELECT concat('d', c_custkey, '.com') AS domain, CAST(1994 + c_custkey % 10 AS INT) AS year, concat(1994 + c_custkey % 10, '-02-03T00:00:00Z') AS date FROM customer WHERE c_custkey % 10 BETWEEN 2 AND 7""")
def a19_registration_years(spark: SparkSession, sf: str) -> DataFrame:
    y = (F.col("c_custkey") % 10 + 1994).cast("string")
    event = lambda action, date: F.struct(F.lit(action).alias("eventAction"), date.alias("eventDate"))
    payload = F.to_json(F.struct(F.array(event("last changed", F.lit("1990-01-01")), event("Registration", F.concat(F.lit("2003"), F.lit("-01-01"))), event("registration", F.concat(y, F.lit("-02-03T00:00:00Z")))).alias("events")))
    rows = D.table(spark, sf, "customer").select(F.concat(F.lit("d"), "c_custkey", F.lit(".com")).alias("domain"), payload.alias("payload"))
    return L.registration_years(rows)


@query("a20_listing_selection", "SELECT concat('f', p_partkey) AS path, CAST(p_size * 1000 + p_partkey % 7 AS BIGINT) AS length FROM part WHERE p_size * 1000 + p_partkey % 7 BETWEEN 1 AND 9000 ORDER BY 2, 1 LIMIT 100")
def a20_listing_selection(spark: SparkSession, sf: str) -> DataFrame:
    listing = D.table(spark, sf, "part").select(F.concat(F.lit("f"), "p_partkey").alias("path"), (F.col("p_size") * 1000 + F.col("p_partkey") % 7).cast("long").alias("length"))
    return sinks.select_listing(listing, 9000, 100)


@query("a21_size_texts", """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size * 1000 + 500 WHEN 1 THEN p_size * 1000000 + 500000 WHEN 2 THEN p_size ELSE NULL END AS bytes FROM part""")
def a21_size_texts(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    text = F.when(k == 0, F.concat("p_size", F.lit(".5K"))).when(k == 1, F.concat(F.lit("2001 "), "p_size", F.lit(".5 MB"))).when(k == 2, F.col("p_size").cast("string")).otherwise("-")
    return D.table(spark, sf, "part").select("p_partkey", H.parse_size(text).alias("bytes"))


@query("s1_hosts_of_urls", rf"""
SELECT page_id, lower({_HOST_OF_URL}) AS host, list_extract(string_split(lower({_HOST_OF_URL}), '.'), -1) AS tld, CAST(len(string_split({_HOST_OF_URL}, '.')) - 2 AS INT) AS depth, array_to_string(string_split(lower({_HOST_OF_URL}), '.')[-2:], '.') AS parent FROM pages""")
def s1_hosts_of_urls(spark: SparkSession, sf: str) -> DataFrame:
    """S1, S2, S3, S5."""
    h = H.host_of(F.col("url"))
    return D.table(spark, sf, "pages").select("page_id", h.alias("host"), H.tld(h).alias("tld"), H.depth(h).alias("depth"), H.registrable_parent(h).alias("parent"))


@query("s4_years_of_times", "SELECT event_id, CASE WHEN event_id % 4 < 3 THEN CAST(1996 + event_id % 6 AS INT) END AS year FROM events")
def s4_years_of_times(spark: SparkSession, sf: str) -> DataFrame:
    y, k = (F.col("event_id") % 6 + 1996).cast("string"), F.col("event_id") % 4
    text = F.when(k == 0, F.concat(y, F.lit("0102"))).when(k == 1, F.concat(F.lit(" "), y, F.lit("-01-02T00:00:00"))).when(k == 2, y).otherwise(F.concat(y, F.lit("x")))
    return D.table(spark, sf, "events").select("event_id", H.year_of(text).alias("year"))


@query("s7_canonical_urls", r"""
SELECT page_id, regexp_replace(url, '#.*$', '') AS canonical, concat('src:', sha256(regexp_replace(url, '#.*$', ''))) AS key, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS origin FROM pages""")
def s7_canonical_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical entry points, their keys and origins."""
    noisy = F.regexp_replace(F.regexp_replace("url", "^http://([^/?#]+)", "HTTP://$1:80"), "^(HTTP://[^/]*|https://[^/]*)/", "$1/./x/..//")
    return D.table(spark, sf, "pages").select("page_id", H.canonical_url(noisy).alias("canonical"), H.source_key(noisy).alias("key"), H.origin(noisy).alias("origin"))


@query("s8_result_urls", r"""
WITH u AS (SELECT page_id, regexp_replace(url, '#.*$', '') AS u FROM pages), q AS (SELECT page_id, u, list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT starts_with(lower(p), 'utm_'))) AS parts FROM u)
SELECT page_id, string_split(u, '?')[1] || CASE WHEN len(parts) > 0 THEN '?' || array_to_string(parts, '&') ELSE '' END AS canonical FROM q""")
def s8_result_urls(spark: SparkSession, sf: str) -> DataFrame:
    return D.table(spark, sf, "pages").select("page_id", H.canonical_result_url(F.col("url")).alias("canonical"))


@query("s14_year_siblings", """
SELECT s_suppkey, concat('http://x.example/', s_suppkey, '/list-', y, '.txt') AS sibling FROM supplier, (SELECT unnest(range(1996, 2002)) AS y) WHERE y <> 1996 + s_suppkey % 6""")
def s14_year_siblings(spark: SparkSession, sf: str) -> DataFrame:
    """The other years' addresses of a file with one target year in its name."""
    url = F.concat(F.lit("http://x.example/"), "s_suppkey", F.lit("/list-"), F.col("s_suppkey") % 6 + 1996, F.lit(".txt"))
    return C.year_siblings(D.table(spark, sf, "supplier").select("s_suppkey", url.alias("url")), "url").select("s_suppkey", "sibling")


@query("s15_template_expansion", "SELECT concat('http://', lower(replace(n_name, '_', '-')), '.example/', y, '/', f) AS url FROM nation, (SELECT unnest(range(1996, 2002)) AS y), (SELECT unnest(['hosts.txt', 'urls.gz']) AS f)")
def s15_template_expansion(spark: SparkSession, sf: str) -> DataFrame:
    """A template over finite lists; lists are literals of the plan, so the expansion is bounded by its row count."""
    n = D.table(spark, sf, "nation").select(F.lower(F.replace("n_name", F.lit("_"), F.lit("-"))).alias("v"))
    return C.expand_template(n, "http://{v}.example/{y}/{f}", {"y": range(1996, 2002), "f": ["hosts.txt", "urls.gz"]}).select("url")


@query("s16_payload_hash", f"WITH {D.VALID} SELECT seq, sha256(concat(host, chr(31), year, chr(31), source_id)) AS payload_hash FROM valid")
def s16_payload_hash(spark: SparkSession, sf: str) -> DataFrame:
    return D.valid_captures(spark, sf).select("seq", C.payload_hash("host", "year", "source_id").alias("payload_hash"))


@query("s17_action_kinds", f"""
WITH {D.VALID} SELECT CASE WHEN provider = 'rdap' THEN 'RDAP' WHEN seq % 4 = 0 THEN 'DOMAIN' WHEN seq % 4 = 1 THEN 'EXACT' ELSE 'RANGE' END AS kind, count(*) AS n FROM valid GROUP BY 1""")
def s17_action_kinds(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("seq") % 4
    rows = D.valid_captures(spark, sf).select("provider", F.lit(1996).alias("a"), F.when(s == 1, 1996).otherwise(2001).alias("b"), F.when(s == 0, "cdx-domain-v1").otherwise("cdx-v1").alias("policy"))
    return rows.groupBy(H.classify_action(F.col("provider"), F.col("a"), F.col("b"), F.col("policy")).alias("kind")).agg(F.count("*").alias("n"))


@query("s18_fraction_selected", f"WITH {D.VALID} SELECT DISTINCT host, CAST('0x' || substr(sha256(host), 1, 15) AS BIGINT) < {int(0.3 * (1 << 60))} AS selected FROM valid")
def s18_fraction_selected(spark: SparkSession, sf: str) -> DataFrame:
    return D.valid_captures(spark, sf).select("host").distinct().select("host", H.fraction_selected(F.col("host"), 0.3).alias("selected"))


@query("s19_provider_order", f"""
WITH {D.VALID}, h AS (SELECT DISTINCT host FROM valid), p AS (SELECT unnest(['ia', 'arquivo', 'mirror']) AS provider, unnest([1.0, 0.5, 0.25]) AS w),
r AS (SELECT host, provider, -ln((CAST('0x' || substr(sha256(concat(host, '|', provider)), 1, 12) AS BIGINT) + 0.5) / 281474976710656.0) / w AS s FROM h, p)
SELECT host, string_agg(provider, '>' ORDER BY s, provider) AS providers FROM r GROUP BY host""")
def s19_provider_order(spark: SparkSession, sf: str) -> DataFrame:
    """Weighted rendezvous order of providers for each host: by -ln(u) / weight, inside the row."""
    order = C.provider_order(F.col("host"), {"ia": 1.0, "arquivo": 0.5, "mirror": 0.25})
    return D.valid_captures(spark, sf).select("host").distinct().select("host", F.array_join(order, ">").alias("providers"))


@query("s20_growth", f"""
WITH {D.RUNS} SELECT source, round(coalesce(sum(eed) FILTER (WHERE k % 2 = 0) / nullif(sum(eed), 0), 0), 8) AS growth FROM runs GROUP BY source""")
def s20_growth(spark: SparkSession, sf: str) -> DataFrame:
    s = D.runs(spark, sf).groupBy("source").agg(F.sum(F.when(F.col("k") % 2 == 0, F.col("eed"))).alias("n"), F.sum("eed").alias("b"))
    return s.select("source", F.round(growth(F.col("n"), F.col("b")), 8).alias("growth"))


@query("s22_region_bisect", "SELECT p_partkey, 2 * p_partkey + c AS child, CASE WHEN c = 0 THEN 0 ELSE (p_size * 100 + 1) // 2 END AS low, CASE WHEN c = 0 THEN (p_size * 100 + 1) // 2 ELSE p_size * 100 + 1 END AS high FROM part, (SELECT unnest([0, 1]) AS c)")
def s22_region_bisect(spark: SparkSession, sf: str) -> DataFrame:
    """Two children of each byte range, without overlap."""
    p = D.table(spark, sf, "part").select("p_partkey", (F.col("p_size") * 100 + 1).alias("end"))
    half = p.select("p_partkey", F.explode(C.bisect(F.lit(0), F.col("end"))).alias("x"))
    return half.select("p_partkey", (F.col("p_partkey") * 2 + F.col("x.side")).alias("child"), F.col("x.low").cast("int").alias("low"), F.col("x.high").cast("int").alias("high"))


@query("k16_window_offsets", "SELECT p_partkey, i AS win, CAST(i * (p_size * 1000 - 100) // 3 AS BIGINT) AS \"offset\" FROM part, (SELECT unnest(range(4)) AS i)")
def k16_window_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Evenly spaced sample windows of a byte range, the first at its start and the last at its end."""
    p = D.table(spark, sf, "part").select("p_partkey", (F.col("p_size") * 1000 - 100).alias("room"))
    return p.select("p_partkey", F.explode(C.window_offsets(F.col("room"), 4)).alias("x")).select("p_partkey", "x.*")


@query("b9_suppression", f"""
WITH {D.RUNS}, s AS (SELECT 'SOURCE' AS scope, source AS key, max(ts) AS expires FROM runs WHERE kind = 'error' GROUP BY source UNION ALL SELECT 'FAMILY', kind, TIMESTAMP '2024-01-20' FROM runs WHERE kind = 'signup' GROUP BY kind UNION ALL SELECT 'ORIGIN', concat('o', requests), TIMESTAMP '2024-01-25' FROM runs WHERE eed > 450 GROUP BY requests)
SELECT run_id, CASE WHEN EXISTS (SELECT 1 FROM s WHERE scope = 'SOURCE' AND key = source AND expires > r.ts) THEN 'SOURCE' WHEN EXISTS (SELECT 1 FROM s WHERE scope = 'FAMILY' AND key = kind AND expires > r.ts) THEN 'FAMILY' WHEN EXISTS (SELECT 1 FROM s WHERE scope = 'ORIGIN' AND key = concat('o', requests) AND expires > r.ts) THEN 'ORIGIN' ELSE 'none' END AS reason FROM runs r""")
def b9_suppression(spark: SparkSession, sf: str) -> DataFrame:
    """The suppression of a source, a family or an origin, not yet over, that holds a row back."""
    r = D.runs(spark, sf)
    by_source = r.where("kind = 'error'").groupBy("source").agg(F.max("ts").alias("s_until"))
    by_family = r.where("kind = 'signup'").select("kind", F.lit("2024-01-20").cast("timestamp").alias("f_until")).distinct()
    by_origin = r.where("eed > 450").select(F.concat(F.lit("o"), "requests").alias("origin"), F.lit("2024-01-25").cast("timestamp").alias("o_until")).distinct()
    j = r.withColumn("origin", F.concat(F.lit("o"), "requests")).join(by_source, "source", "left").join(by_family, "kind", "left").join(by_origin, "origin", "left")
    reason = F.when(F.col("s_until") > F.col("ts"), "SOURCE").when(F.col("f_until") > F.col("ts"), "FAMILY").when(F.col("o_until") > F.col("ts"), "ORIGIN").otherwise("none")
    return j.select("run_id", reason.alias("reason"))


@query("b10_scout_verdict", f"""
WITH {D.LOG}, m AS (SELECT source_id, count(DISTINCT host) AS hosts, count(DISTINCT CASE WHEN lane = 'N' THEN host END) AS novel FROM log GROUP BY source_id)
SELECT source_id, CASE WHEN hosts >= 100 AND novel >= 10 AND novel >= 0.01 * hosts THEN 'WARM' ELSE 'HOLD' END AS verdict FROM m""")
def b10_scout_verdict(spark: SparkSession, sf: str) -> DataFrame:
    """Warm or hold, by 100 hosts, 10 novel ones and 1 %."""
    m = D.log(spark, sf).select("source_id", "host", "lane").distinct().groupBy("source_id", "host").agg(F.bool_or(F.col("lane") == "N").alias("n")).groupBy("source_id").agg(F.count("*").alias("hosts"), F.count_if("n").alias("novel"))
    return m.select("source_id", C.verdict(F.col("hosts"), F.col("novel"), F.lit(C.LEAST_EED)).alias("verdict"))


@query("b11_sample_decisions", f"""
WITH {D.LOG}, s AS (SELECT unnest([1, 2, 3]) AS stage), k AS (SELECT source_id, stage, host, count(*) AS c, bool_or(lane = 'N') AS novel FROM log, s WHERE seq % 4 <= stage GROUP BY ALL),
m AS (SELECT source_id, stage, count(*) AS hosts, count(*) FILTER (WHERE novel) AS novel, 0.25 * count(*) FILTER (WHERE novel) AS eed, count(*) FILTER (WHERE c = 1) / sum(c) AS unseen FROM k GROUP BY ALL),
d AS (SELECT *, hosts >= 100 AND novel >= 10 AND novel / hosts >= 0.01 AND eed >= 1 AS warm FROM m),
e AS (SELECT *, CASE WHEN warm AND novel >= 40 AND novel / hosts >= 0.04 AND eed >= 4 THEN 'early_accept' WHEN NOT warm AND hosts >= 100 AND unseen <= 0.01 AND (novel < 10 OR eed < 1) THEN 'early_reject' END AS decision FROM d)
SELECT source_id, coalesce(arg_min(decision, stage) FILTER (WHERE decision IS NOT NULL), 'continue') AS decision, min(stage) FILTER (WHERE decision IS NOT NULL) AS settled_at FROM e GROUP BY source_id""")
def b11_sample_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """B11 over growing samples of each source's log (half, three quarters, all of it): the first that settles it."""
    staged = D.log(spark, sf).withColumn("stage", F.explode(F.sequence(F.greatest(F.lit(1), F.col("seq") % 4).cast("int"), F.lit(3))))
    k = staged.groupBy("source_id", "stage", "host").agg(F.count("*").alias("c"), F.bool_or(F.col("lane") == "N").alias("is_novel"))
    m = k.groupBy("source_id", "stage").agg(F.count("*").alias("hosts"), F.count_if("is_novel").alias("novel"), (F.count_if(F.col("c") == 1) / F.sum("c")).alias("unseen"))
    settled = m.withColumn("d", C.early(F.col("hosts"), F.col("novel"), 0.25 * F.col("novel"), F.col("unseen")))
    return C.first_decisions(settled, "source_id", "stage", "d")


@query("b14_region_eligible", """
WITH i AS (SELECT p_partkey, ['CDX', 'CDXJ', 'JSONL'][p_size % 3 + 1] AS form, concat(['', 'file:', 'http:', 'https:', 'ftp:'][p_partkey % 5 + 1], '//h/', p_partkey, ['.cdx', '.cdxj', '.cdx.gz', '.ZIP', '?x=.gz'][p_size % 5 + 1]) AS locator, p_partkey % 7 <> 0 AS direct, CASE WHEN p_partkey % 3 > 0 THEN p_partkey % 3 = 1 END AS ranges FROM part)
SELECT p_partkey FROM i WHERE direct AND form IN ('CDX', 'CDXJ') AND NOT (ends_with(lower(locator), '.cdx.gz') OR ends_with(lower(locator), '.zip')) AND (starts_with(locator, '//') OR starts_with(locator, 'file:') OR (starts_with(locator, 'http') AND coalesce(ranges, FALSE)))""")
def b14_region_eligible(spark: SparkSession, sf: str) -> DataFrame:
    """B14 over indexes of several formats, places and compressions."""
    k, s = F.col("p_partkey"), F.col("p_size")
    pick = lambda i, *values: F.element_at(F.array(*map(F.lit, values)), (i + 1).cast("int"))
    locator = F.concat(pick(k % 5, "", "file:", "http:", "https:", "ftp:"), F.lit("//h/"), k, pick(s % 5, ".cdx", ".cdxj", ".cdx.gz", ".ZIP", "?x=.gz"))
    return D.table(spark, sf, "part").where(C.region_eligible(pick(s % 3, "CDX", "CDXJ", "JSONL"), locator, k % 7 != 0, F.when(k % 3 > 0, k % 3 == 1))).select("p_partkey")


@query("s10_result_keys", """
WITH r AS (SELECT p_partkey, concat('http://h', p_size, '.example/d/file-', p_partkey, '.txt') AS url, CASE WHEN p_size % 3 = 0 THEN upper(sha256(p_name)) ELSE 'n/a' END AS checksum, CASE WHEN p_size % 3 < 2 THEN p_brand ELSE '' END AS etag, CASE WHEN p_size % 4 > 0 THEN p_size END AS length,
 CASE WHEN p_partkey % 4 = 0 THEN concat('10.5281/z.', p_partkey) END AS doi, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN 'old' END AS title, CASE WHEN p_size % 2 = 0 THEN lower(p_type) ELSE '' END AS publisher, concat('h', p_size, '.example') AS host FROM part),
n AS (SELECT *, CASE WHEN length(title) >= 6 THEN title ELSE concat('file ', p_partkey, ' txt') END AS name FROM r)
SELECT p_partkey, CASE WHEN length(checksum) = 64 THEN concat('artifact:sha256:', lower(checksum)) WHEN etag <> '' AND length IS NOT NULL THEN concat('artifact:etag:', sha256(concat(etag, chr(31), length))) ELSE concat('artifact:url:', sha256(url)) END AS artifact,
 CASE WHEN doi IS NOT NULL THEN concat('dataset:doi:', doi) WHEN length(title) >= 8 THEN concat('dataset:meta:', sha256(concat(title, chr(31), publisher, chr(31), 'a b|c|'))) ELSE concat('dataset:url:', sha256(url)) END AS dataset,
 CASE WHEN publisher <> '' AND NOT contains(name, publisher) THEN concat(name, ' | ', publisher) WHEN length(name) < 8 THEN concat(name, ' | ', host) ELSE name END AS family FROM n""")
def s10_result_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of search results with and without checksums, entity tags, DOIs, titles and publishers."""
    k, s = F.col("p_partkey"), F.col("p_size")
    url = F.concat(F.lit("http://h"), s, F.lit(".example/d/file-"), k, F.lit(".txt"))
    title = F.when(k % 3 == 0, F.concat(F.initcap("p_name"), F.lit("!"))).when(k % 3 == 1, "Old")
    found = F.when(k % 4 == 0, F.concat(F.lit("https://doi.org/10.5281/Z."), k, F.lit(".,")))
    doi = H.first_doi(F.array(F.lit("urn:x"), found, F.when(k % 4 == 0, "10.9999/second")))
    publisher = F.when(s % 2 == 0, F.concat(F.lit(" "), "p_type", F.lit(".")))
    people = F.array(*map(F.lit, ("A. B", "C", "-", "left out")))
    artifact = Q.artifact_key(url, F.when(s % 3 == 0, F.upper(F.sha2("p_name", 256))).otherwise("n/a"), F.when(s % 3 < 2, F.col("p_brand")).otherwise(""), F.when(s % 4 > 0, s))
    return D.table(spark, sf, "part").select("p_partkey", artifact.alias("artifact"), Q.dataset_key(url, doi, title, publisher, people).alias("dataset"), Q.family(url, title, publisher).alias("family"))


_ARTIFACTS = " OR ".join(f"contains(t, '{t}')" for t in Q.ARTIFACT_TERMS)


@query("s12_text_relevance", rf"""
WITH p AS (SELECT page_id, lower(html) AS t, url FROM pages)
SELECT page_id, 0.45 * CAST(contains(t, 'href="/the') OR contains(t, 'mirror') AS INT) + 0.35 * CAST(coalesce(regexp_matches(t, '(1998|825)'), FALSE) OR page_id % 5 = 0 AS INT) + 0.2 * CAST({_ARTIFACTS} OR page_id % 4 = 0 AS INT) AS relevance FROM p""")
def s12_text_relevance(spark: SparkSession, sf: str) -> DataFrame:
    """S12 over the whole texts of pages, for a cell with two terms and two years."""
    k = F.col("page_id")
    score = Q.relevance(F.col("html"), F.col("url"), F.when(k % 4 == 0, "Dataset").otherwise("article"), F.when(k % 5 == 0, 1998), ('href="/the', "mirror"), (1998, 825))
    return D.table(spark, sf, "pages").select("page_id", score.alias("relevance"))


@query("s7_international_hosts", """
SELECT p_partkey, concat('https://', CASE p_size % 3 WHEN 0 THEN 'xn--bcher-kva' WHEN 1 THEN 'xn--r8jz45g' ELSE 'plain' END, '.example', CASE WHEN p_partkey % 2 = 0 THEN '' ELSE ':8443' END, '/p/', p_partkey) AS canonical FROM part""")
def s7_international_hosts(spark: SparkSession, sf: str) -> DataFrame:
    """Hosts beyond ASCII in their ASCII form."""
    s = F.col("p_size") % 3
    url = F.concat(F.lit("HTTPS://"), F.when(s == 0, "BÜCHER").when(s == 1, "例え").otherwise("Plain"), F.lit(".Example:"), F.when(F.col("p_partkey") % 2 == 0, "443").otherwise("8443"), F.lit("/p/"), "p_partkey", F.lit("#x"))
    return D.table(spark, sf, "part").select("p_partkey", H.canonical_url(url).alias("canonical"))


@query("a9_named_formats", """
SELECT CAST(r_regionkey AS INT) AS file, ['cdxj', 'delimited', 'warc_arc', NULL, 'lines'][r_regionkey + 1] AS format, ['locator', 'content_type', 'content_signature', NULL, 'content_signature'][r_regionkey + 1] AS method FROM region""")
def a9_named_formats(spark: SparkSession, sf: str) -> DataFrame:
    """Files known by name, by content type, by signature, not at all, and by their lines."""
    nation = D.table(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").cast("int").alias("file"))
    customer = D.table(spark, sf, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    host = F.concat(F.lit("c"), "c_custkey", F.lit(".example.com"))
    value = F.when(F.col("file") == 2, "WARC/1.0").when(F.col("file") == 3, F.concat(F.lit("no host of "), "c_custkey")).otherwise(host)
    files = D.table(spark, sf, "region").select(F.col("r_regionkey").cast("int").alias("file"), F.when(F.col("r_regionkey") == 0, "http://x.example/a.CDXJ.gz?v=1").otherwise("http://x.example/a").alias("path"), F.when(F.col("r_regionkey") == 1, "Text/CSV; charset=utf-8").alias("media"))
    return L.detect(customer.select("file", value.alias("value")), files).select("file", "format", "method")


_CELL_SCORE = "1.0 / sqrt(1.0 + a) + 1.5 * (1.0 - d) + CASE WHEN cost > 0 AND eed > 0 THEN eed / cost WHEN r > 0 THEN q / r ELSE 0.5 END"


@query("k12_cell_scores", f"""
WITH c AS (SELECT p_type AS mechanism, p_brand AS institution, count(*) AS a, CAST(sum(p_size) AS BIGINT) AS r, coalesce(sum(p_partkey % (p_size + 1)) / nullif(sum(p_size), 0), 0) AS d, CAST(sum(p_partkey % 7 % (p_size + 1)) AS BIGINT) AS q, sum(CASE WHEN p_partkey % 3 = 0 THEN p_retailprice * 2 ELSE 0 END) AS eed, sum(p_retailprice) AS cost FROM part GROUP BY ALL)
SELECT mechanism, institution, round({_CELL_SCORE}, 8) AS score FROM c""")
def k12_cell_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The score of each search cell (batches with diversity are picked by greedy_diverse)."""
    c = cells(spark, sf).groupBy("mechanism", "institution").agg(F.count("*").alias("a"), F.sum("results").alias("r"), A.ratio(F.sum("duplicates"), F.sum("results")).alias("d"), F.sum("qualified").alias("q"), F.sum("eed").alias("eed"), F.sum("cost").alias("cost"))
    return c.select("mechanism", "institution", F.round(A.cell_score(F.col("a"), F.col("d"), F.col("eed"), F.col("cost"), F.col("q"), F.col("r")), 8).alias("score"))


_PICKS = 6


def _diverse_sql() -> str:
    """The picks one after the other: each the best of what is left, less what the picks before it cost."""
    steps, won = [], "SELECT NULL::VARCHAR AS mechanism, NULL::VARCHAR AS institution, 0 AS pick WHERE FALSE"
    for i in range(_PICKS):
        repeats = "0.75 * (SELECT count(*) FROM won{0} w WHERE w.mechanism = s.mechanism) + 0.2 * (SELECT count(*) FROM won{0} w WHERE w.institution = s.institution)".format(i)
        steps.append(f"won{i} AS MATERIALIZED ({won})")
        left = f"SELECT s.*, score - ({repeats}) AS adjusted FROM s WHERE NOT EXISTS (SELECT 1 FROM won{i} w WHERE w.mechanism = s.mechanism AND w.institution = s.institution)"
        won = f"SELECT * FROM won{i} UNION ALL (SELECT mechanism, institution, {i} AS pick FROM ({left}) ORDER BY adjusted DESC, score DESC, key DESC LIMIT 1)"
    return ", ".join(steps) + f" {won}"


@query("k12_diverse_batch", f"""
WITH c AS (SELECT p_type AS mechanism, p_brand AS institution, count(*) AS a, CAST(sum(p_size) AS BIGINT) AS r, coalesce(sum(p_partkey % (p_size + 1)) / nullif(sum(p_size), 0), 0) AS d, CAST(sum(p_partkey % 7 % (p_size + 1)) AS BIGINT) AS q, sum(CASE WHEN p_partkey % 3 = 0 THEN p_retailprice * 2 ELSE 0 END) AS eed, sum(p_retailprice) AS cost FROM part GROUP BY ALL),
s AS MATERIALIZED (SELECT mechanism, institution, concat(mechanism, '|', institution) AS key, round({_CELL_SCORE}, 8) AS score FROM c), {_diverse_sql()}""")
def k12_diverse_batch(spark: SparkSession, sf: str) -> DataFrame:
    """A batch of six cells, repeats of a mechanism or institution at a cost."""
    scored = k12_cell_scores(spark, sf).withColumn("key", F.concat_ws("|", "mechanism", "institution"))
    path = work_folder(spark, "cells")
    scored.write.parquet(path)  # scored once, asked once a pick
    picked = A.greedy_diverse(spark.read.schema(scored.schema).parquet(path), "key", "score", "mechanism", "institution", _PICKS)
    return spark.createDataFrame([(r["mechanism"], r["institution"], i) for i, r in enumerate(picked)], "mechanism string, institution string, pick int")

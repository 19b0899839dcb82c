"""Search results, scouting, sniffing and streams with an identity, on small tables with the cases that matter."""

import hashlib

import pytest
from pyspark.sql import functions as F

from yearmask.functions import hosts as H
from yearmask.operators import scouting as C
from yearmask.operators import search as Q
from yearmask.sources import lines as L
from yearmask.sources import sinks
from yearmask.streaming import evidence as T


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_result_keys(spark):
    schema = "url string, checksum string, etag string, length int, doi string, title string, publisher string, creators array<string>"
    rows = [
        ("http://a.org/x/f.csv", " " + sha("x").upper(), "e", 5, None, "Old Web Hosts 1999, v2.1", "The Lab", ["A", "B", "C", "D"]),
        ("http://a.org/x/f.csv", "bad", "e", 5, "10.1234/x", "Short", None, None),
        ("http://a.org/", None, "e", None, None, None, "", []),
        ("http://a.org/x/", None, "", 5, None, "The Lab hosts", "the lab", None),
        (None, None, None, None, None, None, None, None),
    ]
    got = spark.createDataFrame(rows, schema).select(
        Q.artifact_key(*map(F.col, ("url", "checksum", "etag", "length"))).alias("a"), Q.dataset_key(*map(F.col, ("url", "doi", "title", "publisher", "creators"))).alias("d"), Q.family(*map(F.col, ("url", "title", "publisher"))).alias("f")
    ).collect()
    assert [r.a for r in got[:4]] == [f"artifact:sha256:{sha('x')}", f"artifact:etag:{sha('e' + chr(31) + '5')}", f"artifact:url:{sha('http://a.org/')}", f"artifact:url:{sha('http://a.org/x/')}"]
    assert [r.d for r in got[:4]] == [f"dataset:meta:{sha(chr(31).join(['old web hosts 1999 v2 1', 'the lab', 'a|b|c']))}", "dataset:doi:10.1234/x", f"dataset:url:{sha('http://a.org/')}", f"dataset:meta:{sha(chr(31).join(['the lab hosts', 'the lab', '']))}"]
    assert [r.f for r in got[:4]] == ["old web hosts | the lab", "a.org | a.org", "a.org | a.org", "the lab hosts"]


def test_relevance(spark):
    rows = [("A mirror list of 1998", "http://x", "article", None), ("none", "http://x/a.WARC.gz?q", None, 1998), ("19981", "http://x", "DataFile", 1999), (None, None, None, None), ("catalogs mirror", "http://x", "", None)]
    got = spark.createDataFrame(rows, "t string, u string, k string, y int").select(F.round(Q.relevance(*map(F.col, "tuky"), terms=["mirror"], years=[1998]), 4).alias("r")).collect()
    assert [r.r for r in got] == [1.0, 0.55, 0.2, 0.0, 0.65]


def test_early_decisions(spark):
    rows = [("a", 1, 100, 9, 9.0, 0.5), ("a", 2, 400, 40, 4.0, 0.5), ("b", 1, 200, 5, 9.0, 0.01), ("b", 2, 400, 90, 9.0, 0.01), ("c", 1, 99, 99, 99.0, 0.0), ("d", 1, 200, 12, 2.0, 0.0), ("e", 1, 0, 0, 0.0, 0.0)]
    frame = spark.createDataFrame(rows, "s string, at int, hosts int, novel int, eed double, unseen double").withColumn("d", C.early(*map(F.col, ("hosts", "novel", "eed", "unseen"))))
    assert {r.s: (r.decision, r.settled_at) for r in C.first_decisions(frame, "s", "at", "d").collect()} == {"a": ("early_accept", 2), "b": ("early_reject", 1), "c": ("continue", None), "d": ("continue", None), "e": ("continue", None)}


def test_eligible_indexes(spark):
    rows = [("CDX", "/a/b.cdx", True, None, True), ("CDXJ", "https://x/a.cdxj?z=.gz", True, True, True), ("CDXJ", "https://x/a.cdxj", True, None, False), ("CDX", "file:/a.CDX.GZ", True, True, False), ("JSONL", "/a", True, True, False), ("CDX", "ftp://x/a", True, True, False), ("CDX", "/a", False, True, False), ("CDX", None, True, True, False)]
    got = spark.createDataFrame(rows, "f string, l string, d boolean, r boolean, want boolean").select("want", C.region_eligible(*map(F.col, "fldr")).alias("y")).collect()
    assert [r.y for r in got] == [r.want for r in got]


def test_templates_siblings_and_ranges(spark):
    rows = spark.createDataFrame([("a", 1)], "name string, n int")
    assert {r.url for r in C.expand_template(rows, "http://{name}.org/{y}-{n}", {"y": [1998, 1998, 1999]}).collect()} == {"http://a.org/1998-1", "http://a.org/1999-1"}
    with pytest.raises(ValueError):
        C.expand_template(rows, "{y}{z}", {"y": range(200), "z": range(200)})
    with pytest.raises(ValueError):
        C.expand_template(rows, "http://x", {"y": [1]})
    urls = spark.createDataFrame([("http://x/1997/hosts-1998.txt",), ("http://x/19981.txt",), ("http://x/1997-1998",), (None,)], "url string")
    assert {r.sibling for r in C.year_siblings(urls, "url").collect()} == {f"http://x/1997/hosts-{y}.txt" for y in (1996, 1997, 1999, 2000, 2001)}
    r = spark.range(1).select(C.bisect(F.lit(3), F.lit(8)).alias("b"), C.window_offsets(F.lit(10), 4).alias("w"), C.window_offsets(F.lit(10), 1).alias("one")).first()
    assert [tuple(x) for x in r.b] == [(0, 3, 5), (1, 5, 8)] and [x.offset for x in r.w] == [0, 3, 6, 10] and [x.offset for x in r.one] == [0]


def test_international_hosts(spark):
    urls = ["http://Bücher.Example:80/a#b", "https://例え.jp", "http://plain.org/", "http://" + "ü" * 80 + ".org/", "ftp://ü.org/"]
    got = [r.c for r in spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string").orderBy("i").select(H.canonical_url(F.col("u")).alias("c")).collect()]
    assert got == ["http://xn--bcher-kva.example/a", "https://xn--r8jz45g.jp/", "http://plain.org/", None, None]


def test_formats_by_name_type_and_lines(spark):
    files = [(1, "http://x/a.CDX.gz?b=1", None), (2, "a", "text/csv; q"), (3, "a", None), (4, "a", "text/html"), (5, "a", None), (6, "a", None), (7, None, None)]
    lines = [(1, "{}"), (3, "WARC/1.0"), (3, "x"), *[(4, f"h{i}.org") for i in range(3)], (4, "not one"), (5, "k 1998 http://a/"), (5, "k 1998 http://b/"), *[(6, f"{{\"a\": {i}}}") for i in range(3)], *[(6, "?")] * 2]
    got = L.detect(spark.createDataFrame(lines, "file int, value string"), spark.createDataFrame(files, "file int, path string, media string")).collect()
    assert {r.file: (r.format, r.method, r.confidence) for r in got} == {
        1: ("cdx", "locator", 1.0), 2: ("delimited", "content_type", 0.96), 3: ("warc_arc", "content_signature", 1.0), 4: ("lines", "content_signature", 0.75), 5: (None, None, None), 6: ("jsonl", "content_signature", 0.6), 7: (None, None, None),
    }


def test_authorities(spark, tmp_path):
    schema = "host string, year int, seq int"
    feed, root = f"file://{tmp_path}/in", f"file://{tmp_path}/work"
    model = spark.createDataFrame([("org", 0.5)], "tld string, weight double")
    base = spark.createDataFrame([("a.org", 1996), ("b.org", 1997)], "host string, year int")
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(feed)
    for part in ([("a.org", 1996, 1), ("c.org", 1998, 5)], [("c.org", 1998, 3), (None, 1998, 9), ("b.org", 1998, 4)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(feed)
    got = {tuple(r) for r in T.novelty_under(stream(), base, model, root).collect()}
    assert got == {("c.org", 1998, 3), (None, 1998, 9), ("b.org", 1998, 4)}
    states = sorted((tmp_path / "work").glob("*/states/batch=*"))
    same = base.select("year", "host").orderBy(F.desc("host"))
    assert {tuple(r) for r in T.novelty_under(stream(), same, model, root).collect()} == got
    assert sorted((tmp_path / "work").glob("*/states/batch=*")) == states  # the cursor was at the end: nothing ran again
    for other in ((base.where("year = 1996"), model), (base.unionByName(base), model), (base, model.withColumn("weight", F.lit(0.25)))):
        assert T.novelty_under(stream(), *other, root).count() == 3  # replayed from zero
    assert len(list((tmp_path / "work").glob("authority-*"))) == 4


def test_status_history_over_batches(spark, tmp_path):
    schema = "host string, seq long, status string, reason string"
    feed = f"file://{tmp_path}/in"
    for part in ([("a", 1, "ACTIVE", None), ("b", 2, "ACTIVE", None)], [("a", 5, "VERIFIED", "seen"), ("c", 6, "REJECTED", "gone")], [("a", 7, "REJECTED", "late"), ("b", 8, "ACTIVE", None)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(feed)
    got = T.status_history(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(feed), f"file://{tmp_path}/work").collect()
    assert {tuple(r) for r in got} == {("a", "ACTIVE", None, 1), ("a", "VERIFIED", "seen", 5), ("b", "ACTIVE", None, 2), ("c", "ACTIVE", None, 6), ("c", "REJECTED", "gone", 6)}


def test_manifest_of_annual_lists(spark, tmp_path):
    rows = [(f"h{i}.org", 1996 + i % 3) for i in range(50)] * 2
    sinks.write_annual(spark.createDataFrame(rows, "host string, year int"), f"file://{tmp_path}/annual")
    files = sorted((tmp_path / "annual").glob("*/*.txt"))
    got = {r.path.rsplit("/", 1)[1]: (r.length, r.sha256) for r in sinks.manifest(spark, f"file://{tmp_path}/annual/*/*.txt").collect()}
    assert got == {f.name: (f.stat().st_size, hashlib.sha256(f.read_bytes()).hexdigest()) for f in files}
    assert sorted((h, int(f.parent.name[-4:])) for f in files for h in f.read_text().split()) == sorted(set(rows))

"""Small tables with the cases that matter, invariances, and streams against batches."""

import base64
import hashlib
import importlib
import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from yearmask.functions import hosts as H
from yearmask.operators import eed as E
from yearmask.operators import evidence as V
from yearmask.operators import graph as G
from yearmask.operators import portfolio as P
from yearmask.operators import sampling as S
from yearmask.operators import sketch as M
from yearmask.operators import value as A
from yearmask.sources import framing as R
from yearmask.sources import lines as L
from yearmask.sources import mail
from yearmask.sources import sinks
from yearmask.streaming import evidence as T


def column(spark, values, f, kind="string"):
    return [r.y for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").orderBy("i").select(f(F.col("v")).alias("y")).collect()]


def test_hostnames(spark):
    good = {" Example.COM\n": "example.com", "www.example.com": "www.example.com", "a-b.c1.org": "a-b.c1.org", "x" * 63 + ".com": "x" * 63 + ".com", "\xa0x.org": None}
    bad = ["http://x.com", "x.com:80", "*.x.com", "x.com/a", "a..com", "-a.com", "a-.com", "single", "", None, "x.c", "x.c0m", "y" * 64 + ".com", ".".join(["a" * 60] * 5) + ".com", "x.com."]
    assert column(spark, list(good)[:4], H.normalize_host) == list(good.values())[:4]
    assert column(spark, bad, H.normalize_host) == [None] * len(bad)


def test_hosts_of_urls(spark):
    cases = {"http://User@X.org:80/a?b": "x.org", "//x.org/a": "x.org", "x.org/a": "x.org", "'x.org'": "x.org", "http://a b/%": None, "ftp://x.org#f": "x.org", "mailto:x": None, None: None}
    assert column(spark, list(cases), H.host_of) == list(cases.values())


def test_years(spark):
    cases = {"1998": 1998, "19980102": 1998, "19980102030405": 1998, "1998-01-02": 1998, "1998/1": 1998, "2002": None, "1995-01-01": None, "199801": None, "1998x": None, "": None, None: None}
    assert column(spark, list(cases), H.year_of) == list(cases.values())


def test_parents(spark):
    assert column(spark, ["a.b.com", "b.com", "x.example.co.uk", "co.uk", "a..b", ".a.b.com."], H.registrable_parent) == ["b.com", "b.com", "example.co.uk", None, None, "b.com"]
    assert column(spark, ["a.b.com", "b.com", "a.co.uk", "a.b.co.uk"], H.parent_domain) == ["b.com", None, None, "b.co.uk"]


def test_urls(spark):
    cases = {"HTTP://X.Org:80": "http://x.org/", "https://x.org:443/a/../b/./c/?q=1#f": "https://x.org/b/c/?q=1", "http://x.org:8080/a": "http://x.org:8080/a", "http://u:p@x.org/": None, "ftp://x.org/": None, "": None}
    assert column(spark, list(cases), H.canonical_url) == list(cases.values())
    assert column(spark, ["http://x.org/a?b=2&utm_source=z&a=1&gclid=5", "http://x.org/?fbclid=1"], H.canonical_result_url) == ["http://x.org/a?a=1&b=2", "http://x.org/"]


def test_scopes_and_sizes(spark):
    names = ["CC-MAIN-2024", "Common Crawl", "isc_1997", "Network Wizards", "official pool", "anything", " "]
    assert column(spark, names, H.classify_source) == ["COMMON_CRAWL_CORPUS_EXCLUDED"] * 2 + ["ISC_REFERENCE"] * 2 + ["OFFICIAL_POOL"] + ["LOCAL_DISCOVERY"] * 2
    assert column(spark, ["12.5M", "1998 3K", "7", "2 GB", "none", "", None], H.parse_size) == [12_500_000, 3000, 7, 2_000_000_000, None, None, None]


def test_cdx_rows(spark):
    rows = ["k 19980102 http://a.org/ text/html 200 D 1 2 f", "k 19980102 http://a.org/", "k 19980102 http://a.org/ text/html 404 D", "k 2003 http://a.org/", "k 1998", "k 1998 a.org", "x", ""]
    got = L.read_cdx(spark.createDataFrame([(r,) for r in rows], "value string")).collect()
    assert [(r.year, r.direct_mask) for r in got] == [(1998, 4), (1998, 4)]


def test_cdxj_rows(spark):
    rows = ['k 1998 {"url":"http://a.org/","status":"200"}', 'k 2010 {"url":"http://a.org/"}', 'k 1998 {"url":"http://a.org/","status":"500"}', 'k 1998 {"url":', 'k 1998 {"status":"200"}', "k 1998", 'k 199 {"url":"x"}']
    frame = spark.createDataFrame([(r,) for r in rows], "value string")
    assert sorted((r.year, r.direct_mask) for r in L.read_cdxj(frame).collect()) == [(1998, 4), (2010, 0)]
    assert [r.year for r in L.read_cdxj(frame, years=(2010,)).collect()] == [2010]


def test_files_of_lines(spark, tmp_path):
    (tmp_path / "1997.txt").write_text("A.org\nbad_host\n\nb.org\n")
    (tmp_path / "x.warc").write_text("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://a.org/\r\nWARC-Date: 1998-02-03T00:00:00Z\r\n\r\nbody\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://b.org/\r\nWARC-Date: 2010-02-03T00:00:00Z\r\n\r\nbody")
    assert sorted((r.host, r.year) for r in L.read_reference_list(L.read_lines(spark, f"file://{tmp_path}/1997.txt")).collect()) == [("a.org", 1997), ("b.org", 1997)]
    assert sorted((r.url, r.year, r.hint_mask, r.direct_mask) for r in R.read_warc_headers(spark, f"file://{tmp_path}/x.warc").collect()) == [("http://a.org/", 1998, 4, 0), ("http://b.org/", None, 0, 0)]


def test_manifest_and_outputs(spark, tmp_path):
    years = spark.createDataFrame([("b.org", 1997), ("a.org", 1997), ("a.org", 1998), ("a.org", 1998)], "host string, year int")
    sinks.write_annual(years, f"file://{tmp_path}/out")
    text = {p.parent.name: p.read_text() for p in tmp_path.glob("out/*/*.txt")}
    assert text == {"year=1997": "a.org\nb.org\n", "year=1998": "a.org\n"}
    files = sinks.manifest(spark, f"file://{tmp_path}/out/*/*.txt")
    assert {r.sha256 for r in files.collect()} == {hashlib.sha256(t.encode()).hexdigest() for t in text.values()}
    one = sinks.digest(files).first()
    assert one.files == 2 and one.digest == sinks.digest(files.repartition(3)).first().digest


def test_eed_counts(spark):
    values = spark.createDataFrame([(v,) for v in ["A.com", "a.com ", "b.xx", "c.zz", "bad_", "", "d.com"]], "value string")
    weights = spark.createDataFrame([("com", "0.5"), ("zz", "0")], "tld string, w string").select("tld", F.col("w").cast(E.WEIGHT).alias("weight"))
    got = E.summary(values, weights).first()
    assert (got.unique_nonempty, got.valid, got.invalid, got.matched, got.unmatched, got.coverage_percent, got.eed) == (5, 4, 1, 3, 1, 75.0, 1.0)
    assert {(r.tld, r.hosts, r.eed, r.model_status) for r in E.by_tld(values, weights, "value").collect()} == {("com", 2, 1.0, "matched"), ("xx", 1, 0.0, "unmatched"), ("zz", 1, 0.0, "matched")}
    assert E.summary(values.limit(0), weights).first().eed == 0.0
    with pytest.raises(ValueError, match="no English"):
        E.english_weights(spark.createDataFrame([(["com"], ["deu"], ["1"])], "tld array<string>, lang array<string>, perc_of_tld array<string>"))


def test_plan_rules(spark):
    rows = [
        (0, 0, 0, True, "LOCAL_DISCOVERY", 4, 0, None, 0), (1, 4, 0, True, "LOCAL_DISCOVERY", 4, 0, None, 0), (2, 0, 0, False, "LOCAL_DISCOVERY", 4, 2, 1997, 0),
        (3, 0, 0, True, "COMMON_CRAWL_CORPUS_EXCLUDED", 4, 0, None, 1), (4, 0, 1, True, "LOCAL_DISCOVERY", 0, 0, None, 0), (5, 0, 0, True, "LOCAL_DISCOVERY", 4, 8, 1996, 0),
    ]
    o = spark.createDataFrame(rows, "i int, official_mask int, local_mask int, allow_direct boolean, scope string, direct_year_mask int, year_hint_mask int, source_year int, covered_mask int")
    assert {r.i: (r.direct_mask, r.query_mask) for r in V.plan(o).collect()} == {0: (4, 0), 1: (0, 59), 2: (0, 63), 3: (0, 62), 4: (0, 62), 5: (4, 9)}


def test_lanes(spark):
    rows = [("direct:a", "x", "y", "p", True), ("direct:a", "x", "y", "p", False), ("rdap", "x", "y", "p", False), ("ia", "rdap_registration_event", "y", "p", False), ("x", "DNS zone", "y", "p", False), ("ia", "archive_capture", "capture_timestamp_year", "p", False), ("ia", "other", "y", "p", False)]
    got = spark.createDataFrame(rows, "provider string, evidence_type string, temporal_semantics string, extraction_method string, bound boolean").select(V.lane(F.col("bound")).alias("l")).collect()
    assert [r.l for r in got] == ["DIRECT_ANNUAL", "UNKNOWN", "REGISTRATION_YEAR", "REGISTRATION_YEAR", "DNS_REFERENCE", "VERIFIED_CANDIDATE", "UNKNOWN"]


def test_outcomes_need_exhaustion(spark):
    cases = {"a": ["PASS", "INVALID"], "b": ["EMPTY_EXHAUSTIVE"] * 2, "c": ["EMPTY_EXHAUSTIVE", "INVALID"], "d": ["TRANSIENT_ERROR", "EMPTY_EXHAUSTIVE"], "e": ["INCOMPLETE", "INVALID"]}
    rows = spark.createDataFrame([(k, s) for k, v in cases.items() for s in v], "task_id string, state string")
    assert {r.task_id: r.outcome for r in V.task_outcome(rows).collect()} == {"a": "PASS", "b": "EMPTY_EXHAUSTIVE", "c": "INVALID", "d": "TRANSIENT_ERROR", "e": "INCOMPLETE"}


def test_saturation_boundary(spark):
    rows = [("a", 0.0, 100)] * 32 + [("b", 0.0, 100)] * 31 + [("c", 0.0, 100)] * 40 + [("c", 1.0, 1)] + [("d", 0.0, 1)] * 40
    got = {r.o: r.reason for r in A.saturation(spark.createDataFrame(rows, "o string, e double, n int"), "o", "e", "n").collect()}
    assert got == {"a": "suppress", "b": "too_few_sources", "c": "positive_yield", "d": "too_few_observations"}


def test_zero_runs_count(spark):
    got = A.hurdle(spark.createDataFrame([("f", 0.0, 5.0), ("f", 2.0, 4.0)], "f string, final double, scout double"), "f", "final", "scout").first()
    assert (got.n, got.successes, got.success_probability, got.conversion) == (2, 1, 0.5, 0.5)


def test_samples_are_invariant(spark):
    hosts = spark.createDataFrame([(f"{'www.' if i % 3 else ''}h{i}.{t}",) for i in range(200) for t in ("com", "de")], "host string")
    for f in (lambda d: S.stratified(d, 40, cap=4), lambda d: S.smallest_hashes(d, "host", 25, "s")):
        assert sorted(map(tuple, f(hosts).collect())) == sorted(map(tuple, f(hosts.unionByName(hosts).repartition(13)).collect()))


def test_sketches(spark):
    rows = spark.createDataFrame([("a", f"v{i}") for i in range(100)] + [("b", f"v{i}") for i in range(50, 150)] + [("c", f"w{i}") for i in range(9)], "g string, v string")
    sketch = M.minhash(rows, "g", "v")
    pairs = {(r.left, r.right): r.jaccard for r in M.similarity(sketch, "g").collect()}
    assert set(pairs) == {("a", "b")} and abs(pairs["a", "b"] - 1 / 3) < 0.2
    whole = M.minhash(rows.withColumn("g", F.lit("x")), "g", "v")
    assert sorted(map(tuple, M.union(sketch.withColumn("g", F.lit("x")), "g").collect())) == sorted(map(tuple, whole.collect()))


def plain_greedy(regions, sets, most, budget):
    width, hashes = M.WIDTH, {}
    for r, values in sets.items():
        halves = [(int(h[:14], 16), int(h[14:28], 16)) for h in (hashlib.md5(v.encode()).hexdigest() for v in values)]
        hashes[r] = [min((a + s * b) % M.PRIME for a, b in halves) for s in range(width)]
    picked, spent, covered, union = [], 0.0, 0.0, None
    while len(picked) < most:
        best = None
        for r, (items, eed, size) in sorted(regions.items()):
            if r in picked or size > budget - spent:
                continue
            shared = 0.0
            if union:
                j = sum(a == b for a, b in zip(hashes[r], union, strict=True)) / width
                shared = min(items, covered, j * (items + covered) / (1 + j))
            rate = eed * max(0.0, 1 - min(1.0, shared / items)) / size
            if best is None or rate > best[0] + 1e-12:
                best = (rate, r, shared)
        if best is None or best[0] <= 0:
            break
        r = best[1]
        picked.append(r)
        spent += regions[r][2]
        covered = max(covered, covered + regions[r][0] - best[2])
        union = hashes[r] if union is None else [min(a, b) for a, b in zip(union, hashes[r], strict=True)]
    return picked


def test_greedy_portfolio(spark):
    sets = {"a": [f"v{i}" for i in range(60)], "b": [f"v{i}" for i in range(55)], "c": [f"w{i}" for i in range(30)], "d": [f"v{i}" for i in range(20, 90)], "e": [f"x{i}" for i in range(5)]}
    regions = {r: (len(v), float(len(v)), 100.0) for r, v in sets.items()}
    frame = spark.createDataFrame([(r, *v) for r, v in regions.items()], "region string, items long, eed double, bytes double")
    sketch = M.minhash(spark.createDataFrame([(r, v) for r, vs in sets.items() for v in vs], "region string, v string"), "region", "v")
    for most, budget in ((5, 1e9), (3, 1e9), (5, 250.0)):
        assert [p["region"] for p in P.greedy(frame, sketch, most, budget)] == plain_greedy(regions, sets, most, budget)


def test_greedy_portfolio_is_lazy_and_knows_what_it_cannot_tell(spark):
    r = random.Random(8)
    sets = {f"r{i:03}": [f"v{r.randrange(40 + 4 * i)}" for _ in range(30 + i)] for i in range(120)}
    regions = {k: (len(set(v)), float(len(set(v))) * (i + 1), 100.0 + i) for i, (k, v) in enumerate(sets.items())}
    frame = spark.createDataFrame([(k, *v) for k, v in regions.items()], "region string, items long, eed double, bytes double")
    sketch = M.minhash(spark.createDataFrame([(k, v) for k, vs in sets.items() for v in vs], "region string, v string"), "region", "v").cache()
    scored, every = [], []
    lazy = [p["region"] for p in P.greedy(frame, sketch, 6, 1e9, first=8, scored=scored)]
    assert lazy == [p["region"] for p in P.greedy(frame, sketch, 6, 1e9, first=10_000, scored=every)] == plain_greedy(regions, {k: sorted(set(v)) for k, v in sets.items()}, 6, 1e9)
    assert every == [120, 119, 118, 117, 116, 115] and sum(scored) < sum(every) / 2
    # without sketches all overlap alike once something is covered; overhead counts against the budget
    none = sketch.where("false")
    got = P.greedy(frame, none, 3, 1e9)
    best = sorted(regions, key=lambda k: (-regions[k][1] / regions[k][2], k))
    assert [p["region"] for p in got] == best[:3] and got[0]["added"] == got[0]["eed"] and got[1]["added"] == pytest.approx(got[1]["eed"] * (1 - P.UNKNOWN_OVERLAP))
    assert len(P.greedy(frame, none, 3, 700.0, overhead=200.0)) == 1
    mixed = P.greedy(frame, sketch.where(F.col("region") != best[0]), 2, 1e9)
    assert [p["region"] for p in mixed] == best[:2] and mixed[1]["added"] == pytest.approx(mixed[1]["eed"] * (1 - P.UNKNOWN_OVERLAP))


def test_diverse_batches(spark):
    scored = spark.createDataFrame([("k1", 3.0, "m", "i"), ("k2", 2.9, "m", "i"), ("k3", 2.2, "n", "i"), ("k4", 0.1, "o", "j")], "key string, score double, mechanism string, institution string")
    assert [r["key"] for r in A.greedy_diverse(scored, "key", "score", "mechanism", "institution", 3)] == ["k1", "k3", "k2"]


def test_graph(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d")], "parent string, child string")
    rewards = spark.createDataFrame([("b", 8.0), ("c", 4.0), ("d", 2.0)], "node string, reward double")
    assert {r.root: r.max_depth for r in G.depth_of(edges, 5).collect()} == {"a": 3, "b": 2, "c": 1}
    got = {r.root: r.descendant_reward for r in G.descendant_reward(edges, rewards, 5).collect()}
    assert got == {"a": 8 / 2 + 4 / 2 + 4 / 4 + 2 / 4 + 2 / 8, "b": 4 / 2 + 2 / 4, "c": 1.0}


def test_links_of_every_form(spark):
    html = """<A HREF='a.html'>one <b>bold</b></A><a class=x href=../up>two</a><a href="?q=1">q</a><a href="//other.org/x">proto</a>
<a href="#top">f</a><a href="mailto:a@b">m</a><a href=''>e</a><a name="n">none</a><a href="/root"><img src="i">pic</a><a href=http://bare.org/y>open"""
    pages = spark.createDataFrame([("http://x.org/d/e/p.html?z=1", html), ("http://y.org", "<a href=b>x</a>")], "url string, html string")
    got = {(r.url, r.anchor) for r in G.page_links(pages).collect()}
    assert got == {
        ("http://x.org/d/e/a.html", "one bold"), ("http://x.org/d/up", "two"), ("http://x.org/d/e/p.html?q=1", "q"), ("http://other.org/x", "proto"),
        ("http://x.org/root", "pic"), ("http://bare.org/y", "open"), ("http://y.org/b", "x"),
    }


def test_link_promotion(spark):
    html = '<a href="/data/index.html">Archive of links</a> <a href="http://y.org/x.csv.gz">x</a> <a href="/one">nothing</a>'
    pages = spark.createDataFrame([("http://x.org/p1", html), ("http://x.org/p2", html.replace("/one", "/two")), ("http://x.org/p3", None)], "url string, html string")
    got = {r.url: r.score for r in G.promoted(G.link_summary(G.page_links(pages))).collect()}
    assert got == {"http://x.org/data/index.html": 8 + 15 + 2, "http://y.org/x.csv.gz": 100 + 8 + 2}


def test_streams_as_batches(spark, tmp_path):
    rows = [(f"h{i % 7}.org", 1996 + i % 3, f"s{i}", i) for i in range(60)]
    schema = "host string, year int, source string, seq int"
    folder = f"file://{tmp_path}/in"
    base = spark.createDataFrame([("h1.org", 1996)], "host string, year int")
    for part in (rows[:20], rows[20:45]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    want = V.first_by(spark.createDataFrame(rows[:45], schema), ["host", "year"], ["seq"]).join(base, ["host", "year"], "left_anti").count()
    assert T.incremental_novelty(stream(), base, f"file://{tmp_path}/work").count() == want
    spark.createDataFrame(rows[45:], schema).coalesce(1).write.mode("append").parquet(folder)
    again = T.incremental_novelty(stream(), base, f"file://{tmp_path}/work")  # goes on at its cursor
    pairs = {(r.host, r.year) for r in again.collect()}
    assert again.count() == len(pairs) and pairs == {(h, y) for h, y, _, _ in rows} - {("h1.org", 1996)}


def test_status_stream_as_batch(spark, tmp_path):
    pytest.importorskip("google.protobuf")
    rows = [("a", 1, "ACTIVE"), ("a", 2, "VERIFIED"), ("a", 3, "REJECTED"), ("b", 1, "ACTIVE"), ("c", 5, "REJECTED")]
    frame = spark.createDataFrame(rows, "host string, seq long, status string")
    frame.coalesce(1).write.parquet(f"file://{tmp_path}/events")
    stream = T.candidate_status(spark.readStream.schema(frame.schema).parquet(f"file://{tmp_path}/events"))
    found = []
    stream.writeStream.outputMode("update").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).foreachBatch(lambda b, _: found.extend(b.collect())).start().awaitTermination()
    assert {(r.host, r.status) for r in found} == {(r.host, r.status) for r in T.candidate_status_batch(frame).collect()} == {("a", "VERIFIED"), ("b", "ACTIVE"), ("c", "REJECTED")}


def test_entry_without_the_training_data_package(spark, monkeypatch):
    import importlib.util

    found = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name in ("yearmask.llm", "corpus_pipeline") else found(name, *a))
    sys.modules.pop("__spark_entry__", None)
    entry = importlib.import_module("__spark_entry__")
    try:
        assert not any(n.startswith("op") or n == "pipeline" for n in entry.queries()) and len(entry.queries()) > 150
        assert entry.entry(spark).count() > 0
    finally:
        sys.modules.pop("__spark_entry__", None)


def test_rejected_batch_finds_long_cycles_and_deep_rows(spark):
    ring = [(i, (i + 1) % 7) for i in range(7)]
    chain = [(i, i + 1) for i in range(20, 26)]  # six edges in a row
    edges = [*ring, *chain, (10, 11), (11, 12), (12, 13), (13, 14), (30, 30), (31, 32), (31, 32), (40, 41), (41, 99), (99, 40), (50, 0)]
    nodes = {x for e in edges for x in e} - {99}
    got = G.rejected_batch(spark.createDataFrame(edges, "parent long, child long"), spark.createDataFrame([(x,) for x in nodes], "node long"))
    want = {e: "cycle" for e in ring} | {e: "depth" for e in chain} | {(30, 30): "self_edge", (31, 32): "duplicate", (41, 99): "unknown_node", (99, 40): "unknown_node", (50, 0): "depth"}
    rows = got.collect()
    assert len(rows) == len(want) and {(r.parent, r.child): r.reason for r in rows} == want


def test_no_nation_and_no_event_is_left_out(spark, sf):
    from yearmask.plans import portfolio, registry

    assert registry.QUERIES["j30_search_cells"](spark, sf).count() == 9 * spark.read.parquet(f"{sf}/nation.parquet").count()
    larger = sf.replace("sf0.001", "sf0.01")  # all 50 sources have events
    every = {r.source: r.score for r in registry.QUERIES["k14_value_ranking"](spark, larger).collect()}
    fifth = portfolio.value_ranking(spark, larger, spark.read.parquet(f"{larger}/events.parquet").where("user_id % 50 < 10"))
    some = {r.source: r.score for r in fifth.collect()}
    assert len(some) == len(every) == 50 and all(every[s] > some[s] for s in every)


def test_a_source_without_valid_lines_is_audited(spark):
    from yearmask.plans import evidence

    rows = spark.createDataFrame([("a", "x.org"), ("a", "x.org"), ("a", "y.org"), ("a", None), ("b", None), ("b", None)], "source_id string, host string")
    base = spark.createDataFrame([("x.org", 1997)], "host string, year int")
    got = evidence.source_audit(rows, base, spark.createDataFrame([("y.org",)], "host string")).collect()
    assert sorted(map(tuple, got)) == [("a", 4, 3, 1, 1, 2, 1, 1, 0), ("b", 2, 0, 2, 0, 0, 0, 0, 0)]


def test_quoted_cells_and_mailboxes(spark, tmp_path):
    rows = ['n,"a;b, c",x.org,1998', '"x ""y"", z",1997-02-03," y.org "', "plain,http://z.org/a,2001", '"open,w.org,1996', "", '"";"",v.org']
    got = L.read_delimited(spark.createDataFrame([(r,) for r in rows], "value string")).collect()
    assert [(r.host, r.year) for r in got] == [("x.org", 1998), ("y.org", 1997), ("z.org", 2001), ("w.org", 1996), ("v.org", None)]
    cells = L.read_delimited(spark.createDataFrame([('"a|b"|"q.org"|"1999"',)], "value string"), delimiter="|", host_column=1, year_column=2).collect()
    assert [(r.host, r.year) for r in cells] == [("q.org", 1999)]
    encoded = base64.encodebytes(b"see http://in.base64.org/x today " * 3).decode()
    links = " ".join(f"http://many.org/{i}" for i in range(100))
    (tmp_path / "box").write_text(
        f"From a@b Mon\nDate: Mon, 5 May 1997 10:00\nSubject: x\n\n>From me: http://one.org/a\nFrom here on http://two.org/.\n\nFrom c@d Tue\nDate: 6 May 1998\nContent-Type: multipart/mixed; boundary=p\n\n--p\nContent-Type: text/plain\nContent-Transfer-Encoding: base64\n\n{encoded}\n--p\nContent-Transfer-Encoding: quoted-printable\n\nhttp://soft.o=\nrg/?a=3Db\n\nFrom e@f Wed\nDate: 1999\nDate: 2000\n\nhttp://twice.org/\n\nFrom g@h\nDate: 1 Jan 2001\n\n{links}\n"
    )
    messages = L.read_mailbox(spark, f"file://{tmp_path}/box")
    found = {(r.year, r.url) for r in mail.mail_messages(messages).collect()}
    assert messages.count() == 4
    assert {u for y, u in found if y == 1997} == {"http://one.org/a", "http://two.org/"}
    assert {"http://in.base64.org/x", "http://soft.org/?a=b"} <= {u for y, u in found if y == 1998}
    assert sum(y == 2001 for y, _ in found) == 100 and not any("twice" in u for _, u in found)
    assert sum(r.year == 2001 for r in mail.mail_messages(messages, most=64).collect()) == 64


def test_warc_header_query_scans_whole_records(spark, tmp_path):
    from yearmask.plans import registry

    page = "<p>" * 60 + "\r\n\r\nWARC-Target-URI: http://in.the.page/\r\n\r\nend"
    spark.createDataFrame([(i, f"http://x/{i}", page if i % 2 else None) for i in range(20)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = registry.QUERIES["a15_warc_headers"](spark, f"file://{tmp_path}")
    assert {r.url for r in got.collect()} == {f"http://x/{i}" for i in range(20)} and got.count() == 20
    archives = sorted(Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://")).glob("archives-*"), key=lambda p: p.stat().st_mtime)[-1]
    written = spark.read.text(f"file://{archives}/*", wholetext=True).selectExpr("sum(regexp_count(value, 'end\r\n\r\n'))").first()[0]
    assert written == 10

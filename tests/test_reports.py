"""Nested reports against plain recursion, and messages against the mail parser."""

import base64
import datetime
import json
import random
from email import policy
from email.message import EmailMessage
from email.mime.base import MIMEBase
from email.mime.message import MIMEMessage
from email.mime.multipart import MIMEMultipart
from email.mime.text import MIMEText

from pyspark.sql import functions as F

from yearmask.functions import hosts as H
from yearmask.operators import reports as N
from yearmask.plans import registry
from yearmask.sources import mail


def flat(value, path=()):
    if isinstance(value, dict | list):
        for k, v in value.items() if isinstance(value, dict) else enumerate(value):
            yield from flat(v, (*path, str(k)))
    elif path and not isinstance(value, bool):
        try:
            yield ".".join(path), float(value)
        except (TypeError, ValueError):
            pass


def report(r, depth=0):
    kinds = [lambda: r.randrange(5), lambda: r.random(), lambda: "12", lambda: "x", lambda: True, lambda: None, lambda: {}, lambda: []]
    if depth < 4:
        kinds += [lambda: {k: report(r, depth + 1) for k in r.sample("abcde", 3)}, lambda: [report(r, depth + 1) for _ in range(r.randrange(3))]] * 2
    return r.choice(kinds)()


def test_deltas_of_nested_reports(spark):
    r = random.Random(4)
    rows = [(f"s{i % 3}", i, {k: report(r) for k in r.sample("uvwxyz", 4)}) for i in range(60)] + [("empty", 1, {}), ("empty", 2, {"a": 1}), ("leaf", 1, 7)]
    frame = spark.createDataFrame([(s, i, json.dumps(b)) for s, i, b in rows], "source string, at long, json string")
    every = N.in_order(frame, "source", "at").cache()
    values = N.numbers(N.leaves(every.select("source", "number", F.parse_json("json").alias("b")), ["source", "number"], "b"), ["source", "number"])
    by = {}
    for s, i, b in sorted(rows, key=lambda x: x[:2]):
        by.setdefault(s, []).append(dict(flat(b)))
    assert sorted(map(tuple, values.collect())) == sorted((s, n, p, v) for s, all_ in by.items() for n, d in enumerate(all_) for p, v in d.items())
    changed = {(x["source"], x["number"], x["path"]): (x["before"], x["now"], x["delta"], x["reset"]) for x in N.changed(values, every, "source").collect()}
    assert changed == {(s, n + 1, p): (a[p], b[p], b[p] - a[p], b[p] < a[p]) for s, all_ in by.items() for n, (a, b) in enumerate(zip(all_, all_[1:], strict=False)) for p in a.keys() & b.keys() if a[p] != b[p]}
    growth = {(x["source"], x["number"], x["path"]): x["delta"] for x in N.growth(values, every, "source").collect()}
    assert growth == {(s, n + 1, p): b.get(p, 0) - a.get(p, 0) for s, all_ in by.items() for n, (a, b) in enumerate(zip(all_, all_[1:], strict=False)) for p in a.keys() | b.keys() if b.get(p, 0) >= a.get(p, 0)}


def test_validation_windows(spark):
    def snap(i, t, eed, **counters):
        return ("s", i, t, json.dumps({"eed": eed, "counters": counters} if eed is not None else {"counters": counters}))

    rows = [snap(0, 0, 10, requests=100, claimed=10, passed=5), snap(1, 3600, 40, requests=300, claimed=30, passed=9, throttled=20, errors=2), snap(2, 7200, 45, requests=10, claimed=40), snap(3, 7200, 46, requests=20), snap(4, 9000, None, requests=25)]
    every = N.in_order(spark.createDataFrame(rows, "source string, at long, seconds long, json string"), "source", "at").cache()
    values = N.numbers(N.leaves(every.select("source", "number", F.parse_json("json").alias("b")), ["source", "number"], "b"), ["source", "number"])
    got = {x["number"]: x for x in N.validation_windows(values, every, "source", "seconds").collect()}
    assert set(got) == {1, 2, 3, 4}
    one = got[1]
    assert (one.elapsed, one.valid, one.requests, one.eed_per_hour, one.eed_per_day, one.eed_per_1000_requests) == (3600, True, 200, 30, 720, 150)
    assert (one.pass_fraction, one.throttle_fraction, one.error_fraction) == (0.2, 0.1, 0.01)
    assert not got[2].valid and got[2].resets == 4 and got[2].eed_per_hour is None and got[2].throttle_fraction is None
    assert not got[3].valid and not got[4].valid and got[4].eed_per_day is None


def test_reports_opened_side_by_side(spark):
    """The same rows as by leaves, whatever texts of numbers look like and however deep they lie."""
    r = random.Random(9)
    odd = ["1d", " 7 ", "1_0", "0x1p3", "inf", "-Infinity", "+NaN", "NaN", "1.", ".5", "1e400", "٣", "", "-", "0x1", "1e5 f", "true", "1e-3F", "\t2\n"]
    rows = [(f"s{i % 3}", i, {k: report(r) for k in r.sample("uvwxyz", 4)} | {"eed": i * r.random(), "counters": {"requests": r.randrange(50), "claimed": r.randrange(5), "errors": "3"}}) for i in range(90)]
    rows += [("odd", i, {"a": [{"b": t}], "a.0.b": 1} if i % 7 == 0 else {"": {"x": 10**30 + i}, "a": [{"b": t}]}) for i, t in enumerate(odd)] + [("few", 1, {}), ("few", 2, {"a": 1}), ("few", 3, {"eed": 4}), ("leaf", 1, 7), ("leaf", 2, {"b": -0.5})]
    frame = spark.createDataFrame([(s, i, i * 7 % 50, json.dumps(b)) for s, i, b in rows] + [("few", 4, 9, None)], "source string, at long, seconds long, json string")
    every = N.in_order(frame, "source", "at").cache()
    values = N.numbers(N.leaves(every.select("source", "number", F.parse_json("json").alias("b")), ["source", "number"], "b"), ["source", "number"])
    pairs = N.in_pairs(frame, "source", "at").where("number > 0")
    stepped = N.steps(pairs.select("source", "number", (F.col("seconds") - F.col("before.seconds")).alias("elapsed"), "json", F.col("before.json").alias("old")), "json", "old").cache()
    same = lambda x: sorted(map(repr, x.collect()))
    assert same(N.that_differ(N.step_deltas(stepped, "source"))) == same(N.changed(values, every, "source"))
    assert same(N.that_grew(N.step_deltas(stepped, "source", missing=True))) == same(N.growth(values, every, "source"))
    assert same(N.step_windows(stepped, "source", F.col("elapsed"))) == same(N.validation_windows(values, every, "source", "seconds"))


def test_no_report_is_broadcast(spark, tmp_path):
    """Rows that grow with the reports may look small as packed files: they are never sent to the driver, nor joined by leaves."""
    rows = [(i, datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=i), i % 60, "click", 1.0, json.dumps({"k": i % 100})) for i in range(400)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"file://{tmp_path}/events.parquet")
    for name in ("w10_nested_deltas", "w9_nested_growth", "g34_snapshot_windows"):
        frame = registry.QUERIES[name](spark, f"file://{tmp_path}")
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") == 1 and "Generate variant" not in plan, name  # what ranges hand on alone
    every = N.in_order(spark.createDataFrame([("s", i, json.dumps({"a": i})) for i in range(20)], "source string, at long, json string"), "source", "at")
    values = N.numbers(N.leaves(every.select("source", "number", F.parse_json("json").alias("b")), ["source", "number"], "b"), ["source", "number"])
    found = N.changed(values, every.select("source", "number"), "source")
    found.collect()
    assert found._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") >= 2


def nested_message(r, n):
    def text(i):
        word = r.choice(["plain", "grüße", "=3D=", "ß" * 90])
        sub, charset = r.choice(["plain", "html"]), r.choice(["us-ascii", "utf-8", "iso-8859-1"])
        body = f"{word} http://h{n}.org/{i}?a=1&b=2&c={'x' * r.choice([1, 90])} end\n"
        m = MIMEText(body if charset != "us-ascii" else body.encode("ascii", "replace").decode(), sub, charset)
        if r.random() < 0.3:
            m.add_header("Content-Disposition", "attachment", filename="a.txt")
        if charset != "us-ascii" and r.random() < 0.5:
            m.replace_header("Content-Transfer-Encoding", "quoted-printable")
            m.set_payload(body.encode(charset).hex(" ").upper().replace(" ", "=").join(["=", ""]))
        return m

    def part(depth):
        k = r.random()
        if depth > 3 or k < 0.5:
            return text(r.randrange(100))
        if k < 0.85:
            m = MIMEMultipart(r.choice(["mixed", "alternative", "related"]))
            for _ in range(r.randrange(1, 4)):
                m.attach(part(depth + 1))
            return m
        if k < 0.93:
            m = MIMEMessage(part(depth + 1))
            if r.random() < 0.5:
                m.add_header("Content-Disposition", "attachment")
            return m
        m = MIMEBase("application", "octet-stream")
        m.set_payload(base64.b64encode(b"http://binary.example/").decode())
        m["Content-Transfer-Encoding"] = "base64"
        return m

    m = part(0)
    m["Date"] = f"Mon, 5 May {r.choice([1996, 1999, 2001, 2005])} 10:00:00 +0000"
    if r.random() < 0.1:
        m["X-Date"] = "no"
        m["DATE"] = "Mon, 5 May 1999 10:00:00 +0000"
    return m.as_bytes()


def slow_messages(raw):
    """By the mail package's own way to a text."""
    import email

    message = email.message_from_bytes(raw, policy=policy.default)
    dates = [v for k, v in message.raw_items() if k.lower() == "date"]
    if len(dates) != 1 or not 1996 <= int(dates[0].split()[3]) <= 2001:
        return set()
    texts = []

    def visit(part: EmailMessage) -> None:
        if part.is_attachment() or part.get_filename():
            return
        if part.is_multipart():
            for p in part.iter_parts():
                visit(p)
        elif part.get_content_maintype() == "text":
            texts.append(part.get_content())

    visit(message)
    return {(int(dates[0].split()[3]), u) for t in texts for u in t.split() if u.startswith("http")}


def test_nested_messages(spark):
    r = random.Random(11)
    raw = [nested_message(r, n) for n in range(150)]
    want = set().union(*map(slow_messages, raw))
    got = mail.mail_messages(spark.createDataFrame([(m,) for m in raw], "value binary")).collect()
    assert len(want) > 80 and {(x["year"], x["url"]) for x in got} == want


def test_odd_messages(spark):
    rows = [None, "", "no header at all http://x.org/", "Date: Mon, 5 May 97 10:00:00 +0000\n\nhttp://two.org/", "Date: 1999\nContent-Type: text/plain; charset=nobody-knows\n\nhttp://three.org/", "Date: someday\n\nhttp://four.org/"]
    got = mail.mail_messages(spark.createDataFrame([(m,) for m in rows], "value string")).collect()
    assert {(x["year"], x["url"]) for x in got} == {(1997, "http://two.org/"), (1999, "http://three.org/")}


def test_identifiers_and_labels(spark):
    texts = ["10.1000/ABC.", "https://doi.org/10.1234/x,;", "doi 10.1/x", "10.123/x", "10.12345/", "10.1234/a b", "http://dx.doi.org/10.123456789/A/b", "10.1234567890/x", "11.1234/x", "10.12.34/x", None, " 10.1000/y "]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in frame.select(H.doi(F.col("t"))).collect()] == ["10.1000/abc", "10.1234/x", None, None, None, None, "10.123456789/a/b", None, None, None, None, "10.1000/y"]
    lists = spark.createDataFrame([(["x", None, "10.1000/a.", "10.1000/b"],), ([],), (None,)], "t array<string>")
    assert [r[0] for r in lists.select(H.first_doi(F.col("t"))).collect()] == ["10.1000/a", None, None]
    titles = ["Web Logs, version 3.1 [2001]", "v2 of Traces v 3", "version 1998 2 x", "Index 2010 vol 12", "VLDB v v2 versions version3", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in titles], "t string").select(H.family_label(F.col("t"))).collect()]
    assert got == ["web logs", "of traces", "x", "index vol", "vldb v versions", None]
    names = [("Common-Crawl x", "COMMON_CRAWL_CORPUS_EXCLUDED"), ("cc_1998", "COMMON_CRAWL_CORPUS_EXCLUDED"), ("ccx", "LOCAL_DISCOVERY"), ("cc", "LOCAL_DISCOVERY"), ("ISC survey", "ISC_REFERENCE"), ("a network wizards b", "ISC_REFERENCE"), ("Official Pool", "OFFICIAL_POOL"), ("v3/candidate/pool", "OFFICIAL_POOL"), ("official pool 2", "LOCAL_DISCOVERY"), ("", "LOCAL_DISCOVERY")]
    got = spark.createDataFrame(names, "n string, want string").select(H.classify_source(F.col("n")).alias("got"), "want").collect()
    assert all(r["got"] == r["want"] for r in got)

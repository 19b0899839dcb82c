"""Places in files over many splits, against plain reads: line numbers, and records of WARC and ARC files."""

import gzip
import random

import pytest

from yearmask.sources import framing


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes."""
    conf = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_line_numbers(spark, tmp_path, small_splits):
    r = random.Random(1)
    files = {f"{n}.txt": [("x" * r.choice([0, 1, 30, 900])) + str(i) * r.choice([0, 1]) for i in range(r.choice([1, 7, 120]))] for n in range(5)}
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join(lines) + r.choice(["", "\n"]))
        with gzip.open(tmp_path / f"{name}.gz", "wt") as f:
            f.write("\n".join(lines) + "\n")
    (tmp_path / "none.txt").write_text("")
    rows = framing.read_numbered_lines(spark, f"file://{tmp_path}/*").collect()
    for name, lines in files.items():
        plain = (tmp_path / name).read_text().split("\n")
        plain = plain[:-1] if plain[-1] == "" else plain
        for form, want in ((name, plain), (f"{name}.gz", lines)):
            assert sorted((x.line, x.value) for x in rows if x.file.endswith(f"/{form}")) == list(enumerate(want, 1))
    assert all(x.locator == f"{x.file}:{x.line}" for x in rows)


def test_lines_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a\nb\n")
    plan = framing.read_numbered_lines(spark, f"file://{tmp_path}/a.txt")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def warc(url, body, version=b"1.0", date=b"1998-02-03T00:00:00Z"):
    head = b"WARC/" + version + b"\r\nWARC-Type: response\r\n" + (b"WARC-Target-URI: <" + url + b">\r\n" if url else b"") + b"WARC-Date: " + date + b"\r\ncontent-length: %d\r\n\r\n" % len(body)
    return head + body, b"\r\n\r\n"


def arc(url, body):
    return b"%s 10.1.2.3 19990101000000 text/html %d\n" % (url, len(body)) + body, b"\n"


def archive(r, n):
    """(bytes, [(offset, length, url)]) of a file whose contents quote headers of their own."""
    out, want = b"", []
    for i in range(n):
        quoted = warc(b"http://evil.example/%d" % i, b"x" * r.choice([0, 5, 300]))[0]
        body = r.choice([b"", b"a\n\nb\n", quoted, quoted * 3, b"z" * 700, b"\n" * 40, b"\xff\x00\xfe\n" * 9, arc(b"http://evil.example/", b"abc")[0], b"WARC/1.0\r\n"])
        url = b"http://e.org/%d" % i
        if r.random() < 0.3:
            record, end = arc(url, body)
        else:
            url = url if r.random() < 0.8 else None
            record, end = warc(url, body, r.choice([b"1.0", b"1.1"]))
        want.append((len(out), len(record), url.decode() if url else None))
        out += record + end
    return out, want


@pytest.mark.parametrize("form", ["plain", "members", "one"])
def test_records(spark, tmp_path, small_splits, form):
    r = random.Random(7)
    wants = {}
    for n in (1, 4, 40):
        data, want = archive(r, n)
        if form == "plain":
            (tmp_path / f"{n}.warc").write_bytes(data)
        else:
            cuts = [0, *[w[0] for w in want[1:]], len(data)] if form == "members" else [0, len(data)]
            (tmp_path / f"{n}.warc.gz").write_bytes(b"".join(gzip.compress(data[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)))
        wants[f"{n}.warc"] = want
    (tmp_path / "none.warc").write_bytes(b"")
    rows = framing.read_archive_records(spark, f"file://{tmp_path}/*").collect()
    for name, want in wants.items():
        assert sorted((x.offset, x.length, x.url) for x in rows if f"/{name}" in x.file) == want
    assert len(rows) == sum(map(len, wants.values()))
    heads = framing.read_warc_headers(spark, f"file://{tmp_path}/*").collect()
    assert len(heads) == sum(u is not None for w in wants.values() for _, _, u in w)
    assert {(h.year, h.hint_mask, h.direct_mask) for h in heads} == {(1998, 4, 0), (1999, 8, 0)}


def test_parts_of_a_split(spark, tmp_path, monkeypatch):
    """Many candidates make several parts of one split."""
    data, want = archive(random.Random(3), 60)
    part = framing.Part("f", 0, 0)
    assert part.rows().num_rows == 1
    (tmp_path / "x.warc").write_bytes(data)
    rows = framing.read_archive_records(spark, f"file://{tmp_path}/x.warc").collect()
    assert sorted((x.offset, x.length, x.url) for x in rows) == want


def test_damaged_records(spark, tmp_path):
    """A record that is shorter or longer than it says, one without a length, and a header that is cut off."""
    short = warc(b"http://short/", b"abc")[0].replace(b"content-length: 3", b"content-length: 90") + b"\r\n\r\n"
    body = warc(b"http://inside/", b"q" * 30)[0] + b"\r\n\r\n"
    after, bare = warc(b"http://after/", b"x")[0] + b"\r\n\r\n", b"WARC/1.1\r\nWARC-Target-URI: http://bare/\r\n\r\n"
    (tmp_path / "d.warc").write_bytes(short + body + after + bare + after + b"WARC/1.0\r\nWARC-Target-URI: http://cut/\r\n")
    got = framing.read_archive_records(spark, f"file://{tmp_path}/d.warc").orderBy("offset").collect()
    assert [x.url for x in got] == ["http://short/", "http://after/", "http://bare/", "http://after/"]

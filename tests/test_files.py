"""Digests of files, the columns of delimited files, and the annual output with its audit."""

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from yearmask.operators import evidence as V
from yearmask.sources import schema, sinks


def test_digests_of_files(spark, tmp_path):
    r = random.Random(1)
    bodies = [b"", b"\n", b"a", b"a\n", b"a\n\n", b"\n\na", b"\r\n\xff\xfe\n", b"x" * 70_000 + b"\n" + b"y" * 9, "\n".join(str(r.random()) for _ in range(30_000)).encode()]
    for n, body in enumerate(bodies):
        (tmp_path / f"{n}.txt").write_bytes(body)
    (tmp_path / "p.gz").write_bytes(gzip.compress(b"a\nb\n"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    got = {x["path"].rsplit("/", 1)[1]: (x["length"], x["sha256"]) for x in sinks.manifest(spark, f"file://{tmp_path}/*").collect()}
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "1000"
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {p.name: (p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for p in tmp_path.iterdir()}


def test_a_file_larger_than_a_row(spark, tmp_path):
    """Three gigabytes, of which most are holes: zeros in lines of four megabytes."""
    path = tmp_path / "large.txt"
    with path.open("wb") as f:
        for i in range(1, 751):
            f.seek(i * 4_000_000)
            f.write(b"line\n")
    seen = hashlib.sha256()
    with path.open("rb") as f:
        while block := f.read(1 << 24):
            seen.update(block)
    rows = sinks.manifest(spark, f"file://{tmp_path}/*").collect()
    assert [(x["length"], x["sha256"]) for x in rows] == [(path.stat().st_size, seen.hexdigest())] and path.stat().st_size > 1 << 31


def lines(spark, files):
    return spark.createDataFrame([(f, n, v) for f, vs in files.items() for n, v in enumerate(vs, 1)], "file string, line long, value string").repartition(3)


def test_columns_of_delimited_files(spark):
    files = {
        "csv": ["Host,Timestamp,note", *[f'h{i}.org,1998-01-02,"a, {i}"' for i in range(5)], ""],
        "tsv": [f"x\t1999\thttp://h{i}.org/" for i in range(4)],
        "tie": [f"h{i}.org;g{i}.org;1999" for i in range(9)],
        "rare": [*[f"h{i}.org|1999" for i in range(8)], "x|y", "y|x"],
        "few": ["h1.org,1999", "h2.org,1999"],
        "plain": ["one host.org", "two"],
        "late": ["url,year,more", *[f"http://h{i}.org/,1997,x" for i in range(3)]],
        "quotes": [f'"h{i}.org";"say ""1999"""; 1998 ' for i in range(6)],
    }
    got = {x["file"]: x for x in schema.infer_columns(lines(spark, files)).collect()}
    assert set(got) == set(files) - {"plain"}
    want = {"csv": (",", True, 0, 1, 5, True), "tsv": ("\t", False, 2, 1, 4, False), "tie": (";", False, None, None, 9, False), "rare": ("|", False, None, None, 10, False), "few": (",", False, None, None, 2, False), "late": (",", True, 0, 1, 3, False), "quotes": (";", False, 0, 2, 6, False)}
    assert {f: (x["delimiter"], x["has_header"], x["host_column"], x["time_column"], x["records"], x["says_capture"]) for f, x in got.items()} == want
    assert got["rare"]["matched"] == 8 and got["rare"]["confidence"] == pytest.approx(0.8)
    hosts = {x["file"]: x["host_column"] for x in schema.infer_host_column(lines(spark, files)).collect()}
    assert hosts == {"csv": 0, "tsv": 2, "tie": None, "rare": None, "few": None, "late": 0, "quotes": 0}
    assert schema.infer_columns(lines(spark, {"a": ["x"]}).where("false")).count() == 0


def test_submission_and_its_audit(spark, tmp_path):
    rows = spark.createDataFrame([(f"h{i % 40}.org", 1996 + i % 3, i, f"s{i % 5}", "ia", "EXACT", "direct" if i % 2 else "query") for i in range(300)], "host string, year int, seq long, source_id string, provider string, kind string, lane string")
    path = f"file://{tmp_path}/out"
    sinks.write_submission(rows, path)
    masks = V.mask_by_host(rows)
    sound = sinks.audit_submission(spark, path, masks).collect()
    assert len(sound) == 3 and all(x["sound"] and x["lines"] == x["evidence_rows"] for x in sound)
    first = {(x["host"], x["year"]): x["seq"] for x in spark.read.parquet(f"{path}/evidence").collect()}
    assert first == {k: min(x["seq"] for x in rows.collect() if (x["host"], x["year"]) == k) for k in {(x["host"], x["year"]) for x in rows.collect()}}
    part = next((tmp_path / "out/lists/year=1996").glob("*.txt"))
    held = part.read_text().splitlines()
    part.write_text("\n".join([*held[1:], "zz.org", "aa.org"]) + "\n")
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    bad = {x["year"]: x for x in sinks.audit_submission(spark, path, masks.where("host <> 'h5.org'")).collect()}
    one = bad[1996]
    assert (one["unproven"], one["unlisted"], one["files_out_of_order"], one["sound"]) == (2, 1, 1, False)
    assert all(x["not_allowed"] >= (1 if x["year"] != 1996 else 2) for x in bad.values())


def test_fanout_sketches_merge(spark):
    from yearmask.operators import sketch as M

    rows = spark.range(30_000).select((F.col("id") % 3).alias("batch"), F.when(F.col("id") < 40, "small").when(F.col("id") < 29_000, "large").otherwise("some").alias("parent"), F.concat(F.lit("h"), F.col("id") % 9_000).alias("child"))
    apart = M.merged_fanout(M.fanout(rows, ["batch", "parent"], "child"), ["parent"])
    whole = M.fanout(rows, ["parent"], "child")
    assert sorted(map(tuple, apart.collect())) == sorted(map(tuple, whole.collect()))
    exact = {x["parent"]: x["n"] for x in rows.groupBy("parent").agg(F.countDistinct("child").alias("n")).collect()}
    assert all(x["children"] <= exact[x["parent"]] for x in whole.collect()) and {x["parent"]: x["children"] for x in whole.collect()}["small"] >= 20
    hll = {x["parent"]: x["children"] for x in M.merged_distinct(M.distinct_sketch(rows, ["batch", "parent"], "child"), ["parent"]).collect()}
    assert all(abs(hll[p] - n) <= 0.05 * n + 1 for p, n in exact.items())

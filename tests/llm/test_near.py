"""Near-duplicates by fingerprint and by embedding, components, and fixity audits, against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from yearmask.llm import common, embeddings, simhash, warc


def union_find(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def slow_print(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(300)], [(0, i) for i in range(1, 200)], None])
def test_components(spark, edges):
    r = random.Random(7)
    if edges is None:
        edges = [(r.randrange(400), r.randrange(400)) for _ in range(330)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(7)
    got = {x.node: x.root for x in common.components(frame).collect()}
    root = union_find(500, [e for e in edges if e[0] != e[1]])
    assert got == {n: root[n] for e in edges if e[0] != e[1] for n in e}


def test_fingerprints():
    r = random.Random(8)
    for t in ["", " \n\t", "One", "one two three", "A b C d", "é 日本\x0bx y z", "a\xa0b c d e"] + [" ".join(r.choice("abcdefg") for _ in range(r.randint(1, 50))) for _ in range(40)]:
        assert simhash.fingerprint(t.encode()) % (1 << 64) == slow_print(t), t
    assert simhash.fingerprint(b"x y " * 150_000) == simhash.fingerprint(b"x y " * 150_000)


def test_bit_sliced_comparison():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, size=300, dtype=np.uint64)
    b = a.copy()
    for i in range(300):
        for bit in rng.choice(64, size=i % 12, replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    for radius in range(8):
        assert sorted(simhash.near_pairs(a, b, radius)) == [i for i in range(300) if i % 12 <= radius]
    pairs = {(int(x), int(y)) for xs, ys in simhash.near_blocks(a, b, 4, queries=37) for x, y in zip(xs, ys, strict=True)}
    assert pairs == {(int(x), int(y)) for x in a for y in b if int(x ^ y).bit_count() <= 4}


@pytest.mark.parametrize(("piece", "small"), [(20_000, 64), (7, 3), (50, 64)])
def test_near_duplicates_with_hot_keys(spark, monkeypatch, piece, small):
    monkeypatch.setattr(simhash, "PIECE", piece)
    monkeypatch.setattr(simhash, "SMALL", small)
    r = random.Random(9)
    centre, prints = r.getrandbits(64), []
    for _ in range(150):  # one large group of near copies
        x = centre
        for b in r.sample(range(64), r.randint(0, 3)):
            x ^= 1 << b
        prints.append(x)
    prints += [centre] * 50 + [0] * 5 + [(1 << 64) - 1] + [r.getrandbits(64) for _ in range(200)]
    chain = r.getrandbits(64)
    for step in range(12):  # each linked with the next only
        prints.append(chain)
        for b in range(step * 4, step * 4 + 4):
            chain ^= 1 << b
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    rows = [(i + 10, x, "extra") for i, x in enumerate(signed)] + [(None, signed[0], "no id"), (None, 123456789, "alone")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, fingerprint long, root string").withColumns({c: F.lit("mine") for c in ("group", "component_id", "first", "node")})).collect()
    assert {(g.root, g.node, g["first"]) for g in got} == {(x, "mine", "mine") for x in ("extra", "no id", "alone")}
    assert len(got) == len(rows)
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    root = union_find(len(prints), links)
    assert {g.doc_id: g.component_id for g in got if g.doc_id is not None} == {i + 10: root[i] + 10 for i in range(len(prints))}
    assert [g.component_id for g in got if g.fingerprint == 123456789] == [None]


def test_near_duplicates_of_nothing(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, fingerprint long")).count() == 0
    docs = spark.createDataFrame([(1, None, "mine"), (2, "", "mine")], "doc_id long, text string, fingerprint string")
    assert {r.fingerprint for r in simhash.with_fingerprint(docs).collect()} == {0}


@pytest.mark.parametrize(("piece", "crowd", "tile", "plan", "crowded"), [(8192, 1024, 512, 0, 2), (9, 1024, 3, 0, 9999), (9, 4, 512, 1, 1), (4, 1024, 512, 0, 2), (8192, 4, 2, 2, 2), (8192, 1024, 512, 6, 2)])
def test_embeddings(spark, monkeypatch, piece, crowd, tile, plan, crowded):
    monkeypatch.setattr(embeddings, "PIECE", piece)
    monkeypatch.setattr(embeddings, "CROWDED", crowded)
    monkeypatch.setattr(embeddings, "CROWD", crowd)
    monkeypatch.setattr(embeddings, "TILE", tile)
    plans = ((None, *embeddings.PLANS[plan][1:]),)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 32))
    v = [base[i % 60] + rng.normal(size=32) * rng.choice([0.0, 0.05, 0.2, 0.3]) for i in range(300)]
    v = [x.astype(np.float32).tolist() for x in v] + [(2.5 * base[0]).tolist(), None, [], [0.0] * 32, [float("nan")] + [1.0] * 31, [None] + [1.0] * 31, [float("inf")] * 32, [1.0, 2.0], [1.0, 2.0], [1e-320] * 32, [1e200] * 32]
    rows = [(i, x, 1) for i, x in enumerate(v)] + [(None, v[0], 1), (5, v[5], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, kept int")
    got = embeddings.near_duplicates(df, plans=plans).collect()
    assert len(got) == len(rows)
    usable = [(i, x) for i, (_, x, _) in enumerate(rows) if rows[i][0] is not None and x and None not in x and np.isfinite(x).all() and np.any(x)]

    def cosine(x, y):
        x, y = np.array(x) / np.max(np.abs(x)), np.array(y) / np.max(np.abs(y))
        return x @ y / np.linalg.norm(x) / np.linalg.norm(y)

    links = [(a, b) for k, (a, x) in enumerate(usable) for b, y in usable[:k] if len(x) == len(y) and cosine(x, y) >= 0.9]
    count, found = {i: 0 for i in range(len(rows))}, 0
    for a, b in links:
        count[a] += 1
        count[b] += 1
    root = union_find(len(rows), [(min(rows[a][0], rows[b][0]), max(rows[a][0], rows[b][0])) for a, b in links])
    wanted = {}
    for i, (vec, _, _) in enumerate(rows):
        wanted.setdefault(vec, []).append(count[i])
    for g in got:
        assert g.n_links <= max(wanted[g.vec_id])
        found += g.n_links
        if g.vec_id is None:
            assert (g.n_links, g.component_id, g.kept) == (0, None, False)
        else:
            assert g.kept == (g.vec_id == g.component_id)
    assert found >= 0.97 * 2 * len(links)
    assert sum(g.component_id == root[g.vec_id] for g in got if g.vec_id is not None) >= 0.97 * (len(rows) - 1)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_likely_partners_by_brute_force(monkeypatch):
    monkeypatch.setattr(embeddings, "CROWD", 12)
    r = np.random.default_rng(8)
    k = np.sort(np.concatenate([r.integers(0, 60, 300), np.full(40, 7), np.full(13, 61), np.full(12, 62)]))
    sketch, home = r.integers(0, 1 << 12, len(k)), r.random(len(k)) < 0.5
    batch = pa.RecordBatch.from_arrays([pa.array(k), pa.array(np.arange(len(k))), pa.array(sketch & 63), pa.array(sketch >> 6), pa.array(home)], names=["k", "id", "first", "second", "home"])
    crowds = {x for x in set(k) if (k == x).sum() > 12}
    want = {i for i in range(len(k)) if k[i] in crowds or any(i != j and k[i] == k[j] and (home[i] or home[j]) and int(sketch[i] ^ sketch[j]).bit_count() <= 3 for j in range(len(k)))}
    for size in (1, 5, 50, 1000):
        got = [x for out in embeddings.hopeful(3)(batch.slice(i, size) for i in range(0, len(k), size)) for x in out.column(1).to_pylist()]
        assert len(got) == len(set(got)) and set(got) == want


def test_near_pairs_meet_and_others_stay_apart(spark):
    """Pairs at a cosine of 0.9 to 0.92 are found, and the vectors that are fetched for others do not grow with their number."""
    r = np.random.default_rng(3)
    d, n = 48, 400
    x, z = (y / np.linalg.norm(y, axis=1, keepdims=True) for y in r.normal(size=(2, n, d)))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    cos = r.uniform(0.9001, 0.92, (n, 1))
    y = cos * x + np.sqrt(1 - cos**2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y, r.normal(size=(3000, d))]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for plan in embeddings.PLANS[1:5:3]:
        got = {g.vec_id: g for g in embeddings.near_duplicates(df, plans=((None, *plan[1:]),)).collect()}
        assert sum(got[n + i].component_id == i for i in range(n)) >= 0.95 * n
        assert all(g.n_links <= 1 for g in got.values()) and all(got[i].kept for i in range(2 * n, len(rows)))


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 8)) * 2
    a, _ = embeddings.d8(x)
    b, _ = embeddings.d8(x - 0.5)
    best = np.where((((x - a) ** 2).sum(axis=1) <= ((x - b - 0.5) ** 2).sum(axis=1))[:, None], a, b + 0.5)
    assert (np.abs(a.sum(axis=1)) % 2 == 0).all()
    assert (((x - best) ** 2).sum(axis=1) <= 1 + 1e-9).all()  # the covering radius of E8 is 1


def test_fixity_audit(spark):
    rows = [(i, f"http://x/{i}", "é<p>" * (i % 700)) for i in range(900)] + [(5, "http://x/5", None), (None, None, "lost id"), (None, "u", "lost id")]
    made = warc.records_of(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("length", F.lit("mine")))
    laid = warc.laid_out(made.withColumn("replica", warc.damaged_digest()), "replica").cache()
    records, replica = laid.drop("replica"), laid.where("replica is not null").drop("sha256").withColumnRenamed("replica", "sha256")
    assert warc.audit(records, records).count() == 0
    first = sorted(records.where("archive = 1").collect(), key=lambda r: r.offset)
    assert [r.offset for r in first] == [sum(x.length for x in first[:i]) for i in range(len(first))]
    got = {(r.record_id, r.status) for r in warc.audit(records, replica).collect()}
    assert got == {(i, "missing") for i in range(900) if i % 193 == 7} | {(i, "corrupt") for i in range(900) if i % 97 == 13 and i % 193 != 7}
    back = {(r.record_id, r.status) for r in warc.audit(replica, records).collect()}
    assert {i for i, s in back if s == "extra"} == {i for i in range(900) if i % 193 == 7}
    nothing = records.limit(0)
    assert warc.audit(nothing, nothing).count() == 0
    assert {r.status for r in warc.audit(records, nothing).collect()} == {"missing"}
    laid.unpersist()


def test_hot_archives_are_laid_out_in_ranges(spark):
    """Ids that are null or repeated put most records into one archive; clashing columns of the pages are left out."""
    r = random.Random(4)
    pages = [(r.choice([None, 3, 3, 3, i]), f"http://h/{i % 7}", "x" * r.randrange(40)) for i in range(900)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({c: F.lit("mine") for c in ("archive", "record", "offset", "level", "node", "__part", "__n")})
    made = warc.records_of(frame).cache()
    got = warc.laid_out(made).collect()
    by = {}
    for x in got:
        by.setdefault(x.archive, []).append(x)
    assert sum(map(len, by.values())) == 900 and max(map(len, by.values())) > 300
    for rows in by.values():
        rows.sort(key=lambda x: x.offset)
        at = 0
        for x in rows:
            assert x.offset == at
            at += x.length
        keys = [(x.record_id is not None, x.record_id or 0, x.sha256) for x in rows]
        assert keys == sorted(keys)
    listing = warc.laid_out(made)
    assert warc.audit(listing, listing).count() == 0
    twice = listing.unionByName(listing.where("record_id = 3").limit(2))
    assert warc.audit(listing, twice).count() == 2 and warc.audit(twice, twice).count() == 0


def test_records_longer_than_a_range(spark):
    rows = [(i, f"http://x/{i}", "é" * (70_000 if i % 5 == 0 else 10)) for i in range(60)]
    made = warc.records_of(spark.createDataFrame(rows, "page_id long, url string, html string"))
    listing = warc.laid_out(made)
    assert listing.where(F.col("length") > warc.RANGE).count() == 12
    bad = listing.withColumn("sha256", F.when(F.col("record_id").isin(10, 11), F.lit("rotten")).otherwise(F.col("sha256")))
    assert {(r.record_id, r.status) for r in warc.audit(listing, bad).collect()} == {(10, "corrupt"), (11, "corrupt")}


def test_replica_is_hashed_from_its_own_bytes(spark):
    rows = [(i, f"http://x/{i}", "é<p>" * (i % 70)) for i in range(300)] + [(13, "http://x/13", "again"), (13, "http://x/13", "and again"), (None, "u", "lost id")]
    made = warc.records_of(spark.createDataFrame(rows, "page_id long, url string, html string"))
    rotten = F.when(F.col("record_id") == 40, F.concat(F.lit("X"), F.expr("substring(record, 2)"))).otherwise(F.col("record"))
    # no digest of the primary reaches the replica, so a fault that nobody planted is found as well
    replica = warc.laid_out(warc.damaged_records(made).withColumn("record", rotten).withColumn("sha256", F.sha2("record", 256)), "lost", "written", by="written").where("not lost")
    got = {(r.record_id, r.status) for r in warc.audit(warc.laid_out(made), replica).collect()}
    assert got == {(i, "missing") for i in (7, 200)} | {(i, "corrupt") for i in (13, 110, 207, 40)}
    own = warc.damaged_records(made.withColumn("sha256", F.lit("of the primary"))).collect()
    assert all(r.sha256 == hashlib.sha256(r.record.encode()).hexdigest() and r.length == len(r.record.encode()) for r in own)

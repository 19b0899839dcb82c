"""Importance resampling, ranked search and sharding, against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from yearmask.llm import common, lexical, queries, resampling, sharding

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
ODD = [None, "", " \n", "...", "a", "The the THE", "Émile émile ÉMILE", "x" * 3000, "a b " * 40, "a b " * 40, "\x00\x7f{z}~9", "ß İ ŉ 中文 中文", "one two\nthree-four_five"]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def texts(n, seed):
    r = random.Random(seed)
    return [" ".join(r.choice("ab cd ef gh ij kl mn the of and Zz é".split()) + r.choice(["", str(r.randrange(30))]) for _ in range(r.choice([0, 3, 19, 20, 21, 60, 400]))) for _ in range(n)]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", ["op11_resampling", "op12_search", "op13_sharding"])
def test_registered(spark, sf, duck, name):
    got = queries.QUERIES[name](spark, sf)
    want = duck.execute(queries.ORACLES[name])
    order = [got.columns.index(c[0]) for c in want.description]
    assert Counter(tuple(r[i] for i in order) for r in got.collect()) == Counter(want.fetchall())


def test_word_pieces():
    for text in ODD + texts(20, 3):
        body = (text or "").encode()
        for size in (1, 7, 64, 1 << 20):
            assert [w.decode() for piece in common.word_pieces(body, size) for w in piece] == words(text)


@pytest.mark.parametrize("few", [100_000, 1])
def test_numbered_splits_hot_values(spark, monkeypatch, few):
    monkeypatch.setattr(common.broadcast_if_few, "__defaults__", (few,))  # values too many to be broadcast are joined
    rows = spark.range(20_000).select(F.when(F.col("id") < 15_000, 0).otherwise(F.col("id") % 5).alias("k"), (F.col("id") % 3).alias("v"), "id")
    got = common.numbered(rows, [F.col("v")], "at", within="k").toPandas()
    for _, part in got.groupby("k"):
        part = part.sort_values("at")
        assert part["at"].tolist() == list(range(len(part)))
        assert part["v"].is_monotonic_increasing
    whole = common.numbered(rows, [F.col("v").desc()], "at").toPandas().sort_values("at")
    assert whole["at"].tolist() == list(range(20_000)) and whole["v"].is_monotonic_decreasing
    assert common.numbered(rows.where("false"), [F.col("v")], "at").count() == 0


# resampling


def slow_draw(docs, target, percent=25, seed=7, least=20):
    def features(text):
        w = words(text)
        return [crc32(g.encode()) % 10000 for g in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]]

    own = [features(t) for _, t in docs]
    s, t = Counter(b for f in own for b in f), Counter(b for x in target for b in features(x))
    big_s, big_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    out = []
    for (i, text), f in zip(docs, own, strict=True):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = [(tuple(r), n + 1 if n < percent * len(able) // 100 else None) for n, r in enumerate(able)]
    return Counter((*r, n) for r, n in ranks) + Counter((*r, None) for r in out if r[1] < least)


def drawn(spark, docs, target, **more):
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"weight": F.lit("x"), "rank": F.lit(1.5)})
    got = resampling.drawn(frame.repartition(5), spark.createDataFrame([(t,) for t in target], "text string"), **more)
    return Counter(tuple(r) for r in got.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect())


def test_drawn(spark):
    docs = list(enumerate(ODD + texts(150, 1)))
    docs += docs[20:60] + [(None, t) for t in texts(12, 2)]  # repeated rows, ids that are null
    target = [*texts(5, 9), None, ""]
    assert drawn(spark, docs, target) == slow_draw(docs, target)
    assert drawn(spark, docs, [None], percent=60, seed=3, least_words=1) == slow_draw(docs, [None], 60, 3, 1)
    assert drawn(spark, [], target) == Counter()


def test_bit_sliced_sums_are_exact():
    r = np.random.default_rng(5)
    gain = r.integers(-30_000, 30_000, resampling.BUCKETS)
    counts = r.choice([0, 0, 0, 1, 2, 7, 255, 256, 1 << 33], size=(9, resampling.BUCKETS))
    plus, minus = (resampling.planes(np.maximum(sign * gain, 0)[None, :])[:, 0] for sign in (1, -1))
    assert resampling.sums(counts, plus, minus).tolist() == (counts @ gain).tolist()
    assert resampling.sums(counts * 0, plus, minus).tolist() == [0] * 9


def test_resampled_keeps_columns(spark):
    docs = spark.createDataFrame([(n, t, "s") for n, t in enumerate(texts(60, 4))], "doc_id long, text string, source string")
    got = resampling.resampled(docs, docs.limit(3), percent=50)
    assert got.columns == ["doc_id", "text", "source", "rank"]
    ranks = sorted(r["rank"] for r in got.collect())
    assert ranks == list(range(1, len(ranks) + 1)) and ranks


# search


def slow_search(docs, items, k):
    tf = [(i, Counter(words(t))) for i, t in docs]
    full = [c for _, c in tf if c]
    n, total = len(full), sum(c.total() for c in full)
    df = Counter(t for c in full for t in c)
    asked = {}
    for i, t in set(items):
        asked.setdefault(i, Counter()).update(words(t))
    out = []
    for item, q in asked.items():
        scores = []
        for i, c in tf:
            m = 75 + 25 * c.total() * n // max(total, 1)
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t, times in q.items() if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return Counter(out)


def searched(spark, docs, items, k):
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"n": F.lit("x"), "terms": F.lit(1.5), "score": F.lit(2)})
    asked = spark.createDataFrame(items, "item_id string, text string").withColumns({"item": F.lit(1), "doc_id": F.lit(3)})
    return Counter(tuple(r) for r in lexical.best_documents(frame.repartition(3), asked, k).select("item_id", "rank", "doc_id", "score").collect())


def test_search(spark):
    docs = list(enumerate(ODD + texts(200, 6)))
    docs += docs[30:60] + [(None, t) for t in texts(5, 7)]
    items = [(f"i{n}", t) for n, t in enumerate(ODD + texts(30, 8))]
    items += items[5:8] + [("i9", "ab cd"), (None, "ef gh the"), ("none", "qqq")]
    assert searched(spark, docs, items, 7) == slow_search(docs, items, 7)
    assert searched(spark, [], items, 7) == searched(spark, docs, [], 7) == Counter()


def test_search_in_blocks_groups_and_after_seeds(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 900)
    monkeypatch.setattr(lexical, "GROUP_TERMS", 20)
    monkeypatch.setattr(lexical, "MATRIX", 600)
    monkeypatch.setattr(lexical, "SEED_ROWS", 20)
    docs, items = list(enumerate(texts(150, 10))), [(f"i{n}", t[:60]) for n, t in enumerate(texts(30, 11))]
    assert searched(spark, docs, items, 5) == slow_search(docs, items, 5)


def test_walk_prunes(monkeypatch):
    """Documents of many topics: few of all pairs are scored, and none of the best is lost."""
    r = np.random.default_rng(2)
    topics, own, each = 40, 25, 60
    terms = np.concatenate([topic * own + r.permutation(own)[:12] for topic in range(topics) for _ in range(each)])
    number, sizes = topics * each, np.full(topics * each, 12)
    items = [(np.sort(topic * own + r.permutation(own)[:6]), np.ones(6, dtype=np.int64)) for topic in range(topics)]
    weight = r.integers(500, 5000, topics * own)
    search = lexical.Search(lexical.groups_of(items, weight), weight, number, int(sizes.sum()), 5, np.ones(topics, dtype=np.int64))
    best = search.begin()
    order = r.permutation(number)
    shuffled = terms.reshape(number, 12)[order]
    tfs = r.integers(1, 4, terms.size)
    search.look(best, order, [12] * number, sizes, shuffled.ravel(), tfs)
    matrix = np.zeros((number, topics * own), dtype=np.int64)
    matrix[np.repeat(np.arange(number), 12), shuffled.ravel()] = search.impacts([12] * number, sizes, shuffled.ravel(), tfs)
    for i, (t, q) in enumerate(items):
        scores = matrix[:, t] @ q
        first = np.lexsort((order, -scores))[:5]
        assert best.scores[i].tolist() == scores[first].tolist() and best.ids[i].tolist() == order[first].tolist()
    assert best.scored < topics * number / 10
    assert best.bounded + best.scored < topics * number / 5


# sharding


def slow_shard(key, weights):
    bids = []
    for i, w in enumerate(weights):
        digest = hashlib.sha256(f"{key}:{i // 4}".encode()).hexdigest()
        u = (int(digest[16 * (i % 4) :][:13], 16) + 0.5) / (1 << 52)
        bids.append((math.log(u) / w, -i) if w else (-math.inf, -i))
    return -max(bids)[1]


@pytest.mark.parametrize("weights", [[1.0], [1.0] * 24, [1, 2, 0, 5.5, 1]])
def test_shards(spark, weights):
    docs = spark.createDataFrame([(i, str(i)) for i in range(3000)], "doc_id long, text string").withColumns({"shard": F.lit("x"), "size": F.lit(1)})
    got = sharding.with_shard(docs, weights, grown=2.0)
    assert got.columns == ["doc_id", "text", "size", "shard", "grown_shard"]
    rows = got.collect()
    assert all(r["shard"] == slow_shard(r["doc_id"], weights) for r in rows)
    moved = [r for r in rows if r["shard"] != r["grown_shard"]]
    assert all(r["grown_shard"] == len(weights) for r in moved)
    share = Counter(r["grown_shard"] for r in rows)
    for i, w in enumerate([*weights, 2.0]):
        assert abs(share[i] - 3000 * w / (sum(weights) + 2)) < 5 * math.sqrt(3000 * (w + 0.01) / (sum(weights) + 2)) + 1


def test_a_shard_that_goes_gives_up_only_its_own(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    before = {r["doc_id"]: r["shard"] for r in sharding.with_shard(docs, [1, 1, 1, 1]).collect()}
    after = {r["doc_id"]: r["shard"] for r in sharding.with_shard(docs, [1, 0, 1, 1]).collect()}
    assert all(before[i] == after[i] for i in before if before[i] != 1) and set(after.values()) == {0, 2, 3}
    for wrong in ([], [0.0], [1, -1]):
        with pytest.raises(ValueError):
            sharding.with_shard(docs, wrong)


def test_listing(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(7, "other"), (7, "other"), (7, None)] * 50 + [(None, t) for t in texts(40, 12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"slot": F.lit("x"), "size": F.lit("y"), "__text": F.lit("z")}).repartition(4)
    got = sharding.listing(frame.drop("__text"), [1.0] * 6).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len((t or "").encode()) + 8, crc32((t or "").encode())) for i, t in rows)
    for shard in range(6):
        own = sorted((r for r in got if r["shard"] == shard), key=lambda r: r["slot"])
        assert [r["slot"] for r in own] == list(range(len(own)))
        keys = [(r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in own]
        assert keys == sorted(keys)
    for r in got:
        key = r["doc_id"] if r["doc_id"] is not None else f"none:{r['size'] - 8}:{r['text_crc32']}"
        assert r["shard"] == slow_shard(key, [1] * 6) and r["grown_shard"] == slow_shard(key, [1] * 7)
    assert sharding.listing(frame.where("false"), [1.0] * 6).count() == 0


def test_the_main_path_is_native(spark, sf):
    docs = common.table(spark, sf, "documents").select("doc_id", "text")
    plan = sharding.with_shard(docs, [1.0] * 24, grown=1.0)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_write_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i % 50, f"t{i}") for i in range(600)], "doc_id long, text string")
    listed = sharding.write_shards(docs, f"file://{tmp_path}/out", [1, 3], rows_per_file=100).collect()
    back = spark.read.parquet(f"file://{tmp_path}/out")
    assert sum(r["rows"] for r in listed) == back.count() == 600
    assert all(r["shard"] == slow_shard(r["doc_id"], [1, 3]) for r in back.collect())
    assert sum(r["bytes"] for r in listed) == sum(len(f"t{i}") for i in range(600))

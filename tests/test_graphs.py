"""Strong components and cycles without pairs of nodes, and sketches compared by bands."""

import random

import pytest
from pyspark.sql import functions as F

from yearmask.operators import graph as G
from yearmask.operators import sketch as M


def slow_components(edges):
    """Nodes on cycles by the components that mutual reachability makes."""
    after = {}
    for a, b in edges:
        after.setdefault(a, set()).add(b)

    def reach(a):
        seen, todo = set(), list(after.get(a, ()))
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += after.get(x, ())
        return seen

    far = {n: reach(n) for e in edges for n in e}
    return {frozenset(m for m in far if m == n or (m in far[n] and n in far[m])) for n in far} - {frozenset([n]) for n in far}


def components(spark, edges, rest):
    frame = spark.createDataFrame(edges or [(0, 0)], "parent long, child long")
    out = {}
    for r in G.strong_components(frame if edges else frame.where("false"), rest=rest).collect():
        assert r["node"] not in out.setdefault(r["component"], set())
        out[r["component"]].add(r["node"])
    assert all(c in nodes for c, nodes in out.items())
    return {frozenset(nodes) for nodes in out.values()}


@pytest.mark.parametrize(("kind", "rest"), [("none", 0), ("loop", 0), ("sparse", 0), ("rings", 8), *((k, 200_000) for k in ("none", "chain", "loop", "sparse", "dense", "rings"))])
def test_strong_components(spark, kind, rest):
    r = random.Random(5)
    edges = {
        "none": [], "chain": [(i + 1, i) for i in range(30)], "loop": [(1, 1), (1, 2)],
        "sparse": [(r.randrange(60), r.randrange(60)) for _ in range(70)], "dense": [(r.randrange(40), r.randrange(40)) for _ in range(160)],
        "rings": [(10 * k + i, 10 * k + (i + 1) % 7) for k in range(5) for i in range(7)] + [(3, 12), (15, 21), (30, 99), (98, 40)] + [(i, i + 1) for i in range(200, 212)],
    }[kind]
    assert components(spark, edges, rest) == slow_components(edges)


def test_a_large_ring_is_linear(spark):
    """A ring of 100,000 nodes with a tail: one component, found in rounds that double their reach, or in one task."""
    n = 100_000
    ring = spark.range(n).select(F.col("id").alias("parent"), ((F.col("id") + 1) % n).alias("child"))
    tail = spark.range(5).select((F.col("id") + n - 1).alias("parent"), (F.col("id") + n).alias("child"))
    for rest in (10_000, 200_000):
        got = G.strong_components(ring.unionByName(tail), rest=rest).agg(F.count("*"), F.countDistinct("component"), F.max("node")).first()
        assert tuple(got) == (n, 1, n - 1)


def test_rejected_batch_on_a_hub(spark):
    """A hub of 20,000 edges in and out, some on cycles: rows are edges, and depth keeps nodes alone."""
    n = 20_000
    edges = spark.range(n).select((F.col("id") + 1).alias("parent"), F.lit(0).cast("long").alias("child"))
    back = spark.range(0, n, 100).select(F.lit(0).cast("long").alias("parent"), (F.col("id") + 1).alias("child"))
    out = spark.range(n).select(F.lit(0).cast("long").alias("parent"), (F.col("id") + n + 1).alias("child"))
    got = G.rejected_batch(edges.unionByName(back).unionByName(out), spark.range(2 * n + 1).select(F.col("id").alias("node")))
    assert {r["reason"]: r["count"] for r in got.groupBy("reason").count().collect()} == {"cycle": 2 * n // 100, "depth": 2 * n - n // 100}
    assert G.depth_of(edges.unionByName(out), 4).agg(F.count("*"), F.max("max_depth"), F.min("max_depth")).first() == (n + 1, 2, 1)


def groups(seed, n):
    """Sets of all degrees of overlap, some equal, and one value that all hold."""
    r = random.Random(seed)
    base = [r.sample(range(10_000), 60) for _ in range(n // 6)]
    out = {}
    for i in range(n):
        core = base[i % len(base)]
        keep = r.choice([1.0, 1.0, 0.9, 0.8, 0.6, 0.3])
        out[f"g{i:03}"] = {v for v in core if r.random() < keep} | {r.randrange(10_000) for _ in range(int(60 * (1 - keep)))} | {-1}
    return out


def sketched(spark, sets):
    return M.minhash(spark.createDataFrame([(g, v) for g, vs in sets.items() for v in vs], "g string, v long"), "g", "v")


def test_similar_groups(spark):
    sets = groups(1, 120)
    sketch = sketched(spark, sets)
    minima = {r["g"]: r["minima"] for r in M.sketch_classes(sketch, "g").collect()}
    pairs, classes = M.similar(sketch, "g")
    pairs = {(r["left"], r["right"]): r["jaccard"] for r in pairs.collect()}
    of = {r["g"]: r["class"] for r in classes.collect()}
    assert set(of) == set(sets) and all(minima[g] == minima[c] and c <= g for g, c in of.items())
    near = {(a, b): sum(x == y for x, y in zip(minima[a], minima[b], strict=True)) / 64 for a in set(of.values()) for b in set(of.values()) if a < b}
    want = {p: j for p, j in near.items() if j >= 0.5}
    assert set(pairs) <= set(want) and all(pairs[p] == want[p] for p in pairs)
    assert len(want) > 50 and len(pairs) >= 0.95 * len(want)


def test_equal_groups_make_no_pairs(spark):
    sets = {f"g{i}": {1, 2, 3} for i in range(3000)} | {"x": {1, 2, 4}}
    pairs, classes = M.similar(sketched(spark, sets), "g", least=0.0)
    assert classes.count() == 3001 and classes.select("class").distinct().count() == 2 and pairs.count() <= 1


@pytest.mark.parametrize("size", [1, 2])
def test_overlap_penalty(spark, size):
    sets = groups(2, 90)
    sketch = sketched(spark, sets)
    minima = {r["g"]: r["minima"] for r in M.sketch_classes(sketch, "g").collect()}
    got = {r["g"]: r["penalty"] for r in M.overlap_penalty(sketch.where("g < 'g040'"), sketch.where("g >= 'g040'"), "g", size).collect()}
    want = {a: max(sum(x == y for x, y in zip(minima[a], minima[b], strict=True)) / 64 for b in sets if b >= "g040") for a in sets if a < "g040"}
    assert set(got) == set(want)
    assert got == want if size == 1 else all(got[g] == want[g] for g in want if want[g] >= 0.5)
    assert all(r["penalty"] == 0 for r in M.overlap_penalty(sketch, sketch.where("false"), "g").collect())

"""Source graphs and page links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearmask.functions.hosts import META_TERMS, RESOURCE_TERMS, canonical_url, is_bulk, link_hits, strip
from yearmask.streaming.evidence import work_folder


def reach(edges: DataFrame, hops: int) -> DataFrame:
    """(root, node, depth) of all nodes within ``hops`` of each root, each pair of node and depth once. ``hops``
    joins: the number of rounds is the bound, so no loop waits for data on the driver."""
    out = step = edges.select(F.col("parent").alias("root"), F.col("child").alias("node"), F.lit(1).alias("depth")).distinct()
    for _ in range(hops - 1):
        step = step.join(edges.withColumnRenamed("parent", "node"), "node").select("root", F.col("child").alias("node"), (F.col("depth") + 1).alias("depth")).distinct()
        out = out.unionByName(step)
    return out


def depth_of(edges: DataFrame, hops: int) -> DataFrame:
    """The largest distance to a descendant within ``hops``. Nodes are kept, not pairs of nodes."""
    below = edges.select(F.col("child").alias("parent"), F.col("parent").alias("child"))
    return walk_lengths(below, hops).select(F.col("node").alias("root"), F.col("hops").alias("max_depth"))


def descendant_reward(edges: DataFrame, rewards: DataFrame, hops: int, discount: float = 0.5) -> DataFrame:
    """The sum over descendants of reward times discount ** depth."""
    joined = reach(edges, hops).join(rewards.select("node", "reward"), "node")
    return joined.groupBy("root").agg(F.sum(F.col("reward") * F.pow(F.lit(discount), "depth")).alias("descendant_reward"))


def stored(pairs: DataFrame, what: str) -> DataFrame:
    """The rows, written to the shared folder once and read back."""
    path = work_folder(pairs.sparkSession, what)
    pairs.write.parquet(path)
    return pairs.sparkSession.read.schema(pairs.schema).parquet(path)


def walk_lengths(edges: DataFrame, most: int) -> DataFrame:
    """(node, hops) of all nodes with an edge into them: the length of the longest walk that ends there, ``most`` if it is
    longer still. Round k keeps nodes, not pairs of nodes: those that an edge joins to a node of round k - 1."""
    out = step = edges.select(F.col("child").alias("node")).distinct()
    out = out.withColumn("hops", F.lit(1))
    for k in range(2, most + 1):
        step = edges.join(step, F.col("parent") == F.col("node"), "left_semi").select(F.col("child").alias("node")).distinct()
        out = out.unionByName(step.withColumn("hops", F.lit(k)))
    return out.groupBy("node").agg(F.max("hops").alias("hops"))


def spread_largest(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, value): the largest value of a node and of all nodes that a walk leads from to it. nodes: (node, value).

    A round takes the values of the neighbours before a node, and of one node further back, twice as far each time: so a
    chain or a ring of n nodes takes some log2(n) rounds, other graphs at most as many as their longest shortest walk.
    Values are pre-aggregated before they meet a node with very many neighbours.
    """
    far = edges.groupBy(F.col("child").alias("node")).agg(F.min("parent").alias("far"))
    now = stored(nodes.join(far, "node", "left").select("node", "value", "far"), "spread")
    while True:
        near = edges.join(now.select(F.col("node").alias("parent"), F.col("value").alias("v")), "parent").groupBy(F.col("child").alias("node")).agg(F.max("v").alias("near"))
        back = now.select(F.col("node").alias("far"), F.col("value").alias("leap"), F.col("far").alias("further"))
        step = now.join(near, "node", "left").join(back, "far", "left")
        after = stored(step.select("node", F.greatest("value", "near", "leap").alias("value"), F.coalesce("further", "far").alias("far"), (F.greatest("value", "near", "leap") != F.col("value")).alias("moved")), "spread")
        if after.where("moved").isEmpty():
            return after.select("node", "value")
        now = after.drop("moved")


def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of the nodes on cycles of a graph that fits a task: nodes by the time that a walk is done with
    them, then walks against the edges from the last of them."""
    after: dict[int, list[int]] = {}
    before: dict[int, list[int]] = {}
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            after.setdefault(a, []).append(b)
            before.setdefault(b, []).append(a)
    order, seen = [], set()
    for start in after:
        stack = [(start, iter(after[start]))] if start not in seen else []
        seen.add(start)
        while stack:
            node, rest = stack[-1]
            following = next((x for x in rest if x not in seen), None)
            if following is None:
                order.append(node)
                stack.pop()
            else:
                seen.add(following)
                stack.append((following, iter(after.get(following, ()))))
    component: dict[int, int] = {}
    for root in reversed(order):
        stack = [root] if root not in component else []
        while stack:
            node = stack.pop()
            if node not in component:
                component[node] = root
                stack += [x for x in before.get(node, ()) if x not in component]
    names = list(component)
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array([component[n] for n in names], pa.int64())], names=["node", "component"])


def strong_components(edges: DataFrame, seed: int = 3, rest: int = 200_000) -> DataFrame:
    """(node, component) of the nodes that lie on cycles: two are in one component iff walks lead from each to the other.

    Colouring: nodes get numbers by a hash, and each the largest number of any node that leads to it. The node of that
    number, and those of its colour that lead back to it, are a component. Edges between colours lie on no cycle and go,
    as do the nodes that are settled; what is left is coloured anew. Rows are nodes and edges, never pairs of nodes: output
    and every table on the way are linear in the graph, whatever its cycles. Once no more than ``rest`` edges are left, one
    task finishes them. Nodes are 64-bit numbers.
    """
    left = stored(edges.where("parent <> child").select(F.col("parent").cast("long"), F.col("child").cast("long")).distinct(), "edges")
    found: list[DataFrame] = []
    round_ = 0
    while (n := left.count()) > rest:
        nodes = left.select(F.explode(F.array("parent", "child")).alias("node")).distinct()
        number = F.struct(F.xxhash64("node", F.lit(seed + round_)).alias("h"), F.col("node").alias("n"))
        colour = stored(spread_largest(left, nodes.select("node", number.alias("value"))), "colours")
        a, b = (colour.select(F.col("node").alias(end), F.col("value").alias(f"{end}_colour")) for end in ("parent", "child"))
        same = stored(left.join(a, "parent").join(b, "child").where("parent_colour = child_colour").select("parent", "child"), "edges")
        inside = same.select(F.explode(F.array("parent", "child")).alias("node")).distinct()
        begin = inside.join(colour, "node").select("node", (F.col("value.n") == F.col("node")).cast("int").alias("value"))
        backward = same.select(F.col("child").alias("parent"), F.col("parent").alias("child"))
        settled = spread_largest(backward, begin).where("value = 1").select("node")
        component = stored(settled.join(colour, "node").select("node", F.col("value.n").alias("component")), "components")
        found.append(component)
        gone = component.select("node")
        left = stored(same.join(gone.withColumnRenamed("node", "parent"), "parent", "left_anti").join(gone.withColumnRenamed("node", "child"), "child", "left_anti"), "edges")
        round_ += 1
    last = left.coalesce(1) if n else left
    every = last.mapInArrow(finish, "node long, component long")
    for component in found:
        every = every.unionByName(component)
    every = stored(every, "components")
    size = every.groupBy("component").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return every.join(size, "component", "left_semi").select("node", "component")


def rejected_batch(edges: DataFrame, nodes: DataFrame, max_graph_hops: int = 4) -> DataFrame:
    """Edges with the first reason why a batch may not have them: self edges, unknown ends, repeated ones, cycles of
    any length, and more than ``max_graph_hops`` edges in a row through the edge.

    Edges that could never be stored (self edges, unknown ends) take no part in cycles and rows of edges. The batch is
    judged as one graph: all edges of a cycle are rejected, and walks that a cycle makes endless are too long.
    """
    known = nodes.select("node").distinct()
    seen = edges.groupBy("parent", "child").agg(F.count("*").alias("n"))
    for end in ("parent", "child"):
        seen = seen.join(known.select(F.col("node").alias(end), F.lit(True).alias(f"has_{end}")), end, "left")
    seen = stored(seen, "batch")
    graph = seen.where("parent <> child and has_parent and has_child").select("parent", "child")
    above = walk_lengths(graph, max_graph_hops).select(F.col("node").alias("parent"), F.col("hops").alias("above"))
    below = walk_lengths(graph.select(F.col("child").alias("parent"), F.col("parent").alias("child")), max_graph_hops).select(F.col("node").alias("child"), F.col("hops").alias("below"))
    hops = F.coalesce("above", F.lit(0)) + 1 + F.coalesce("below", F.lit(0))
    deep = stored(graph.join(above, "parent", "left").join(below, "child", "left").withColumn("hops", hops).where(F.col("hops") > max_graph_hops), "deep")
    # a walk may go round a cycle for ever, so only edges with the longest walks on both sides can lie on one
    core = deep.where((F.col("above") == max_graph_hops) & (F.col("below") == max_graph_hops))
    within = strong_components(core.select("parent", "child"))
    first, second = (within.select(F.col("node").alias(end), F.col("component").alias(f"{end}_component")) for end in ("parent", "child"))
    back = core.select("parent", "child").join(first, "parent").join(second, "child").where("parent_component = child_component").select("parent", "child", F.lit(True).alias("back"))
    marked = seen.join(deep.select("parent", "child", "hops"), ["parent", "child"], "left").join(back, ["parent", "child"], "left")
    unknown = F.col("has_parent").isNull() | F.col("has_child").isNull()
    reason = F.when(F.col("parent") == F.col("child"), "self_edge").when(unknown, "unknown_node").when(F.col("n") > 1, "duplicate").when(F.col("back"), "cycle").when(F.col("hops").isNotNull(), "depth")
    return marked.withColumn("reason", reason).where("reason is not null").select("parent", "child", "reason")


def absolute(href: Column, page: Column) -> Column:
    """The address that a link of a page means: whole, without scheme, from the root, a query, or relative to the page's
    folder; null for fragments, empty links and schemes that are not HTTP."""
    scheme, base = F.regexp_extract(page, "^(https?):", 1), F.regexp_extract(page, "^(https?://[^/?#]+)", 1)
    path = F.regexp_extract(page, "^https?://[^/?#]+([^?#]*)", 1)
    folder = F.concat(base, F.when(path.contains("/"), F.regexp_extract(path, "^(.*/)", 1)).otherwise("/"))
    return (
        F.when(href.rlike("(?i)^https?://"), href)
        .when(href.rlike("(?i)^[a-z][a-z0-9+.-]*:") | (href == "") | href.startswith("#"), None)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(base, href))
        .when(href.startswith("?"), F.concat(base, path, href))
        .otherwise(F.concat(folder, href))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """(page_url, url, anchor) of each link of raw pages, addresses made absolute and canonical, anchors without the
    tags in them. Addresses may stand in double quotes, in single ones or in none; a link ends at its closing tag, at the
    next link or with the page."""
    found = F.regexp_extract_all("html", F.lit(r"(?is)(<a\s[^>]*>.*?)(?=</a\s*>|<a\s|\z)"), 1)
    rows = pages.select(F.col("url").alias("page_url"), F.explode(found).alias("a"))
    attributes, inner = F.regexp_extract("a", r"(?is)^<a(\s[^>]*)>", 1), F.regexp_extract("a", r"(?s)^[^>]*>(.*)\z", 1)
    forms = [F.regexp_extract(attributes, rf"(?is)\shref\s*=\s*{form}", 1) for form in ('"([^"]*)"', "'([^']*)'", "([^\\s\"'>]+)")]
    href = strip(F.greatest(*forms))  # one of them at most is not empty
    return rows.select("page_url", canonical_url(absolute(href, F.col("page_url"))).alias("url"), F.regexp_replace(inner, "<[^>]*>", "").alias("anchor")).where("url is not null")


def link_summary(links: DataFrame) -> DataFrame:
    """Per address the distinct referrers, observations, most hits of terms, and whether it is a bulk file."""
    path = F.regexp_extract("url", r"^[^/]*//[^/]*(.*)\z", 1)
    text = F.concat_ws(" ", path, "anchor")
    return links.groupBy("url").agg(
        F.countDistinct("page_url").alias("referrers"), F.count("*").alias("observations"), F.max(link_hits(text, RESOURCE_TERMS)).alias("resource_hits"),
        F.max(link_hits(text, META_TERMS)).alias("meta_hits"), F.bool_or(is_bulk(F.col("url"))).alias("bulk"),
    )


def link_score() -> Column:
    """K8: the integer score of an address."""
    return F.when(F.col("bulk"), 100).otherwise(0) + F.least(F.lit(20), F.col("referrers") * 4) + F.least(F.lit(20), F.col("resource_hits") * 5) + F.least(F.lit(15), F.col("meta_hits") * 5) + F.least(F.lit(10), F.col("observations"))


def promoted(summary: DataFrame, least_referrers: int = 2, most: int = 64) -> DataFrame:
    """K8: the best addresses; those that are no bulk files need several referrers."""
    return summary.where(F.col("bulk") | (F.col("referrers") >= least_referrers)).withColumn("score", link_score().cast("long")).orderBy(F.desc("score"), "url").limit(most)

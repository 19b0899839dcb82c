"""Quality classifier: a sparse ensemble of rules over text statistics.

Boosted shallow trees propose rules: each path from a root is a conjunction of comparisons. A lasso logistic regression
over the rules keeps few of them, and those are compiled to one Spark column expression, which scores all documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearmask.llm.common import discard, materialize, text_bytes

UPPER, LOWER, DIGIT, SPACE = (bytes(range(a, b)) for a, b in ((65, 91), (97, 123), (48, 58), (9, 14)))
HIGH = bytes(range(128, 256))
SENTENCE = b".,;:?'\"-()"
SYMBOL = bytes(c for c in range(33, 127) if c not in UPPER + LOWER + DIGIT + SENTENCE)

STATISTICS = (
    "n_words", "word_length", "longest_word", "upper", "lower", "digit", "high", "sentence", "symbol", "bang", "bar",
    "dollar", "hash", "percent", "ampersand", "star", "distinct_words", "top_word", "neighbours", "line_words",
    "distinct_lines", "short_lines", "ended_lines",
)


def statistics(text: bytes) -> list[float]:
    """The statistics of one whole text, in the order of STATISTICS; all are 0 for a text without words."""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(text)

    def part(chars: bytes) -> float:
        return (size - len(text.translate(None, chars))) / size

    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [
        float(n), (size - text.count(b" ")) / n, float(max(map(len, counts))), part(UPPER), part(LOWER), part(DIGIT), part(HIGH), part(SENTENCE), part(SYMBOL),
        text.count(b"!") / n, text.count(b"|") / n, text.count(b"$") / n, text.count(b"#") / n, text.count(b"%") / n, text.count(b"&") / n, text.count(b"*") / n,
        len(counts) / n, max(counts.values()) / n, sum(map(bytes.__eq__, words, words[1:])) / n, n / len(lines), len(set(lines)) / len(lines),
        sum(len(x) < 20 for x in lines) / len(lines), sum(x.rstrip().endswith((b".", b"!", b"?")) for x in lines) / len(lines),
    ]


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the statistics of each whole text as columns ``s_<name>`` (doubles); columns of those names are replaced."""
    names = [f"s_{s}" for s in STATISTICS]
    kept = docs.drop(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                got = np.array([statistics(t) for t in text_bytes(part.column(part.schema.get_field_index(text)))])
                yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(np.ascontiguousarray(x)) for x in got.T]], names=[*part.schema.names, *names])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *[T.StructField(x, T.DoubleType()) for x in names]]))


#: a rule: comparisons (statistic, threshold, whether above it) that all hold
Rule = tuple[tuple[int, float, bool], ...]


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for f, t, above in rule:
        out &= (x[:, f] > t) == above
    return out


def paths(x: np.ndarray, cuts: list[np.ndarray], binned: np.ndarray, gradient: np.ndarray, weight: np.ndarray, depth: int, least: int) -> list[tuple[Rule, np.ndarray, float]]:
    """(rule, rows, Newton step) of every node of one tree that is grown level by level on binned values."""
    out: list[tuple[Rule, np.ndarray, float]] = []
    level: list[tuple[Rule, np.ndarray]] = [((), np.arange(len(x)))]
    for _ in range(depth):
        below = []
        for rule, rows in level:
            g, h = gradient[rows], weight[rows]
            best = (1e-6, -1, -1)
            whole = g.sum() ** 2 / (h.sum() + 1)
            for f, cut in enumerate(cuts):
                if not len(cut):
                    continue
                b = binned[rows, f]
                gs, hs, ns = (np.cumsum(np.bincount(b, v, minlength=len(cut) + 1))[:-1] for v in (g, h, None))
                gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - whole
                gain[(ns < least) | (len(rows) - ns < least)] = 0
                k = int(gain.argmax())
                best = max(best, (float(gain[k]), f, k))
            _, f, k = best
            if f < 0:
                continue
            above = binned[rows, f] > k
            for side in (False, True):
                r = (*rule, (f, float(cuts[f][k]), side))
                below.append((r, rows[above == side]))
                out.append((r, below[-1][1], float(-gradient[below[-1][1]].sum() / (weight[below[-1][1]].sum() + 1))))
        level = below
    return out


def propose(x: np.ndarray, y: np.ndarray, trees: int, depth: int, rate: float, bins: int) -> list[Rule]:
    """The distinct rules on the paths of boosted trees."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    cuts = [c[c < x[:, i].max()] for i, c in enumerate(cuts)]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
    least = max(2, len(x) // 500)
    margin = np.full(len(x), np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9)))
    rules: dict[Rule, None] = {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        for rule, rows, step in paths(x, cuts, binned, p - y, p * (1 - p), depth, least):
            rules[tuple(sorted(rule))] = None
            if len(rule) == depth:
                margin[rows] += rate * step
    return list(rules)


def lasso(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Lasso logistic weights and intercept, by accelerated proximal gradient steps on standardised rules."""
    mean, scale = r.mean(axis=0), r.std(axis=0) + 1e-9
    s = (r - mean) / scale
    n, k = s.shape
    v = np.ones(k)
    for _ in range(20):  # the largest eigenvalue bounds the curvature
        v = s.T @ (s @ v)
        top = np.linalg.norm(v)
        v = v / (top + 1e-12)
    rate = 4 * n / (top + n)
    w = look = np.zeros(k)
    b = look_b = np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9))
    t = 1.0
    for _ in range(steps):
        g = 1 / (1 + np.exp(-(s @ look + look_b))) - y
        new = look - rate * (s.T @ g) / n
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        new_b = look_b - rate * g.mean()
        u = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, look_b = new + (t - 1) / u * (new - w), new_b + (t - 1) / u * (new_b - b)
        w, b, t = new, new_b, u
    w = np.where(np.abs(w) < 1e-9, 0, w / scale)
    return w, float(b - mean @ w)


@dataclass
class Ensemble:
    rules: list[Rule]
    weights: list[float]
    intercept: float

    def score(self) -> Column:
        """The probability as one expression over the columns ``s_<statistic>``: no Python where it is evaluated."""
        margin = F.lit(self.intercept)
        for rule, w in zip(self.rules, self.weights, strict=True):
            test = F.lit(True)
            for f, t, above in rule:
                c = F.col(f"s_{STATISTICS[f]}")
                test = test & (c > F.lit(t) if above else c <= F.lit(t))
            margin = margin + F.when(test, F.lit(w)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, rate: float = 0.4, bins: int = 48, penalty: float = 0.0008) -> Ensemble:
    """An ensemble from statistics and labels 0 and 1. Without both labels it scores the smoothed share of 1."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Ensemble([], [], float(np.log(share / (1 - share))))
    rules = propose(x, y.astype(float), trees, depth, rate, bins)
    w, b = lasso(np.stack([holds(r, x) for r in rules], axis=1).astype(np.float32), y.astype(float), penalty) if rules else (np.zeros(0), float(np.log(y.mean() / (1 - y.mean()))))
    kept = np.flatnonzero(w)
    return Ensemble([rules[i] for i in kept], [float(w[i]) for i in kept], b)


def labelled(docs: DataFrame, labels: DataFrame, most: int = 40_000, seed: int = 8) -> DataFrame:
    """Rows of docs (doc_id and more) that have a label in ``labels`` (doc_id, quality 0 or 1), with the label as ``__y``.

    At most about ``most`` distinct labels take part: more are drawn by a hash of the id. They are broadcast, so docs are
    not shuffled. Null labels and ids are left out; a document with several labels is there once for each.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("__y")).distinct()
    n = known.count()
    if n > most:
        known = known.where(F.pmod(F.xxhash64(F.col("__id"), F.lit(seed)), F.lit(1 << 30)) < F.lit(int(most / n * (1 << 30))))
    return docs.join(F.broadcast(known), F.col("doc_id") == F.col("__id")).drop("__id")


def train_on(stats: DataFrame, most: int = 40_000, seed: int = 8) -> Ensemble:
    """Fits on rows of (doc_id, the statistics, __y) as of ``labelled``; repeated rows count once. About ``most`` rows reach
    the driver: if ids with many different texts make more, they are drawn by a hash of the row."""
    names = [f"s_{s}" for s in STATISTICS]
    known, path = materialize(stats.select("doc_id", "__y", *names).distinct(), "labelled")
    n = known.count()
    if n > most:
        known = known.where(F.pmod(F.xxhash64("doc_id", "__y", *names, F.lit(seed)), F.lit(1 << 30)) < F.lit(int(most / n * (1 << 30))))
    got = known.toPandas().sort_values(["doc_id", "__y", *names], kind="stable")
    discard(stats.sparkSession, path)
    return fit(got[names].to_numpy(dtype=float), got["__y"].to_numpy())


def train(stats: DataFrame, labels: DataFrame, most: int = 40_000, seed: int = 8) -> Ensemble:
    """Fits on the rows of ``stats`` (doc_id and the statistics) that ``labelled`` draws."""
    return train_on(labelled(stats, labels, most, seed), most, seed)


def with_quality(stats: DataFrame, model: Ensemble, threshold: float = 0.3, score: str = "score", predicted: str = "predicted") -> DataFrame:
    """Adds the score and predicted (1 if score >= threshold, else 0). Null and empty texts have statistics of 0 and are
    scored like any other; every row stays."""
    return stats.withColumn(score, model.score()).withColumn(predicted, (F.col(score) >= threshold).cast("int"))

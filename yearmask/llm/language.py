"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the hashed 1- to 3-grams of a text's letters (lower-cased; runs of anything else are one space). Document
frequencies come from all training rows, the weights from a bounded sample of them, by follow-the-regularised-leader
steps with an elastic-net penalty, which leaves most weights at zero; one temperature, fitted on sampled rows that took
no part in the fit, calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearmask.llm.common import discard, materialize

BUCKETS = 1 << 16
#: an odd multiplier for each length of n-gram
SPREAD = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)
LETTER: np.ndarray | None = None


def letters() -> np.ndarray:
    global LETTER
    if LETTER is None:
        LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return LETTER


def grams(text: str | None) -> np.ndarray | None:
    """The bucket of every n-gram of the whole text, repeats included; None if it has no letter."""
    if not text:
        return None
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = letters()[c]
    if not is_letter.any():
        return None
    c = np.where(is_letter, c, 32)
    space = c == 32
    c = c[~(space & np.concatenate([[False], space[:-1]]))]
    c = np.concatenate([[32], c, [32]]).astype(np.uint32)
    two = c[:-1] * np.uint32(0x01000193) ^ c[1:]
    three = two[:-1] * np.uint32(0x01000193) ^ c[2:]
    return np.concatenate([(x * np.uint32(m)) >> np.uint32(16) for x, m in zip((c, two, three), SPREAD, strict=True)])


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (BUCKETS + 1, languages), inverse document frequencies multiplied in; the last row is the bias
    temperature: float
    usual: float = 0.0  # a score that all but 1 in 500 texts of known languages reach, with a margin if few were seen

    def logits(self, text: str | None) -> np.ndarray | None:
        g = grams(text)
        return None if g is None else self.weights[g].sum(axis=0) / len(g) + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or (z := self.logits(text)) is None:
            return "und", 0.0
        z = np.exp((z - z.max()) / self.temperature)
        k = int(z.argmax())
        return self.languages[k], float(z[k] / z.sum())


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[int, np.ndarray]:
    """(documents with letters, documents of each bucket), over all rows. Each task sums its own rows first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for t in batch.column(0):
                g = grams(t.as_py())
                if g is not None:
                    seen = np.zeros(BUCKETS, dtype=bool)
                    seen[g] = True
                    df += seen
                    n += 1
        if n:
            at = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], names=["bucket", "n"])

    df, n = np.zeros(BUCKETS), 0
    for row in docs.select(text).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS + 1 rows
        if row.bucket < 0:
            n = row.n
        else:
            df[row.bucket] = row.n
    return n, df


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = 4, alpha: float = 2.0, beta: float = 0.05, l1: float = 0.002, l2: float = 0.002) -> np.ndarray:
    """Weights (BUCKETS + 1, classes) from rows of (features, values, class), one step a row, in the order given."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        return np.where(np.abs(z[at]) <= l1, 0.0, -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for at, x, k in rows:
            w = weights(at)
            p = np.exp((s := x @ w) - s.max())
            p /= p.sum()
            p[k] -= 1
            g = x[:, None] * p
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    return weights(slice(None))


def temperature(logits: np.ndarray, classes: np.ndarray) -> float:
    """The temperature of least cross-entropy, on a fine logarithmic grid."""
    best = (np.inf, 1.0)
    for t in np.geomspace(0.02, 20, 200):
        s = logits / t
        s = s - s.max(axis=1, keepdims=True)
        best = min(best, (float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), classes]).mean()), float(t)))
    return best[1]


def drawn_features(sample: DataFrame, most: int, seed: int) -> tuple[DataFrame, str]:
    """(at, c, lang) of sampled texts, by a hash of the text as many as have about ``most`` features in all: long texts make
    fewer rows, never a larger driver. The one that begins beyond the bound is the first that is left out."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, k, h in zip(*batch.columns, strict=True):
                g = grams(t.as_py())
                if g is not None:
                    at, c = np.unique(g, return_counts=True)
                    yield pa.RecordBatch.from_pydict({"at": pa.array([at.astype("<i4").tobytes()], pa.binary()), "c": pa.array([c.astype("<i4").tobytes()], pa.binary()), "lang": [k.as_py()], "n": pa.array([len(at)], pa.int64()), "h": [h.as_py()]})

    hashed = sample.select("text", "lang", F.xxhash64("text", F.lit(seed + 1)).alias("h"))
    stored, path = materialize(hashed.mapInArrow(features, "at binary, c binary, lang string, n long, h long"), "features")
    total = 0
    for h, n in stored.select("h", "n").orderBy("h").collect():  # two numbers for each sampled text
        if total >= most:
            return stored.where(F.col("h") < h).select("at", "c", "lang"), path
        total += n
    return stored.select("at", "c", "lang"), path


def train(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = 1500, most: int = 12_000, seed: int = 10, most_features: int = 24_000_000) -> Model:
    """A model of the non-null languages of docs, at most 1,000 of them (more are an error).

    The weights are fitted on about ``per_language`` texts of each language, fewer if there would be more than ``most`` in
    all, and no more than have about ``most_features`` features (16 bytes each on the driver), which very long texts have
    sooner. They are drawn by a hash of the text, copies counting once, so a table gives the same model however its rows are
    dealt and ordered, and a text with many copies is one text. Rows without letters are left out; without any row there
    are no languages, and every prediction is ``und``.
    """
    known = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).limit(1001).collect()}
    if len(counts) > 1000:
        raise ValueError("more than 1,000 languages")
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((BUCKETS + 1, 0)), 1.0)
    n, df = document_frequencies(known)
    idf = np.log((n + 1) / (df + 1)) + 1
    each = min(per_language, max(1, most // len(languages)))
    bound = F.element_at(F.create_map(*[F.lit(x) for k, v in counts.items() for x in (k, int(min(1.0, each / v) * (1 << 30)))]), F.col("lang"))
    sample = known.where(F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(1 << 30)) < bound).distinct()

    chosen, path = drawn_features(sample, most_features, seed)
    rows = []
    for r in chosen.toLocalIterator():
        at, c = np.frombuffer(r["at"], dtype="<i4"), np.frombuffer(r["c"], dtype="<i4").astype(float)
        rows.append((np.append(at, BUCKETS), np.append(idf[at] * c / c.sum(), 1.0), languages.index(r["lang"])))
    discard(docs.sparkSession, path)
    rows.sort(key=lambda r: (r[2], len(r[0]), r[0].tobytes(), r[1].tobytes()))  # the same whatever order they came in
    rows = [rows[i] for i in np.random.default_rng(seed).permutation(len(rows))]
    fit, held = [r for i, r in enumerate(rows) if i % 5], rows[::5]
    w = follow_the_leader(fit or held, len(languages))
    if not held:
        return Model(languages, (w * np.append(idf, 1.0)[:, None]).astype(np.float32), 1.0)
    logits = np.array([x @ w[at] for at, x, _ in held])
    t = temperature(logits, np.array([k for _, _, k in held]))
    scores = 1 / np.exp((logits - logits.max(axis=1, keepdims=True)) / t).sum(axis=1)
    usual = float(np.quantile(scores, 0.002, method="lower")) * (1 - len(held) ** -0.5)
    return Model(languages, (w * np.append(idf, 1.0)[:, None]).astype(np.float32), t, usual)


def with_language(docs: DataFrame, model: Model, text: str = "text", name: str = "lang_pred", score: str = "score") -> DataFrame:
    """Adds the predicted language and its probability for each whole text; ``und`` and 0 for null texts and texts
    without a letter. Rows stay as they are, repeated ones too; columns of the new names are replaced. No shuffle: the
    model, of a fixed number of buckets, is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop(name, score)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                got = [shared.value.predict(t.as_py()) for t in part.column(part.schema.get_field_index(text))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())], names=[*part.schema.names, name, score])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(name, T.StringType()), T.StructField(score, T.DoubleType())]))

"""The registered queries and the pipeline, stage by stage, against plain versions over a small table."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import tiktoken
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from yearmask.llm import decontaminate, language, language_model, quality, queries, simhash
from yearmask.llm.common import crc_mod


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_queries_with_sql_twins(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in queries.ORACLES.items():
        got = queries.QUERIES[name](spark, sf)
        columns = sorted(got.columns)
        want = con.execute(f'SELECT {", ".join(chr(34) + c + chr(34) for c in columns)} FROM ({sql})').fetchall()
        assert sorted(map(repr, map(tuple, got.select(columns).collect()))) == sorted(map(repr, want)), name


def test_stages_against_plain_versions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame([(100_000, None, "en", "x", 0), (100_001, "12 34 !!", None, "x", 8), (0, docs.first().text, "fr", "x", 1)], docs.schema))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == columns
        rows, before = out.collect(), docs.collect()
        ids = {r.doc_id for r in rows}
        if name == "language ID":
            assert {100_000, 100_001}.isdisjoint(ids) and len(rows) >= 0.95 * len(before)
        if name == "quality classifier":
            label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
            known = [r.doc_id for r in before if r.doc_id in label]
            assert sum((d in ids) == bool(label[d]) for d in known) / len(known) > 0.9
        if name == "SimHash near-dedup":
            prints = {r.doc_id: simhash.fingerprint((r.text or "").encode()) % (1 << 64) for r in before}
            group = {d: d for d in prints}
            for a in sorted(prints):
                for b in sorted(prints):
                    if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                        x, y = group[a], group[b]
                        group = {d: min(x, y) if g in (x, y) else g for d, g in group.items()}
            assert sorted(r.doc_id for r in rows) == sorted(set(group.values()))
        if name == "benchmark decontamination":
            bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            assert ids == {r.doc_id for r in before if decontaminate.brute_force(r.text, bench)[1] == 0}
        docs = spark.createDataFrame(rows, docs.schema)
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    last = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()}
    for r in docs.collect():
        assert last[r.doc_id].ids == e.encode_ordinary(r.text) and last[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
    assert len(last) > 100


def test_uncertain_languages_go(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    half = [t.text[:60] for t in docs.where("lang = 'en'").limit(1).collect() + docs.where("lang = 'de'").limit(1).collect()]
    docs = docs.unionByName(spark.createDataFrame([(100_000 + i, t, None, "x", 8) for i, t in enumerate(["e", "un", " ".join(half), "-"])], docs.schema))
    model = language.train(docs.where(crc_mod("doc_id", 3) != 1).select("text", "lang"))
    least = min(corpus_pipeline.LEAST_SCORE, model.usual)
    want = {r.doc_id for r in docs.collect() if model.predict(r.text)[1] >= least}
    assert {r.doc_id for r in corpus_pipeline.language_id(spark, docs, sf).collect()} == want
    assert least > 0.25 and 0.95 * docs.count() < len(want) < docs.count()


def test_stages_take_any_rows(spark, sf):
    """Null ids, nulls in every column, repeated rows, very long texts, and columns named like the stages' own."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(150)
    long = " ".join(docs.first().text.split() * 400)
    odd = [(None, docs.first().text, None, None, None), (None, None, None, None, None), (7_000, long, "en", "x", 1), (7_000, long, "en", "x", 1), (7_001, "", "en", "x", 0), (7_002, "\n" * 9, None, "x", 9)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    for clash in ("__print", "__score", "lang_pred", "d_text", "s_n_words", "n_hit"):
        docs = docs.withColumn(clash, F.lit("mine"))
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        rows = out.collect()
        assert {x for r in rows for x in r[5:]} <= {"mine"}
        # every row is one of those that came in, and repeated rows are treated alike but by the near-duplicate stage
        seen = Counter(map(repr, before))
        kept = Counter(map(repr, rows))
        assert all(kept[k] <= seen[k] for k in kept) and (name == "SimHash near-dedup" or all(kept[k] == seen[k] for k in kept))
        assert name != "SimHash near-dedup" or sum(r.doc_id == 7_000 for r in rows) <= 1
        assert name != "benchmark decontamination" or sum(r.text is None for r in rows) == 1
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert len(last) == len(before) and sum(r.n_tokens == 0 for r in last) == 2


def test_registered_queries_against_libraries_and_plain_versions(spark, sf):
    """The queries that SQL cannot express, with their own splits and parameters, over the whole small table."""
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    mod = {d: zlib.crc32(str(d).encode()) for d in docs}
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def rows(name):
        got = queries.QUERIES[name](spark, sf).collect()
        assert sorted(r.doc_id for r in got) == sorted(docs)
        return {r.doc_id: r for r in got}

    for d, r in rows("op1_bpe").items():
        ids = e.encode_ordinary(docs[d].text or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(docs[d].text or ""))
    plain = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for d, r in rows("op5_token_counts").items():
        n = len(plain.encode(docs[d].text or "", add_special_tokens=False))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((docs[d].text or "").encode()), n, n > 2048)
    train = [r.text for d, r in docs.items() if mod[d] % 10]
    words = Counter(w for t in train for w in [*language_model.words_of(t), None])
    total = sum(words.values())
    got = rows("op7_language_model")
    for d, r in got.items():
        own = [*language_model.words_of(docs[d].text), None]
        base = sum(math.log10((words[w] + 0.1) / (total + 0.1 * (len(words) + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (mod[d] % 10 == 0, len(own), sum(words[w] > 0 for w in own), total)
        assert r.base_score == pytest.approx(base)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = rows("op8_quality")
    assert all(r.held_out == (mod[d] % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for d, r in got.items())
    known = [d for d in got if d in label and got[d].held_out]
    assert sum(got[d].predicted == label[d] for d in known) >= 0.9 * len(known)
    got = rows("op9_simhash")
    prints = {d: simhash.fingerprint((r.text or "").encode()) % (1 << 64) for d, r in docs.items()}
    root = {}
    for d in sorted(prints):  # reach everything from the smallest id on
        todo = [] if d in root else [d]
        while todo:
            x = todo.pop()
            root[x] = d
            todo += [y for y in prints if y not in root and y not in todo and (prints[x] ^ prints[y]).bit_count() <= 4]
    assert {d: (r.fingerprint, r.component_id) for d, r in got.items()} == {d: (f"{p:016x}", root[d]) for d, p in prints.items()}
    got = rows("op10_language")
    assert all(r.held_out == (mod[d] % 3 == 1) and 0 <= r.score <= 1 for d, r in got.items())
    known = [d for d, r in got.items() if r.held_out and docs[d].lang]
    assert sum(got[d].lang_pred == docs[d].lang for d in known) >= 0.97 * len(known) > 40


def plain_quality(model, text):
    """The score of a text by its own statistics, rule by rule."""
    x = quality.statistics((text or "").encode())
    margin = model.intercept + sum(w for rule, w in zip(model.rules, model.weights, strict=True) if all((x[f] > t) == above for f, t, above in rule))
    return 1 / (1 + math.exp(-margin))


def plain_language(model, text):
    """Language and score of a text, n-gram by n-gram."""
    kept = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    if not kept.strip():
        return "und", 0.0
    points = [ord(c) for c in " " + re.sub(" +", " ", kept) + " "]
    found = Counter()
    for n, spread in zip((1, 2, 3), language.SPREAD, strict=True):
        for i in range(len(points) - n + 1):
            h = points[i]
            for c in points[i + 1 : i + n]:
                h = (h * 0x01000193 & 0xFFFFFFFF) ^ c
            found[(h * spread & 0xFFFFFFFF) >> 16] += 1
    z = model.weights[-1].astype(float) + sum(c * model.weights[b].astype(float) for b, c in found.items()) / found.total()
    e = [math.exp((x - max(z)) / model.temperature) for x in z]
    return model.languages[e.index(max(e))], max(e) / sum(e)


def test_quality_and_language_row_by_row(spark, sf):
    """Every row of both registered queries is what a plain evaluation of the fitted model gives."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    model = quality.train(quality.with_statistics(docs.where(crc_mod("doc_id", 5) != 0)), spark.read.parquet(f"{sf}/labels.parquet"))
    assert model.rules
    for r in queries.QUERIES["op8_quality"](spark, sf).collect():
        want = plain_quality(model, text[r.doc_id])
        assert r.score == pytest.approx(want, abs=1e-12) and r.predicted == int(want >= 0.3)
    model = language.train(docs.where(crc_mod("doc_id", 3) != 1))
    for r in queries.QUERIES["op10_language"](spark, sf).collect():
        name, score = plain_language(model, text[r.doc_id])
        assert r.lang_pred == name and r.score == pytest.approx(score, abs=1e-3)


def test_the_pipeline_from_end_to_end(spark, sf):
    """run() against plain versions of all five stages, one after the other, over the whole small table."""
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    table = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.train(table.where(crc_mod("doc_id", 3) != 1).select("text", "lang"))
    kept = [d for d, r in docs.items() if (p := plain_language(model, r.text))[0] != "und" and p[1] >= min(corpus_pipeline.LEAST_SCORE, model.usual)]
    left = table.where(F.col("doc_id").isin(kept))
    rules = quality.train(quality.with_statistics(left.where(crc_mod("doc_id", 5) != 0)), spark.read.parquet(f"{sf}/labels.parquet"))
    kept = [d for d in kept if plain_quality(rules, docs[d].text) >= 0.3]
    prints = {d: simhash.fingerprint(docs[d].text.encode()) % (1 << 64) for d in sorted(kept)}
    group = {}
    for d in prints:
        todo = [] if d in group else [d]
        while todo:
            x = todo.pop()
            group[x] = d
            todo += [y for y in prints if y not in group and y not in todo and (prints[x] ^ prints[y]).bit_count() <= 4]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = [d for d in sorted(set(group.values())) if decontaminate.brute_force(docs[d].text, bench)[1] == 0]
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, sf).collect()}
    assert sorted(got) == kept and all(got[d] == e.encode_ordinary(docs[d].text) for d in kept)


def test_near_dedup_keeps_the_same_of_tied_rows(spark, sf):
    """Rows of one id and one fingerprint that differ: whatever their order, the same one stays."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(20)
    first = docs.first()
    ties = [(first.doc_id, first.text + end, lang, "x", n) for n, (end, lang) in enumerate([(" ", "a"), ("\n", "b"), ("", "c"), (" \n ", "d"), (" ", "a")])]
    both = docs.unionByName(spark.createDataFrame(ties, docs.schema))
    seen = {repr(sorted(map(repr, corpus_pipeline.near_dedup(spark, both.orderBy(F.rand(s)).repartition(n), sf).collect()))) for s, n in ((1, 1), (2, 5), (3, 3))}
    assert len(seen) == 1


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_run_is_the_stages_in_order(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "quality classifier", "SimHash near-dedup", "benchmark decontamination", "byte-level BPE"]
    got = corpus_pipeline.run(spark, sf)
    assert got.count() > 100 and got.where(F.col("n_tokens") != F.size("ids")).count() == 0


def test_stages_on_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0

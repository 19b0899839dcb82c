"""BPE and token counts against the libraries, and on odd input."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from yearmask.llm import bpe, token_counts

SCHEMA = "doc_id long, text string, n_tokens string, ids string"
ODD = ["", " ", "   ", "a", "it's  we'll\n\n x", "é́ ñ 日本語 🎉", "\x00\x1c\x85\xa0 a", "<|endoftext|> b", "1234567 12", "a" * 30_000, "é!" * 5_000, "word " * 5_000]
ALPHABET = [" ", "  ", "\n", "\r", "\t", "a", "B", "'s", "'", "1", "é", "　", "\xa0", "\x1c", "\x85", "!", "日本", "🎉", "́", "<|endoftext|>", "İ", "ς", "re"]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN, cache=500)


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def made_up(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 14))) for _ in range(n)]


def test_perfect_hash_is_minimal(codec):
    assert sorted(codec.hash.slot(w) for w in codec.words) == list(range(len(codec.words)))
    assert all(codec.whole(w) == i for i, w in enumerate(codec.words))
    assert codec.whole(b"no such entry, surely") == -1


def test_small_vocabularies_hash():
    for n in (1, 2, 5, 300):
        keys = [str(i).encode() for i in range(n)]
        h = bpe.PerfectHash(keys)
        assert sorted(h.slot(k) for k in keys) == list(range(n))


def test_encode_as_the_library(codec, library):
    for t in ODD + made_up(3000):
        ids = codec.encode(t)
        assert ids == library.encode_ordinary(t), repr(t[:80])
        assert codec.decode(ids) == t.encode()


def test_token_digests(spark, codec, library):
    rows = [(i, t, "x", "y") for i, t in enumerate(ODD)] + [(None, "null id", None, None), (1, None, None, None), (0, "", "x", "y"), (0, "", "x", "y")]
    got = bpe.token_digests(spark.createDataFrame(rows, SCHEMA), codec, keep_ids=True).collect()
    assert len(got) == len(rows)
    want = []
    for d, t, _, _ in rows:
        ids = library.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), ids))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_with_tokens_replaces_clashing_columns_and_keeps_the_rest(spark, codec):
    df = bpe.with_tokens(spark.createDataFrame([(7, "it is", "kept", "gone"), (None, None, None, None)], SCHEMA), codec, decoded="back")
    assert df.columns == ["doc_id", "text", "n_tokens", "ids", "back"]
    assert {(r.doc_id, r.n_tokens, r.back) for r in df.collect()} == {(7, "kept", "it is"), (None, None, "")}


def test_empty_tables(spark, codec):
    empty = spark.createDataFrame([], SCHEMA)
    assert bpe.token_digests(empty, codec).count() == 0
    definition = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    assert token_counts.frequent_lengths(empty, definition) == {}
    assert token_counts.token_counts(empty, token_counts.TokenLengths(definition, {})).count() == 0


def test_counts_as_the_library(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    definition = open(path, encoding="utf-8").read()
    plain = Tokenizer.from_file(path)
    texts = ODD + made_up(2000, seed=2) + ["word " * 2049, "word " * 2048]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counter = token_counts.TokenLengths(definition, token_counts.frequent_lengths(docs, definition), cache=50)
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs, counter).collect()}
    for i, t in rows:
        n = len(plain.encode(t or "", add_special_tokens=False))
        assert got[i] == (len((t or "").encode()), n, n > 2048), repr((t or "")[:80])

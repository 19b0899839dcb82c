"""Token counts without token lists: a map-side lookup in two tiers.

A text is normalised and split into pre-tokens by the tokenizer's own rules. Tier one is a table of frequent pre-tokens
and their lengths in tokens, made once and broadcast in compact form. Tier two is the cache of a worker: what neither holds
is encoded by the library, many at once, and kept. No pre-token is ever shuffled.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

#: blocks whose characters have had their classes and lower cases since long before any Unicode version in use; texts with
#: others are left to the library as they are
OTHER = re.compile("[^\x00-\u036F\u0374\u0375\u037A-\u037D\u0384-\u03FF\u0400-\u0527\u1E00-\u1EFF\u2010-\u2027\u2030-\u205E\u20A0-\u20AC\u2100-\u214B\u2190-\u23F3\u2500-\u26FF\u3001-\u303F\u3041-\u3096\u30A1-\u30FE\u4E00-\u9FA5]")


#: byte-level tokenizers write each byte as one visible character: itself, or the next from U+0100 on if it has none
VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTES = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - VISIBLE))}


def splitter(definition: str) -> regex.Pattern | None:
    """The pattern of a tokenizer's pre-tokens, if its normaliser is NFC, one space for white space, and lower case, and
    matches of one pattern are what it keeps of a text. None for any other tokenizer."""
    d = json.loads(definition)
    steps = [(x["type"], x.get("pattern"), x.get("content")) for x in (d.get("normalizer") or {}).get("normalizers", [])]
    splits = (d.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if steps != [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)] or len(splits) != 2:
        return None
    cut, as_bytes = splits
    if (cut["type"], cut.get("behavior"), cut.get("invert")) != ("Split", "Removed", True) or as_bytes != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}:
        return None
    return regex.compile(cut["pattern"]["Regex"])


class TokenLengths:
    """Counts the tokens of texts as a tokenizer of the `tokenizers` library gives them, without added begin or end.

    ``definition`` is the content of the JSON file. A tokenizer whose rules ``splitter`` knows is looked up by pre-tokens;
    any other encodes whole texts. So do texts with strings of special tokens, which are one token each and found before
    anything else, and texts with characters of rare blocks. Long texts are split like any other; a full cache is emptied.
    """

    def __init__(self, definition: str, frequent: dict[str, int], cache: int = 300_000):
        self.definition, self.frequent, self.most = definition, frequent, cache
        self.model = None

    def __getstate__(self) -> tuple:
        # the table travels as one string and one byte string, not as a dictionary
        return self.definition, "\n".join(self.frequent), bytes(self.frequent.values()), self.most

    def __setstate__(self, state: tuple) -> None:
        self.definition, words, lengths, self.most = state
        self.frequent = dict(zip(words.split("\n"), lengths, strict=True)) if lengths else {}
        self.model = None

    def start(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(self.definition)
        self.model.no_truncation()
        self.model.no_padding()
        special = [x.content for x in self.model.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.split = splitter(self.definition)
        self.cached: dict[str, int] = {}

    def pre_tokens(self, text: str) -> list[str] | None:
        """The pre-tokens of a text; None if the library has to see the text as it is."""
        if self.model is None:
            self.start()
        if self.split is None or (self.special is not None and self.special.search(text)):
            return None
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if OTHER.search(text):
                return None
            text = text.replace("Σ", "σ")  # the library lowers characters one by one
        return self.split.findall(text.lower())

    def lengths(self, words: list[str]) -> list[int]:
        """Tokens of each of some pre-tokens: the library's merges alone, as normalising and splitting are done."""
        merge = self.model.model.tokenize
        return [len(merge(w.encode().decode("latin-1").translate(BYTES))) for w in words]

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        parts = [self.pre_tokens(t) for t in texts]
        frequent, cached = self.frequent, self.cached
        if len(cached) >= self.most:
            cached.clear()
        missing = list({p for x in parts if x for p in x if p not in frequent and p not in cached})
        late = dict(zip(missing, self.lengths(missing), strict=True))
        cached.update((p, n) for p, n in late.items() if len(p) < 64)
        out = []
        for text, x in zip(texts, parts, strict=True):
            if x is None:
                out.append(len(self.model.encode(text, add_special_tokens=False)))
                continue
            got = list(map(frequent.get, x))
            if None in got:
                got = [(cached.get(p) or late[p]) if n is None else n for p, n in zip(x, got, strict=True)]
            out.append(sum(got))
        return out


def frequent_lengths(docs: DataFrame, definition: str, size: int = 50_000, rows: int = 4_000) -> dict[str, int]:
    """The frequent pre-tokens of docs (text) with their lengths: at most ``size`` of them, from about ``rows`` sampled rows.

    What is in the table changes the speed alone, never a count: everything else takes the second tier. So the rows that
    fill it may be a sample, and its size is the same for any input.
    """
    n = docs.count()
    plain = TokenLengths(definition, {})
    if not n or splitter(definition) is None:
        return {}
    sample = docs if n <= rows else docs.sample(fraction=rows / n, seed=7)

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen.update(plain.pre_tokens(t or "") or [])
        top = [(w, k) for w, k in seen.most_common(size) if k > 1 and len(w) < 64]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([k for _, k in top], pa.int64())], names=["w", "k"])

    total = sample.select("text").mapInArrow(heads, "w string, k long").groupBy("w").agg(F.sum("k").alias("k"))
    words = [r.w for r in total.orderBy(F.desc("k"), "w").limit(size).collect()]
    plain.start()
    return {w: n for w, n in zip(words, plain.lengths(words), strict=True) if n < 256}


def token_counts(docs: DataFrame, counter: TokenLengths, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) for each row of docs (doc_id, text).

    A null text counts as empty: 0 bytes, 0 tokens. Every row stays, repeated ones too; other columns are left out, and
    whole texts are counted however long they are. One pass, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(counter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                texts = [t or "" for t in part.column(1).to_pylist()]
                n = c.counts(texts)
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, OUT)

"""Decontamination, chat, quality, language, language model."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from yearmask.llm import chat, decontaminate, language, language_model, quality
from yearmask.llm.common import crc_mod

WORDS = [f"w{i}" for i in range(40)]


def sentence(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


@pytest.mark.parametrize("block", [4_000_000, 300])
def test_decontamination_as_plain_search(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)  # 300 bytes: several passes
    r = random.Random(3)
    items = [(i, sentence(r, r.choice([3, 9, 10, 11, 25]))) for i in range(8)] + [(8, "short one"), (9, None), (10, "!!"), (8, "short one"), (11, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11")]
    texts = [None, "", "...", "Short, ONE!", items[0][1].upper(), "é" + items[1][1], "x " * 3000 + items[2][1].replace(" ", "--") + " y" * 10, " ".join(t for _, t in items if t), sentence(r, 400), "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"]
    texts.append(texts[4])
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)] + [(None, items[3][1], 5)], "doc_id long, text string, n_hit int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(docs, bench).withColumn("d", decontaminate.items_digest()).collect()
    assert len(got) == len(texts) + 1
    for row in got:
        n, hit, n_items, digest = decontaminate.brute_force(row.text, items)
        assert (row.n_words, row.n_hit, len(row["items"]), row.d) == (n, hit, n_items, digest), row.text
        words = sum(len(decontaminate.normalised((row.text or "")[s.start : s.end].encode())) for s in row.spans)
        assert words == row.n_hit


def test_blocks_are_bounded_whatever_the_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 60_000)
    r = random.Random(6)
    shared = sentence(r, 10)
    items = [(0, " ".join(f"{r.choice(WORDS)} u{i}" for i in range(3_000)))] + [(i, shared) for i in range(1, 1_500)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    blocks = decontaminate.Blocks(bench, "item_id", "text", 10)
    sizes = [sum(len(w) + len(i) for w, ids in b.items() for i in ids) for b in blocks]
    assert blocks.number > 5 and max(sizes) < 1.5 * 60_000
    docs = spark.createDataFrame([(1, f"before {shared} after"), (2, items[0][1][500:2_000]), (3, "clean")], "doc_id long, text string")
    for row in decontaminate.contaminated(docs, bench).withColumn("d", decontaminate.items_digest()).collect():
        assert (row.n_words, row.n_hit, len(row["items"]), row.d) == decontaminate.brute_force(row.text, items)


def test_decontamination_of_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(docs, bench).select("n_words", "n_hit").first() == (2, 0)
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0


def test_chat_folds_events(spark):
    log = [
        (1, 0, "s", "user", 0, "open", ""), (1, 0, "s", "user", 2, "edit", "new"), (1, 0, "s", "user", 1, "delta", "old"),
        (1, 1, "s", "assistant", 0, "open", ""), (1, 1, "s", "assistant", 1, "delta", "bad"), (1, 1, "s", "assistant", 2, "regenerate", ""), (1, 1, "s", "assistant", 3, "delta", "go"), (1, 1, "s", "assistant", 4, "delta", "od"),
        (1, 2, "s", "user", 0, "open", ""), (1, 2, "s", "user", 1, "delta", "never"), (1, 2, "s", "user", 2, "drop", ""), (None, 0, "s", "user", 0, "delta", None),
    ]
    random.Random(1).shuffle(log)
    events = spark.createDataFrame(log, "conv_id long, message long, stream string, role string, seq long, kind string, body string")
    got = {r.conv_id: chat.read_back(r.formatted) for r in chat.format_conversations(events).collect()}
    assert got == {1: [("user", "new"), ("assistant", "good")], None: [("user", "")]}
    assert chat.format_conversations(events.limit(0)).count() == 0


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_chat_round_trip(spark, partitions):
    nasty = ["<|im_end|>", "<|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|x", "\\", "a\nb", "", None, "<|<|>|>", "x" * 5000, "é🎉"]
    rows = [(c, t, role, text) for c in range(3) for t, text in enumerate(nasty) for role in (["user", "assistant"][t % 2],)] + [(0, 3, "user", "tie"), (0, 3, "user", "tie"), (9, 0, None, "no role"), (9, 1, "a\nb<|\\", "odd role")]
    rows += [(5, i, "assistant", f"part {i}") for i in range(200)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.conv_id: r for r in chat.format_conversations(chat.events_of(turns)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert set(got) == {0, 1, 2, 5, 9}
    for conv, row in got.items():
        want = [(r or "", t or "") for c, _, r, t in sorted((x for x in rows if x[0] == conv), key=lambda x: x[1])]
        turns_read = chat.read_back(row.formatted)
        assert sorted(turns_read) == sorted(want) if conv == 0 else turns_read == want
    digests = {r.conv_id: r for r in chat.turn_digests(spark.createDataFrame(list(got.values()))).collect()}
    loss = "".join(f"part {i}" for i in range(200))
    assert (digests[5].n_turns, digests[5].loss_chars, digests[5].loss_sha256) == (200, len(loss), hashlib.sha256(loss.encode()).hexdigest())


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_chat_long_conversations_stay_in_parts(spark, partitions):
    rows = [(4, i, ["user", "assistant"][i % 2], f"<|{i}|> " + "é" * (i % 90)) for i in range(400)] + [(c, 0, "assistant", "short") for c in (1, 2, 3, 8, 9)] + [(None, i, "user", "none " * 30) for i in range(9)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        parts = chat.format_parts(chat.events_of(turns), most=500)
        got = {r.conv_id: r for r in chat.part_digests(parts).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert max(len(r.formatted) for r in parts.collect()) < 500 + 250  # a turn more at most
    assert parts.where("conv_id = 4").count() > 40
    assert set(got) == {1, 2, 3, 4, 8, 9, None}
    for conv, row in got.items():
        want = [(r, t) for c, _, r, t in rows if c == conv]
        loss = "".join(t for r, t in want if r == "assistant")
        every = "".join(f"{r}\n{t}\n" for r, t in want)
        assert (row.n_turns, row.turns_sha256, row.loss_chars, row.loss_sha256) == (len(want), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert row.formatted_chars == sum(len(chat.render(r, t)) for r, t in want)


def test_chat_of_very_long_texts(spark):
    """Work in proportion to the length: eight million characters in seconds, twice the length in about twice the time."""
    took = []
    for n in (1, 4, 8):
        text = "word <|im_end|> é\U0001f600 " * (n * 1_000_000 // 20)
        frame = spark.createDataFrame([(1, 0, "user", "ask"), (1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
        began = time.time()
        row = chat.part_digests(chat.format_parts(chat.events_of(frame))).first()
        took.append(time.time() - began)
        assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, len(text), hashlib.sha256(text.encode()).hexdigest())
    assert took[2] < 60 and took[2] < 4 * took[1] + 5


def test_labels_with_very_many_texts_reach_the_driver_in_bounds(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append(len(y)) or quality.Ensemble([], [], 0.0))
    docs = spark.createDataFrame([(i % 2, "w " * (i + 1)) for i in range(1500)] * 2, "doc_id long, text string")
    labels = spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, quality int")
    stats = quality.with_statistics(docs).cache()
    for most in (2, 300, 5000):
        quality.train(stats, labels, most=most)
    assert seen[0] < 20 and 200 < seen[1] < 400 and seen[2] == 1500
    again = stats.repartition(7)
    quality.train(again, labels, most=300)
    assert seen[3] == seen[1]


def test_long_texts_reach_the_driver_in_bounds(spark):
    r = random.Random(2)
    docs = [("".join(r.choice("abcdefghijklmnopqrstuvwxyzäöüß ") for _ in range(r.choice([50, 20_000]))), r.choice(["a", "b"])) for _ in range(120)]
    frame = spark.createDataFrame(docs, "text string, lang string")
    chosen, _ = language.drawn_features(frame, 60_000, 1)
    sizes = [len(x.at) // 4 for x in chosen.collect()]
    whole = [len(x.at) // 4 for x in language.drawn_features(frame, 1 << 40, 1)[0].collect()]
    assert len(whole) == 120 and 0 < len(sizes) < 120 and sum(sizes) < 60_000 + max(whole)
    assert Counter(sizes) == Counter(len(x.at) // 4 for x in language.drawn_features(frame.repartition(5), 60_000, 1)[0].collect())
    model = language.train(frame, most_features=60_000)
    assert model.languages == ["a", "b"]


def test_statistics_and_rules(spark):
    assert quality.statistics(b"") == quality.statistics(b" \n ") == [0.0] * len(quality.STATISTICS)
    r = random.Random(2)
    good = [". ".join(sentence(r, 8).capitalize() for _ in range(r.randint(1, 6))) + "." for _ in range(150)]
    bad = ["!! ".join(sentence(r, 20).upper().split()) + "!!" for _ in range(80)] + ["spam " * r.randint(20, 50) for _ in range(70)]
    rows = [(i, t) for i, t in enumerate(good + bad)]
    docs = spark.createDataFrame(rows + [(None, None), (900, ""), (901, "long " * 50_000)], "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("s_upper", F.lit(1))
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i, _ in rows if i % 3] + [(None, 1, 0), (5000, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    stats = quality.with_statistics(docs).drop("text")
    model = quality.train(stats, labels)
    got = quality.with_quality(stats, model).collect()
    assert len(got) == len(rows) + 3 and all(0 <= x.score <= 1 for x in got)
    held = [x for x in got if x.doc_id is not None and x.doc_id < 300 and x.doc_id % 3 == 0]
    assert sum(x.predicted == int(x.doc_id < 150) for x in held) / len(held) > 0.95
    assert 0 < len(model.rules) < 120
    sampled = quality.train(stats, labels, most=60)
    assert sampled.rules
    for x in got:  # the column expression against a plain evaluation of the rules
        margin = model.intercept + sum(w for rule, w in zip(model.rules, model.weights, strict=True) if all((x[f"s_{quality.STATISTICS[f]}"] > t) == above for f, t, above in rule))
        assert x.score == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-12) and x.predicted == int(x.score >= 0.3)
    none = quality.train(stats, labels.limit(0))
    assert {round(x.score, 6) for x in quality.with_quality(stats, none).collect()} == {0.5}
    assert quality.with_quality(stats.limit(0), model).count() == 0


def test_language(spark):
    r = random.Random(4)
    syllables = {"xx": ["ba", "ko", "ri", "tu"], "yy": ["sch", "ung", "ein", "er"], "zz": ["ção", "é", "lho", "que"]}

    def text(k):
        return " ".join("".join(r.choice(syllables[k]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(2, 60)))

    rows = [(i, text(k), k) for i, k in enumerate(list(syllables) * 120)]
    odd = [(1000, None, "xx"), (1001, "", None), (1002, "123 !?", "yy"), (None, text("yy"), None), (1003, text("xx") * 400, "xx"), (0, *rows[0][1:])]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumn("score", F.lit("mine"))
    model = language.train(docs.where(crc_mod("doc_id", 3) != 1), per_language=60)
    assert model.languages == ["xx", "yy", "zz"] and (model.weights == 0).mean() > 0.5
    got = language.with_language(docs, model).collect()
    assert len(got) == len(rows) + len(odd)
    held = [x for x in got if x.doc_id is not None and x.doc_id < 1000 and zlib.crc32(str(x.doc_id).encode()) % 3 == 1]
    assert sum(x.lang_pred == x.lang for x in held) / len(held) > 0.97
    assert {(x.doc_id, x.lang_pred, x.score) for x in got if x.doc_id in (1000, 1001, 1002)} == {(i, "und", 0.0) for i in (1000, 1001, 1002)}
    nothing = language.train(docs.limit(0))
    assert nothing.languages == [] and {x.lang_pred for x in language.with_language(docs, nothing).collect()} == {"und"}


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    z = rng.normal(size=(4000, 3)) * 2
    k = np.array([rng.choice(3, p=np.exp(x) / np.exp(x).sum()) for x in z])
    assert abs(language.temperature(z * 5, k) - 5) < 0.5


def plain_prediction(model, text):
    """The most likely language and its probability, gram by gram."""
    letters = [c if c.isalpha() else " " for c in (text or "").lower()]
    if not any(c != " " for c in letters):
        return "und", 0.0
    points = [32, *[ord(c) for c in re.sub(" +", " ", "".join(letters))], 32]
    total, n = np.zeros(len(model.languages)), 0
    for size in (1, 2, 3):
        for i in range(len(points) - size + 1):
            h = points[i]
            for p in points[i + 1 : i + size]:
                h = h * 0x01000193 % 2**32 ^ p
            total += model.weights[h * language.SPREAD[size - 1] % 2**32 >> 16]
            n += 1
    z = (total / n + model.weights[-1]) / model.temperature
    p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    return model.languages[int(p.argmax())], float(p.max())


def test_language_of_any_layout_and_by_plain_prediction(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    one, many = language.train(docs.coalesce(1), per_language=20), language.train(docs.orderBy(F.desc("text")).repartition(40), per_language=20)
    assert (one.weights == many.weights).all() and one.temperature == many.temperature and one.languages == many.languages
    copies = docs.unionByName(docs.limit(1).crossJoin(spark.range(3_000)).drop("id"))
    assert language.train(copies, per_language=20).languages == one.languages
    for r in language.with_language(docs.limit(60).unionByName(spark.createDataFrame([(1, "  12 3", None), (2, None, None), (3, "é", None)], docs.schema)), one).collect():
        want = plain_prediction(one, r.text)
        assert r.lang_pred == want[0] and r.score == pytest.approx(want[1], abs=1e-4)


def brute_base(train, text):
    def words(t):
        return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))

    counts, n = {}, 0
    for t in train:
        for w in [*words(t), None]:
            counts[w] = counts.get(w, 0) + 1
            n += 1
    tokens = [*words(text), None]
    return sum(np.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (len(counts) + 1))) for w in tokens), len(tokens), sum(w in counts for w in tokens), n


def brute_class_scores(train, texts, of, unseen):
    """log10 probabilities of texts by plain counting, given the class of each known word and of each unseen one."""
    classes, end = language_model.ALL, language_model.END
    words = {t: language_model.words_of(t) for t in (*train, *texts)}
    pairs, count, inside = {}, {}, {end: 0}

    def group(w):
        return of[w] if w in of else int(unseen[language_model.ending(w)])

    for t in train:
        for a, b in zip([end, *map(group, words[t])], [*map(group, words[t]), end], strict=True):
            pairs[a, b] = pairs.get((a, b), 0) + 1
        for w in words[t]:
            count[w] = count.get(w, 0) + 1
    for w, n in count.items():
        inside[of[w]] = inside.get(of[w], 0) + n
    kinds = Counter(of.values())
    out = []
    for t in texts:
        total, before = 0.0, end
        for w in [*words[t], None]:
            c = end if w is None else group(w)
            total += math.log10((pairs.get((before, c), 0) + 0.5) / (sum(n for (a, _), n in pairs.items() if a == before) + 0.5 * classes))
            n, size, types = (len(train), len(train), 0) if w is None else (count.get(w, 0), inside.get(c, 0), kinds[c])
            total += math.log10((n + 0.1) / (size + 0.1 * (types + 1)))
            before = c
        out.append(total)
    return out


@pytest.mark.parametrize("frequent", [1 << 17, 20])
def test_language_model(spark, monkeypatch, frequent):
    monkeypatch.setattr(language_model.frequent_words, "__defaults__", (frequent,))
    r = random.Random(5)
    first, second = WORDS[:20], WORDS[20:]

    def text():
        return " ".join(r.choice(first) + " " + r.choice(second) for _ in range(r.randint(1, 60)))

    rows = [(i, text()) for i in range(120)] + [(200, None), (201, ""), (None, "W1 w2\tunseen\nunseen"), (3, "w1"), (3, "w1"), (202, "rare" * 3000), (203, "é \x0b x\xa0y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("held_out", crc_mod("doc_id", 10) == 0).withColumn("score", F.lit(1))
    train = [t for i, t in rows if zlib.crc32(str("" if i is None else i).encode()) % 10 != 0]
    model, rare, full = language_model.train(docs)
    got = language_model.scored(full, model).collect()
    want = [(i, *brute_base(train, t)) for i, t in rows]
    assert len(got) == len(rows)
    got_key = sorted((str(g.doc_id), g.n_tokens, g.n_known, g.train_tokens, round(g.base_score, 6)) for g in got)
    assert got_key == sorted((str(i), n, k, total, round(b, 6)) for i, b, n, k, total in want)
    held = [g for g in got if g.held_out and g.n_tokens > 5]
    assert sum(g.score for g in held) > sum(g.base_score for g in held)
    # every word of the training texts has a class, and scores are those of plain counting
    late = rare.collect()
    of = {w: int(model.place[i]) for w, i in model.table.places().items()} | {x["word"].encode(): x["class"] for x in late}
    assert set(of) == {w for t in train for w in language_model.words_of(t)} and len(late) == len(of) - len(model.table)
    assert all(0 <= c < language_model.CLASSES for c in of.values()) and (frequent < 100) == (len(late) > 1)
    brute = brute_class_scores([t or "" for t in train], [t or "" for _, t in rows], of, model.unseen)
    assert sorted((str(g.doc_id), round(g.score, 6)) for g in got) == sorted((str(i), round(b, 6)) for (i, _), b in zip(rows, brute, strict=True))
    again = language_model.scores_of(docs.withColumn("held_out", F.lit(True)), model, rare).collect()
    assert sorted((str(g.doc_id), round(g.score, 6)) for g in again) == sorted((str(g.doc_id), round(g.score, 6)) for g in got)


def test_language_model_is_a_distribution(spark):
    docs = spark.createDataFrame([(i, t, False) for i, t in enumerate(["a b a c", "a c b", "c c a"])], "doc_id long, text string, held_out boolean")
    model, _, full = language_model.train(docs)
    assert np.allclose((10**model.transition).sum(axis=1), 1)
    mass = np.zeros(language_model.ALL)
    for w in (b"a", b"b", b"c"):
        i = model.table.places()[w]
        mass[model.place[i]] += 10 ** (np.log10(model.table.counts[i] + 0.1) - model.size[model.place[i]])
    assert (mass <= 1 + 1e-9).all() and (mass > 0.9).sum() >= 1
    empty, words, _ = language_model.train(docs.limit(0))
    assert empty.tokens == 0 and words.count() == 0
    rows = language_model.scores_of(docs.withColumn("held_out", F.lit(True)), empty, words).collect()
    assert all(r.n_known == 0 and r.base_score == pytest.approx(0) for r in rows) and len(rows) == 3


def test_neighbour_counts_and_class_vectors(spark, monkeypatch):
    monkeypatch.setattr(language_model, "ROW", 3)
    monkeypatch.setattr(language_model.neighbour_counts, "__defaults__", (50,))
    r = random.Random(2)
    texts = [" ".join(r.choice("abcdefgxyz") for _ in range(r.randint(0, 40))) for _ in range(60)]
    table = language_model.Table(list("abcdefg"), [1] * 7)
    found = language_model.neighbour_counts(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), table).collect()
    want = Counter()
    for t in texts:
        ids = [8, *["abcdefg".find(w) if w in "abcdefg" else 7 for w in t.split()], 8]
        for a, b in zip(ids, ids[1:], strict=False):
            want.update([(a, 0, b)] if a < 7 else [])
            want.update([(b, 1, a)] if b < 7 else [])
    got = Counter()
    for x in found:
        other, n = np.frombuffer(x.other, "<i4"), np.frombuffer(x.n, "<i8")
        assert len(other) <= 3
        got.update({(x.word, x.side, int(o)): int(k) for o, k in zip(other, n, strict=True)})
    assert got == want
    place = np.array([0, 1, 2, 0, 1, 2, 0, language_model.REST, language_model.END], dtype=np.uint8)
    rows = spark.createDataFrame(found, language_model.NEIGHBOURS).orderBy("word", "side").toArrow().to_batches(max_chunksize=2)
    seen = {}
    for label, after, before in language_model.class_vectors(language_model.neighbour_entries(iter(rows), place)):
        seen |= {w: (a.copy(), b.copy()) for w, a, b in zip(label.to_pylist(), after, before, strict=True)}
    for w in range(7):
        for side in (0, 1):
            counts = np.zeros(language_model.WIDE)
            for (own, s, o), n in want.items():
                if own == w and s == side:
                    counts[place[o]] += n
            assert (seen[w][side] == counts).all()


def test_exchange_finds_planted_classes():
    rng = np.random.default_rng(1)
    n = 1024
    big = np.zeros((n, n), dtype=np.int64)
    group = rng.integers(0, 3, size=40)
    for a in range(40):
        for b in range(40):
            big[a, b] = rng.poisson(30 if group[b] == (group[a] + 1) % 3 else 1)
    member = language_model.exchange(big, 4, sweeps=20)
    assert all(len(set(member[:40][group == g])) == 1 for g in range(3)) and len(set(member[:40])) == 3


def test_exchange_goes_on_until_no_unit_moves():
    r = np.random.default_rng(3)
    big = r.poisson(0.3, (200, 200)) * r.integers(1, 9, (200, 200))
    member = language_model.exchange(big, 12)
    assert (member == language_model.exchange(big, 12, sweeps=1000)).all() and (member != language_model.exchange(big, 12, sweeps=8)).any()

"""Toxicity, language and the language model: against plain versions and held out."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tapeline.llm import language, lm, registry, shingles, toxicity


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}


# Toxicity ----------------------------------------------------------------------

BAD = ["grumf", "blarg", "snork"]


def speech(rng, toxic):
    word = lambda: rng.choice(["the", "cat", "sat", "on", "a", "mat", "and", "ran", "off", "home"])
    parts = [" ".join(word() for _ in range(rng.randrange(3, 9))) for _ in range(rng.randrange(1, 12))]
    if toxic:
        k = rng.randrange(len(parts))
        parts[k] = f"{parts[k]} {rng.choice(BAD)}{rng.choice(['', 'ish', 'ly'])} {word()}"
    return ". ".join(parts) + "."


@pytest.fixture(scope="module")
def speeches(spark):
    rng = random.Random(3)
    rows = [(i, speech(rng, i % 4 == 0), int(i % 4 == 0)) for i in range(1_600)]
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


@pytest.fixture(scope="module")
def tox(speeches):
    learn = F.col("doc_id") % 2 == 0
    return toxicity.train(speeches.drop("toxic"), speeches.drop("text"), learn)


def test_toxic_documents_and_sentences_are_found(speeches, tox):
    rows = toxicity.scored(speeches.filter("doc_id % 2 = 1 OR doc_id % 4 = 0"), tox).collect()
    for r in rows:
        assert (r.score >= 0.7) == bool(r.toxic)
        data = r.text.encode()
        for s in r.offending:
            assert re.search("|".join(BAD), data[s.start : s.stop].decode())
        assert bool(r.offending) == bool(r.toxic)


def test_the_score_is_the_noisy_or_of_sentences(speeches, tox):
    weights = dict(zip(tox.features.tolist(), tox.weights))

    def hashes(sentence):
        data = np.frombuffer(sentence.encode(), np.uint8)
        edges = np.array([0, len(data)])
        return shingles.words_at(data, edges, toxicity.IS_WORD, toxicity.PREFIXES)[0].tolist()

    for r in toxicity.scored(speeches.limit(50), tox).collect():
        clean = 1.0
        for sentence in re.split(r"[.!?\n\r]", r.text):
            if re.search(r"\w", sentence):
                z = tox.bias + sum(weights.get(h, 0.0) for h in set(hashes(sentence)))
                clean *= 1 - 1 / (1 + math.exp(-z))
        assert r.score == pytest.approx(1 - clean, abs=1e-9)


def test_odd_texts_and_tables(spark, speeches, tox):
    odd = [(1, None, 5), (2, "", 5), (2, "", 5), (None, "...!?\n", 5), (4, "cat " * 90_000 + ". grumf.", 5)]
    df = spark.createDataFrame(odd, "doc_id long, text string, label int")
    rows = toxicity.scored(df, tox).collect()
    assert [r.score for r in rows[:4]] == [0.0] * 4
    assert rows[4].score > 0.7 and [s.start for s in rows[4].offending] == [360_002]
    assert toxicity.scored(df.limit(0), tox).collect() == []
    none = spark.createDataFrame([], "doc_id long, toxic int")
    clean = speeches.select("doc_id", F.lit(0).alias("toxic"))
    for known in (none, clean, speeches.select("doc_id", F.lit(None).cast("int").alias("toxic"))):
        model = toxicity.train(speeches.drop("toxic"), known, F.lit(True))
        assert {r.score for r in toxicity.scored(speeches.limit(20), model).collect()} == {0.0}
    again = toxicity.scored(df.withColumn("Score", F.lit(-1)), tox)
    assert [r.score for r in again.collect()] == [r.score for r in rows]


def test_toxicity_of_the_whole_table(spark, sf_dir, labels):
    rows = registry.QUERIES["op6_toxicity"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in held]) >= 0.9


# Language ------------------------------------------------------------------------


def test_languages_of_the_whole_table(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = registry.QUERIES["op9_language"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in docs if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def plain_grams(text):
    text = re.sub(r"[^\W\d_]+|.", lambda m: m[0] if m[0][0].isalpha() else "\0", text.lower(), flags=re.S)
    text = "\0" + re.sub("\0+", "\0", text).strip("\0") + "\0"
    grams = [text[k : k + 4] for k in range(len(text) - 3)]
    return [g for g in grams if "\0" not in g[1:-1]]


def test_grams_are_those_of_the_text():
    texts = ["Ab cde, fghi", None, "", "é-Ü1x", "a", "12 34", "  the cat  ", "x" * 5_000]
    flat, edges = next(language.pieces(pa.array(texts)))
    h, row, has = language.grams(flat, edges)
    assert has.tolist() == [bool(re.search(r"[^\W\d_]", t or "")) for t in texts]
    names = {}
    for k, text in enumerate(texts):
        mine, plain = h[row == k].tolist(), plain_grams(text or "")
        assert len(mine) == len(plain)
        for gram, value in zip(plain, mine):
            assert names.setdefault(gram, value) == value
    assert len(set(names.values())) == len(names)


def test_filters_answer_for_all_languages_at_once():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (3_000, 500, 2_000)]
    sets[2][:100] = sets[0][:100]
    filters = language.filled(["a", "b", "c"], list(enumerate(sets)))
    masks = np.full(3_000, np.iinfo(np.uint64).max)
    for at in language.slot_numbers(sets[0], len(filters.slots)):
        masks &= filters.slots[at]
    assert (masks & np.uint64(1)).all() and (masks[:100] & np.uint64(4)).all()
    other = rng.integers(0, 2**63, 50_000).astype(np.uint64)
    masks = np.full(50_000, np.iinfo(np.uint64).max)
    for at in language.slot_numbers(other, len(filters.slots)):
        masks &= filters.slots[at]
    for k, rate in enumerate(filters.false_rate):
        wrong = np.mean(masks >> np.uint64(k) & np.uint64(1))
        assert wrong == pytest.approx(rate, rel=0.5, abs=2e-4)


def test_odd_texts_have_no_language(spark):
    rows = [(i, "the house is there" if i % 2 else "das haus ist dort", "en" if i % 2 else "de") for i in range(20)]
    rows += [(30, None, "en"), (31, "12 ?", "de"), (32, "Das Haus", None), (32, "the house", "xx"), (33, "zzzz", "de")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, grams int")
    filters = language.train(df, F.col("doc_id") < 20)
    found = {(r.doc_id, r.text): r.lang_pred for r in language.detected(df, filters).collect()}
    assert found[30, None] == found[31, "12 ?"] == "und"
    assert found[32, "Das Haus"] == "de" and found[32, "the house"] == "en"
    assert found[33, "zzzz"] in ("de", "en")
    assert language.detected(df.limit(0), filters).collect() == []
    nothing = language.train(df, F.lit(False))
    assert {r.lang_pred for r in language.detected(df, nothing).collect()} == {"und"}


def test_more_languages_than_a_mask_has_bits(spark):
    rng = random.Random(4)
    spoken = [["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(12)] for _ in range(150)]
    rows = [
        (1_000 * n + k, " ".join(rng.sample(words, 9)), f"l{k:03}")
        for k, words in enumerate(spoken)
        for n in range(5 if k < 140 else 3)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = language.train(df, F.col("doc_id") >= 1_000)
    assert len(filters.languages) == 150 == len(filters.false_rate)
    found = language.detected(df, filters).collect()
    assert len(found) == len(rows)
    assert [r.doc_id for r in found if r.lang_pred != r.lang] == []
    assert all(0 < r.score <= 1 for r in found)


# Language model -------------------------------------------------------------------


def test_chances_are_those_of_the_network():
    words = [f"w{k}" for k in range(lm.FREQUENT)]
    text = " ".join(words).encode()
    h, _ = shingles.words_at(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    vocabulary = lm.Vocabulary(np.sort(h))
    texts = ["w1 w2  unseen w3", "", None, "w9", "w4 w5 w6 w7 w8 other w1"]
    w = lm.first_weights()
    (_, data, edges), = shingles.chunks(pa.array(texts))
    tokens, place, row = lm.laid_out(data, edges, vocabulary)
    got = lm.log_chances(w, tokens, place)
    at = 0
    for r, text in enumerate(texts):
        own = tokens[place[row == r]].tolist()
        assert len(own) == len((text or "").split())
        padded = [lm.OUTSIDE] * 2 + own + [lm.OUTSIDE] * 2
        for i in range(len(own)):
            near = [padded[i], padded[i + 1], padded[i + 3], padded[i + 4]]
            x = sum(w["seen"][t] * p for t, p in zip(near, w["place"])) + w["shift"]
            z = np.tanh(x) @ w["out"] + w["bias"]
            want = z[own[i]] - math.log(np.exp(z.astype(float)).sum())
            assert got[at] == pytest.approx(want, abs=1e-4)
            at += 1


def test_the_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(2)
    tokens = np.concatenate([[lm.OUTSIDE] * 2, rng.integers(0, lm.TOKENS, 40), [lm.OUTSIDE] * 2])
    place = np.arange(2, 42)
    w = {k: v.astype(np.float64) for k, v in lm.first_weights().items()}
    g = lm.gradient(w, tokens, place)

    def loss():
        h = lm.hidden(w, tokens, place)[1]
        z = h @ w["out"] + w["bias"]
        return -(z[np.arange(40), tokens[place]] - np.log(np.exp(z).sum(axis=1))).mean()

    for name in lm.SHAPES:
        spots = [tuple(rng.integers(0, n) for n in w[name].shape) for _ in range(4)]
        if name == "seen":
            spots = [(int(t), 3) for t in tokens[10:14]]
        for at in spots:
            old = w[name][at]
            w[name][at] = old + 1e-5
            up = loss()
            w[name][at] = old - 1e-5
            down = loss()
            w[name][at] = old
            assert g[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_training_helps_and_odd_texts_have_a_score(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = lm.train(docs)
    known = lm.scored(docs, model).agg(F.sum("log_likelihood") / F.sum("tokens")).first()[0]
    blank = lm.Model(model.words, lm.first_weights())
    naive = lm.scored(docs, blank).agg(F.sum("log_likelihood") / F.sum("tokens")).first()[0]
    assert known > naive + 0.5
    odd = spark.createDataFrame([(1, None), (1, " \t"), (None, "a"), (2, "b " * 60_000)], "i long, text string")
    rows = lm.scored(odd, model).collect()
    assert [(r.tokens, r.mean_log_likelihood is None) for r in rows] == [(0, True), (0, True), (1, False), (60_000, False)]
    assert rows[0].log_likelihood == 0.0 and rows[3].log_likelihood < 0
    assert lm.scored(odd.limit(0), model).collect() == []
    assert lm.train(odd.limit(0)).words.words.size == 0


@pytest.mark.parametrize("n", [0, 1, 2, 13, 700])
def test_every_token_is_predicted_once(n):
    place = np.arange(n) + lm.SIDE
    seen = np.concatenate([lm.targets(place, turn) for turn in range(lm.ROUNDS)])
    assert sorted(seen.tolist()) == place.tolist()


def test_scores_of_the_whole_table(spark, sf_dir):
    rows = registry.QUERIES["op4_pseudo_likelihood"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.log_likelihood < 0 for r in rows if r.tokens)


def test_every_word_counts_by_itself(spark, monkeypatch):
    monkeypatch.setattr(lm, "TABLE_BYTES", 2_000)  # many pieces
    rng = random.Random(4)
    often = [f"often{k}" for k in range(lm.FREQUENT)]
    texts = [" ".join(rng.choices(often, k=40)) + " " + " ".join(f"Rare{rng.randrange(900)}" for _ in range(30)) for _ in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, texts[0]])], "doc_id long, text string")
    words = lm.learnt_vocabulary(docs)
    model = lm.Model(words, lm.first_weights())
    new = "often1 rare1 neverseen often2"
    got = lm.scored(docs.union(spark.createDataFrame([(999, new)], docs.schema)), model).collect()
    assert len(got) == len(texts) + 3

    def hashed(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return shingles.words_at(data, np.array([0, len(data)]))[0]

    n = {}
    for t in [*texts, texts[0]]:
        for word in t.lower().split():
            n[word] = n.get(word, 0) + 1
    frequent = {w for w in n if hashed(w)[0] in set(words.words)}
    assert len(frequent) == lm.FREQUENT and len(n) > 2 * lm.FREQUENT
    classes = {}
    for w in n.keys() - frequent:
        classes.setdefault(int(hashed(w)[0]) % lm.RARE, []).append(w)

    def share(word):
        if word in frequent:
            return 1.0
        own = classes.get(int(hashed(word)[0]) % lm.RARE, [])
        return (n.get(word, 0) + 1) / (sum(n[w] for w in own) + len(own) + 1)

    for own in classes.values():
        assert sum(map(share, own)) < 1
    for r in got:
        if r.text is None:
            assert r.tokens == 0 and r.log_likelihood == 0.0
            continue
        data = np.frombuffer(r.text.encode(), np.uint8)
        tokens, place, _ = lm.laid_out(data, np.array([0, len(data)]), words)
        want = lm.log_chances(model.weights, tokens, place).astype(float).sum()
        want += sum(math.log(share(w)) for w in r.text.lower().split())
        assert r.log_likelihood == pytest.approx(want, rel=1e-6)
        assert r.mean_log_likelihood == pytest.approx(want / r.tokens, rel=1e-6)


def test_large_weights_do_not_overflow():
    w = lm.first_weights()
    w["out"][:, 3] = 40
    w["shift"] += 3
    tokens = np.array([lm.OUTSIDE] * 2 + [3, 5, 3] + [lm.OUTSIDE] * 2)
    got = lm.log_chances(w, tokens, np.array([2, 3, 4]))
    assert np.isfinite(got).all() and got[1] < -500 and got[0] > -1e-3
    assert all(np.isfinite(x).all() for x in lm.gradient(w, tokens, np.array([2, 3, 4])).values())

import itertools
import random

import pyarrow as pa
import pytest

from tapeline.llm import decontamination as D
from tapeline.llm import registry


def plain(docs, items):
    """The pairs of document and item of which some way to lay the item over the document
    has a stretch that is equal enough; all ways and stretches are tried, without seeds."""
    out = set()
    for doc, text in docs:
        words = D.words_of(text)
        for item, passage in items:
            mine = D.words_of(passage)
            least = D.least_words(len(mine))
            for lies in range(1 - len(mine), len(words)):
                low, high = max(lies, 0), min(lies + len(mine), len(words))
                equal = [words[k] == mine[k - lies] for k in range(low, high)]
                if any_stretch(equal, least):
                    out.add((doc, item))
    return out


def holds(docs, items, hit):
    """Whether a row tells a stretch that is a leak by the rule."""
    doc, item, at, place, n, equal = hit
    told = [
        sum(x == y for x, y in zip(words[at : at + n], mine[place : place + n]))
        for words in (D.words_of(t) for d, t in docs if d == doc)
        for mine in (D.words_of(t) for i, t in items if i == item)
        if n >= D.least_words(len(mine)) and at + n <= len(words) and place + n <= len(mine)
    ]
    return equal in told and 4 * equal >= 3 * n


def patterns(n):
    """All sets of changed places that leave a stretch of n words a leak."""
    most = n - D.least_equal(n)
    return [set(c) for k in range(most + 1) for c in itertools.combinations(range(n), k)]


def test_masks_hit_every_pattern_of_long_stretches():
    for n in range(D.MIN_WORDS, 2 * D.MIN_WORDS):
        for changed in itertools.combinations(range(n), n - D.least_equal(n)):
            assert any(
                all(at + k not in changed for k, c in enumerate(mask) if c == "1")
                for mask in D.MASKS
                for at in range(n - len(mask) + 1)
            )


@pytest.mark.parametrize("n", range(1, 17))
def test_every_pattern_of_changes_is_found(n):
    item = [f"w{k}" for k in range(n)]
    texts = [
        " ".join(["before", *("x" if k in changed else w for k, w in enumerate(item)), "after"])
        for changed in patterns(n)
    ]
    got = {h[0] for h in D.batch_leaks(pa.array(texts), D.Seeds([(7, " ".join(item))]))}
    assert got == set(range(len(texts)))


def test_hits_are_looked_at_in_pieces(monkeypatch):
    seeds = D.Seeds([(k, "what is the " + word) for k, word in enumerate(["name", "time", "age", "sum"])])
    texts = pa.array(["what is the name of it", "so what is the age", "what was the sum", "the sum"] * 5)
    whole = sorted(D.batch_leaks(texts, seeds))
    monkeypatch.setattr(D, "HIT_ROWS", 3)
    assert sorted(D.batch_leaks(texts, seeds)) == whole and len(whole) > 15


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(500)}"
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([40, 25, 14, 10, 7, 3, 60])]
    items += [(7, None), (8, ""), (9, "!!!"), (2, items[2][1])]
    docs = []
    for k in range(120):
        text = [word() for _ in range(rng.randrange(60))]
        passage = D.words_of(rng.choice(items[:7])[1])
        passage = [w.decode() for w in passage]
        for _ in range(rng.randrange(4)):
            passage[rng.randrange(len(passage))] = "changed"
        cut = rng.randrange(len(passage)) if rng.random() < 0.3 else 0
        text[10:10] = passage[cut:]
        docs.append((k, ", ".join(w.upper() if rng.random() < 0.2 else w for w in text)))
    docs += [(120, None), (121, ""), (122, "filler " * 30_000 + items[0][1] + " tail" * 10), (3, docs[3][1])]
    return docs, items


def test_leaks_are_those_of_all_alignments(spark, planted):
    docs, items = planted
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, item_id int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in D.leaks(df, bench).collect())
    assert all(holds(docs, items, g) for g in got)
    want = plain([d for d in docs if d[0] != 122], items[:7])
    pairs = {g[:2] for g in got if g[0] != 122}
    assert pairs == want
    repeated = [g for g in got if g[0] == 3]
    assert len(repeated) == 2 * len(set(repeated)) or docs[3] not in docs[:3] + docs[4:]
    assert [(g[1], g[2], g[5]) for g in got if g[0] == 122] == [(0, 30_000, 40)]
    assert sorted(tuple(r) for r in D.leaks(df, bench, block_words=30).collect()) == got
    bad = {g[0] for g in got}
    clean = D.without_leaks(df, bench, block_words=30)
    assert clean.columns == df.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d[0] for d in docs if d[0] not in bad)


def test_no_rows(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.leaks(df.limit(0), bench).collect() == []
    assert D.leaks(df, bench.limit(0)).collect() == []
    assert D.without_leaks(df, bench.limit(0)).count() == 1
    assert [tuple(r) for r in D.leaks(df, bench).collect()] == [(1, 1, 0, 0, 2, 2)]


def test_whole_table(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = {tuple(r) for r in registry.QUERIES["op1_spaced_seeds"](spark, sf_dir).collect()}
    have = {(d, i) for d, t in docs for i, p in items if b" ".join(D.words_of(p)) in b" ".join(D.words_of(t))}
    assert have <= {g[:2] for g in got}
    assert all(n >= 0.75 * words >= 7.5 for *_, words, n in got)


def any_stretch(equal, least):
    """Whether some stretch is a leak, by trying all."""
    n = len(equal)
    return any(4 * sum(equal[i:j]) >= 3 * (j - i) for i in range(n) for j in range(i + least, n + 1))


def test_any_stretch_of_an_alignment_is_a_leak():
    rng = random.Random(3)
    found = 0
    for _ in range(3000):
        equal = [rng.random() < rng.choice((0.5, 0.7, 0.8)) for _ in range(rng.randrange(1, 40))]
        least = rng.choice((3, 7, 10))
        leak = D.leak_in(D.np.array(equal), least)
        assert (leak is not None) == any_stretch(equal, least)
        if leak:
            start, n, same = leak
            assert same == sum(equal[start : start + n]) and n >= least and 4 * same >= 3 * n
            found += 1
    assert 500 < found < 2500


def test_more_of_an_item_hides_no_leak(spark):
    words = lambda name, n: [f"{name}{k}" for k in range(n)]
    items = [words("a", 33), words("b", 230), *(words(f"c{k}x", 10) for k in range(4))]
    texts = [
        items[0][:12] + words("x", 10) + items[0][22:],
        items[1][:100] + words("y", 60) + items[1][160:],
    ]
    for k, at in enumerate((0, 1, 8, 9)):
        texts.append(words("p", 5) + items[k + 2][:at] + ["changed"] + items[k + 2][at + 1 :] + words("q", 5))
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.words, r.equal_words) for r in D.leaks(df, bench).collect()}
    assert set(got) == {(k, k) for k in range(6)}
    assert [got[k, k] for k in range(2, 6)] == [(10, 9)] * 4
    assert D.without_leaks(df, bench).count() == 0

import random

import pyarrow as pa
import pytest

from tapeline.llm import jaccard, registry, shingles
from tests.llm import brute


def rows(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = rows(registry.QUERIES["op5_ngram_jaccard"](spark, sf_dir))
    assert got == brute.components([tuple(d) for d in docs])


def variants(seed):
    """Texts that share passages, chains of edited copies, and odd ones."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(60)]
    base = [word() for _ in range(80)]
    texts = [" ".join(base)]
    for _ in range(60):  # near copies of copies
        copy = texts[rng.randrange(len(texts))].split()
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(len(copy))] = word()
        texts.append(" ".join(copy))
    for _ in range(30):  # a passage that is too little of the text, or nearly all of it
        extra = [word() for _ in range(rng.choice([5, 10, 20, 120]))]
        texts.append(" ".join(passage + extra))
    texts += [texts[0]] * 3 + [texts[0].upper()] + [None, "", " \t\n", "one two", "One\x0btwo", "ÉTÉ été"]
    texts += ["x " * 50_000]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_edges(spark, seed):
    texts = variants(seed)
    random.Random(seed).shuffle(texts)
    docs = [(7 * i + 3, t, "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string, component_id string").repartition(5)
    assert rows(jaccard.similar_groups(df)) == brute.components([d[:2] for d in docs])


def test_repeated_null_and_no_rows(spark):
    schema = "doc_id long, text string"
    text = "a b c d e f g"
    df = spark.createDataFrame([(2, text), (2, text), (None, text), (5, "q r"), (None, "z")], schema)
    got = sorted(map(str, jaccard.similar_groups(df).collect()))
    want = [(2, 3, 2), (2, 3, 2), (None, 3, 2), (5, 1, 5), (None, 1, None)]
    line = "Row(doc_id={}, n_shingles={}, component_id={})"
    assert got == sorted(line.format(*w) for w in want)
    assert jaccard.similar_groups(df.limit(0)).collect() == []
    kept = jaccard.without_similar(df.filter("doc_id IS NOT NULL"))
    assert sorted(map(tuple, kept.collect())) == [(2, text), (2, text), (5, "q r")]


def test_words_and_sets_are_those_of_the_contract():
    texts = [*variants(3), "  lead", "a\x1cb c", "d e f g h i j a b c d e f g h"]
    sizes = [len(s) for s in shingles.sets_of(pa.array(texts))]
    assert sizes == [len(brute.shingles(t)) for t in texts]
    one = list(shingles.sets_of(pa.array(texts)))
    for k in range(0, len(texts), 7):  # a slice hashes like the whole
        (again,) = shingles.sets_of(pa.array(texts).slice(k, 1))
        assert again.tolist() == one[k].tolist()

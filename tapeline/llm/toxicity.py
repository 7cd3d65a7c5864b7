"""Toxic documents and sentences, learnt from labels of documents only.

Multiple-instance learning: each sentence has a chance to be toxic, a logistic
function of the weights of its words and of how they begin, each counted once; a
document is toxic if any of its sentences is (noisy-or).  The weights are fitted to
the labels of documents, and then tell which sentences are to blame.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import stored, without
from tapeline.llm.shingles import Lookup, chunks, words_at

MAX_LABELLED = 4_000  # documents of each label that the model is fitted on
PREFIXES = (4, 5, 6, 7, 8)  # bytes of a word's beginning that count as features
FEATURES = 1_024  # words and beginnings that have a weight
LEAST_DOCS = 5  # of the sample that a feature must be in
LEAST_CHI = 30.0  # chi-square of a feature with the label
STEPS, RATE, DECAY = 300, 0.1, 0.1
THRESHOLD = 0.7
BLAME = 0.5  # a sentence with this chance is reported

#: Letters, digits, apostrophes and all bytes beyond ASCII.
IS_WORD = np.array([c > 127 or c == 39 or chr(c).isalnum() for c in range(256)])
#: Sentences end at these.
ENDS = np.isin(np.arange(256), list(b".!?\n\r"))


@dataclass
class Model:
    """Sorted hashes of features, their weights, and the bias of a sentence."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


NONE = Model(np.zeros(0, np.uint64), np.zeros(0), -np.inf)


def sentences(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a piece of a column (see chunks): features, the sentence of each (numbered
    over the piece, only those with words), and the first byte of each sentence's
    first word."""
    h, places = words_at(data, edges, IS_WORD, PREFIXES)
    marks = np.zeros(len(data) + 1, np.int64)
    if len(data):
        marks[1:] = ENDS[data]
    marks[edges] += 1
    region = np.cumsum(marks)
    there, first = np.unique(region[places], return_index=True)
    # whole words come first, in order, so the first of a region starts its sentence
    return h, np.searchsorted(there, region[places]), places[first]


def feature_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """feature, toxic, clean: of how many documents of the sample it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            for i, data, edges in chunks(batch.column(1)):
                h, places = words_at(data, edges, IS_WORD, PREFIXES)
                row = np.searchsorted(edges, places, side="right") - 1
                order = np.lexsort((row, h))
                h, row = h[order], row[order]
                new = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))[: len(h)]
                h, row = h[new], row[new]
                of_all = np.flatnonzero(np.append(True, h[1:] != h[:-1])[: len(h)])
                n = np.diff(np.append(of_all, len(h)))
                toxic = np.add.reduceat(label[i + row], of_all) if len(h) else n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[of_all].view(np.int64)), pa.array(toxic.astype(np.int64)), pa.array(n)],
                    ["feature", "toxic", "n"],
                )

    found = docs.select("label", text_col).mapInArrow(run, "feature bigint, toxic bigint, n bigint")
    return found.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))


def telling(docs: DataFrame, text_col: str, size: int, toxic: int) -> np.ndarray:
    """Sorted hashes of the features that tell the labels apart best, by
    chi-square."""
    share = toxic / size
    expected = F.col("n") * share
    spread = expected * (1 - share) * (1 - F.col("n") / size)
    chi = F.pow(F.col("toxic") - expected, 2) / F.greatest(spread, F.lit(1e-9))
    best = (
        feature_counts(docs, text_col)
        .filter(F.col("n") >= LEAST_DOCS)
        .select("feature", chi.alias("chi"))
        .filter(F.col("chi") >= LEAST_CHI)
        .orderBy(F.desc("chi"), "feature")
        .limit(FEATURES)
        .collect()
    )
    return np.sort(np.array([r["feature"] for r in best], np.int64).view(np.uint64))


def instances(docs: DataFrame, text_col: str, features: np.ndarray) -> DataFrame:
    """label, features, places, sentences of each document: the numbers of the
    features it has, those of their sentences, and how many sentences there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Lookup(features)
        for batch in batches:
            words, places, sizes = [], [], []
            for _, data, edges in chunks(batch.column(1)):
                h, sentence, starts = sentences(data, edges)
                sentence, column = once(find, h, sentence)
                firsts = np.searchsorted(starts, edges)
                at = np.searchsorted(sentence, firsts)
                for r in range(len(edges) - 1):
                    part = slice(at[r], at[r + 1])
                    words.append(column[part].astype(np.int32))
                    places.append((sentence[part] - firsts[r]).astype(np.int32))
                sizes.extend(np.diff(firsts).tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(words, pa.list_(pa.int32())),
                    pa.array(places, pa.list_(pa.int32())),
                    pa.array(sizes, pa.int32()),
                ],
                ["label", "features", "places", "sentences"],
            )

    return docs.select("label", text_col).mapInArrow(
        run, "label int, features array<int>, places array<int>, sentences int"
    )


def labelled(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str, text_col: str) -> DataFrame:
    """label and text of at most MAX_LABELLED documents of each label, those of the
    smallest CRC-32 of the id.  An id with both labels counts as toxic."""
    known = labels.filter(learn & F.col("label").isin(0, 1) & F.col(id_col).isNotNull())
    known = known.groupBy(id_col).agg(F.max("label").cast("int").alias("label"))
    order = F.crc32(F.col(id_col).cast("string"))
    few = [
        known.filter(F.col("label") == k).orderBy(order, id_col).limit(MAX_LABELLED) for k in (0, 1)
    ]
    few = few[0].unionByName(few[1])
    # at most 2 * MAX_LABELLED rows of an id and a label
    return docs.select(id_col, text_col).join(F.broadcast(few), id_col).select("label", text_col)


def fitted(features: np.ndarray, docs: list[tuple], toxic_share: float) -> Model:
    """The model for documents (label, features, places, sentences).  The labels
    weigh as much as their share among all labelled documents says."""
    label = np.array([d[0] for d in docs], dtype=float)
    share = label.mean()
    sizes = np.array([d[3] for d in docs])
    owner = np.repeat(np.arange(len(docs)), sizes)
    base = np.repeat(np.cumsum(sizes) - sizes, [len(d[1]) for d in docs])
    column = np.array([c for d in docs for c in d[1]], dtype=np.int64)
    row = np.array([p for d in docs for p in d[2]], dtype=np.int64) + base
    weigh = np.where(label > 0, toxic_share / share, (1 - toxic_share) / max(1 - share, 1e-9))
    weigh /= len(docs)

    # Adam on the mean log loss; the last entry is the bias
    x = np.zeros(len(features) + 1)
    x[-1] = -4.0
    m, v = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, STEPS + 1):
        p = chance(np.bincount(row, x[column], len(owner)) + x[-1])
        clean = np.exp(np.bincount(owner, np.log1p(-p), len(docs)))
        pull = np.where(label > 0, -clean / np.maximum(1 - clean, 1e-9), 1.0) * weigh
        g = pull[owner] * p
        slope = np.append(np.bincount(column, g[row], len(features)), g.sum())
        slope[:-1] += DECAY * x[:-1] / len(docs)
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        x -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-10)
    return Model(features, x[:-1], float(x[-1]))


def once(find: Lookup, h: np.ndarray, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sentence and number of each known feature, repeats within a sentence
    left out, in the order of the sentences."""
    where, column = find(h)
    pairs = np.unique(sentence[where] * max(len(find.hashes), 1) + column)
    return pairs // max(len(find.hashes), 1), pairs % max(len(find.hashes), 1)


def chance(z: np.ndarray) -> np.ndarray:
    return np.minimum(1 / (1 + np.exp(-np.clip(z, -40, 40))), 1 - 1e-12) * (z > -np.inf)


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """A model from the labelled documents for which ``learn``, a condition on the
    id, holds.  Of all others no label is looked at.  Without a toxic one, every
    score will be 0."""
    labels = labels.select(id_col, F.col(label_col).alias("label"))
    of_all = labels.filter(learn & F.col("label").isin(0, 1)).agg(F.avg("label"))
    share = of_all.collect()[0][0]
    if not share:
        return NONE
    sample = stored(labelled(docs, labels, learn, id_col, text_col), "labelled")
    sizes = dict(sample.groupBy("label").count().collect())
    if not sizes.get(1):
        return NONE
    features = telling(sample, text_col, sum(sizes.values()), sizes[1])
    rows = instances(sample, text_col, features).collect()
    return fitted(features, sorted(tuple(r) for r in rows), share)


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with score (chance that any sentence is toxic, 0 to 1) and offending: of
    each sentence with a chance of a half or more the start and stop, in bytes of
    the text, and the chance.

    Texts without words score 0, null and empty ones too.  Input columns of the
    added names are replaced.  Rows are scored one by
    one, whole, in the order they come; no rows give no rows."""
    docs = without(docs, "score", "offending")
    columns = docs.columns
    place = columns.index(text_col)
    schema = docs.select(*[F.col(f"`{c}`") for c in columns], F.lit(0.0).alias("score"), F.array(
        F.struct(F.lit(0).alias("start"), F.lit(0).alias("stop"), F.lit(0.0).alias("score"))
    ).alias("offending")).schema
    kind = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Lookup(model.features)
        for batch in batches:
            scores, blamed = [], []
            for _, data, edges in chunks(batch.column(place)):
                score, rows, spans = piece_scores(data, edges, model, find)
                scores.append(score)
                lists: list[list] = [[] for _ in score]
                for r, span in zip(rows, spans):
                    lists[r].append(span)
                blamed.extend(lists)
            new = [pa.array(np.concatenate(scores or [[]]), pa.float64()), pa.array(blamed, pa.list_(kind))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *new], [*columns, "score", "offending"]
            )

    return docs.mapInArrow(run, schema)


def piece_scores(data: np.ndarray, edges: np.ndarray, model: Model, find: Lookup) -> tuple:
    """Score of each row, and the row and span of each sentence to blame."""
    h, sentence, starts = sentences(data, edges)
    has, column = once(find, h, sentence)
    z = np.bincount(has, model.weights[column], len(starts)) + model.bias
    p = chance(z)
    owner = np.searchsorted(edges, starts, side="right") - 1
    score = -np.expm1(np.bincount(owner, np.log1p(-p), len(edges) - 1))
    rows, spans = [], []
    for s in np.flatnonzero(p >= BLAME).tolist():
        row, start = int(owner[s]), int(starts[s])
        end = np.flatnonzero(ENDS[data[start : edges[row + 1]]])
        stop = start + int(end[0]) + 1 if len(end) else int(edges[row + 1])
        first = int(edges[row])
        rows.append(row)
        spans.append({"start": start - first, "stop": stop - first, "score": float(p[s])})
    return np.clip(score, 0.0, 1.0) + 0.0, rows, spans

"""Masked pseudo-likelihood: how well each word of a text follows from its neighbours.

A small network sees two words on either side of a masked one and gives every word
of its vocabulary a chance.  The logarithms of the chances of the words that are
there, each predicted with all others in sight, add up to the score of a document.

The network tells frequent words and classes of the others; within its class a word has
the chance that its number in all documents gives it.  So every word counts by itself,
however many there are, and the chances of all words add up to one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from tapeline.llm.common import new_folder, stored, without
from tapeline.llm.shingles import Lookup, chunks, words_at

SIDE = 2  # words seen on either side
FREQUENT = 192  # words that are tokens of their own
RARE = 64  # classes that all other words are dealt to by their hash; a power of two
WIDTH = 16  # of an embedding
ROUNDS = 2  # over all documents, with the mean of the tasks' weights after each
MASKED = ROUNDS  # one token in so many is predicted in a round, each in one of them
BATCH = 1_024  # tokens per step
RATE = 0.2
REDUCERS = 32  # tasks that add up weights, and rows of weights that reach the driver
STEP = 1_024  # tokens scored at a time
FEW = 128  # tokens of a step whose chances are held at a time: these stay in a CPU's cache
LARGE = 60  # exponents that single precision takes without care
PIECE_BYTES = 4 << 20  # of text at a time; word counts of larger pieces are fewer rows
TABLE_BYTES = 8 << 20  # of text whose rare words are looked up together
PIECE = "_piece"
COUNTS = "word bigint, n bigint"
SEED = 1

TOKENS = FREQUENT + RARE
OUTSIDE = TOKENS  # stands before and after a text
WINDOW = [k for k in range(-SIDE, SIDE + 1) if k]


def word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """word (hash), n: over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, edges in chunks(batch.column(0), PIECE_BYTES):
                words, n = np.unique(words_at(data, edges)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"]
                )

    found = docs.select(text_col).mapInArrow(run, COUNTS)
    return found.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Sorted hashes of the frequent words; a token is a place among them, or beyond
    them a hash class.  ``counts`` is the folder of the table of all words, ``classes``
    has the words and the distinct words of every hash class."""

    words: np.ndarray
    counts: str | None = None
    classes: np.ndarray | None = None

    def tokens(self, hashes: np.ndarray) -> np.ndarray:
        out = (FREQUENT + (hashes % np.uint64(RARE)).astype(np.int64)).astype(np.int64)
        where, place = Lookup(self.words)(hashes)
        out[where] = place
        return out

    def log_shares(self, hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Logarithm of the chance of a word within its hash class, by its number; all
        words that were never seen share one more place."""
        whole = self.classes.sum(axis=1) + 1.0
        return np.log((n + 1.0) / whole[(hashes % np.uint64(RARE)).astype(np.int64)])


def learnt_vocabulary(docs: DataFrame, text_col: str = "text") -> Vocabulary:
    """The numbers of all words of all documents, kept in the shared folder, and the most
    frequent ones; ties go to the smaller hash."""
    spark, folder = docs.sparkSession, new_folder(docs.sparkSession, "words")
    word_counts(docs, text_col).write.parquet(folder)
    counts = spark.read.schema(COUNTS).parquet(folder)
    top = [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()]
    others = counts.filter(~F.col("word").isin(top)).groupBy(F.col("word").bitwiseAND(RARE - 1).alias("class"))
    classes = np.zeros((RARE, 2))
    for r in others.agg(F.sum("n").alias("n"), F.count("*").alias("distinct")).collect():
        classes[r["class"]] = r["n"], r["distinct"]
    return Vocabulary(np.sort(np.array(top, np.int64).view(np.uint64)), folder, classes)


SHAPES = {
    "seen": (TOKENS + 1, WIDTH),  # embeddings of neighbours
    "place": (len(WINDOW), WIDTH),  # by which a neighbour's embedding is multiplied
    "shift": (WIDTH,),
    "out": (WIDTH, TOKENS),
    "bias": (TOKENS,),
}


def first_weights() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    w = {k: np.zeros(s, np.float32) for k, s in SHAPES.items()}
    w["seen"] += rng.normal(0, 0.3, SHAPES["seen"]).astype(np.float32)
    w["out"] += rng.normal(0, 0.3, SHAPES["out"]).astype(np.float32)
    w["place"] += 1
    return w


def flat(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel().astype(np.float64) for k in SHAPES])


def shaped(x: np.ndarray) -> dict[str, np.ndarray]:
    parts = np.split(x, np.cumsum([int(np.prod(s)) for s in SHAPES.values()])[:-1])
    return {k: p.reshape(s).astype(np.float32) for (k, s), p in zip(SHAPES.items(), parts)}


def laid_out(data: np.ndarray, edges: np.ndarray, words: Vocabulary) -> tuple:
    """Tokens of a piece with SIDE times OUTSIDE before, between and after the rows;
    the places of the true ones, and the row of each."""
    return laid(*words_at(data, edges), edges, words)


def laid(h: np.ndarray, starts: np.ndarray, edges: np.ndarray, words: Vocabulary) -> tuple:
    row = np.searchsorted(edges, starts, side="right") - 1
    place = np.arange(len(h)) + SIDE * (row + 1)
    out = np.full(len(h) + SIDE * len(edges), OUTSIDE, np.int64)
    out[place] = words.tokens(h)
    return out, place, row


def hidden(w: dict, tokens: np.ndarray, place: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The tokens on either side of the places, and what the network makes of them."""
    near = [tokens[place + k] for k in WINDOW]
    parts = [w["seen"] * p for p in w["place"]]
    parts[0] += w["shift"]
    x = parts[0].take(near[0], axis=0)
    for part, t in zip(parts[1:], near[1:]):
        x += part.take(t, axis=0)
    return near, np.tanh(x, out=x)


def with_ones(h: np.ndarray) -> np.ndarray:
    return np.hstack([h, np.ones((len(h), 1), h.dtype)])


def output(w: dict) -> tuple[np.ndarray, bool]:
    """The last layer with its bias as a row below, and whether it can make numbers whose
    exponentials are too large: tanh keeps them below the sum of a token's weights."""
    out = np.vstack([w["out"], w["bias"]])
    return out, bool(np.abs(out).sum(axis=0).max() > LARGE)


def logits(out: np.ndarray, large: bool, h: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Logarithms of what the network gives every token, up to a sum per row, written to
    ``room``; h has a column of ones behind it."""
    z = np.matmul(h, out, out=room[: len(h)])
    if large:
        z -= z.max(axis=1, keepdims=True)
    return z


def log_chances(w: dict, tokens: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Of the token at each place, given its neighbours."""
    out = np.empty(len(place), np.float32)
    last, large = output(w)
    room, ones, rows = np.empty((FEW, TOKENS), last.dtype), np.ones(TOKENS, last.dtype), np.arange(FEW)
    for i in range(0, len(place), STEP):
        at = place[i : i + STEP]
        h, own = with_ones(hidden(w, tokens, at)[1]), tokens[at]
        for j in range(0, len(at), FEW):
            some = slice(j, j + FEW)
            z = logits(last, large, h[some], room)
            mine = z[rows[: len(z)], own[some]]
            out[i + j : i + j + len(z)] = mine - np.log(np.exp(z, out=z) @ ones)
    return out


def gradient(w: dict, tokens: np.ndarray, place: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean log loss at the places, which rise."""
    near, h = hidden(w, tokens, place)
    last, large = output(w)
    room = np.empty((FEW, TOKENS), h.dtype)
    both, own = with_ones(h), tokens[place]
    out, back = np.zeros((WIDTH + 1, TOKENS), h.dtype), np.empty_like(h)
    ones, rows, to_back = np.ones(TOKENS, h.dtype), np.arange(FEW), np.ascontiguousarray(w["out"].T)
    for i in range(0, len(place), FEW):
        some = slice(i, i + FEW)
        z = logits(last, large, both[some], room)
        total = np.exp(z, out=z) @ ones
        z[rows[: len(z)], own[some]] -= total
        share = (1 / (total * len(place)))[:, None]
        np.multiply(z @ to_back, share, out=back[some])
        out += (both[some] * share).T @ z
    back *= 1 - h * h
    g = {"out": out[:-1], "bias": out[-1], "shift": back.sum(axis=0)}
    g["place"] = np.stack([np.einsum("ij,ij->j", back, w["seen"].take(t, axis=0)) for t in near])
    # what every place in sight of a target feels of it, one dimension to a row
    first, n = place[0] - SIDE, place[-1] + 1 - place[0]
    there, felt = np.zeros((WIDTH, n), h.dtype), np.zeros((WIDTH, n + 2 * SIDE), h.dtype)
    there[:, place - place[0]] = back.T
    part = np.empty_like(there)
    for k, p in zip(WINDOW, w["place"]):
        felt[:, SIDE + k : SIDE + k + n] += np.multiply(there, p[:, None], out=part)
    cell = tokens[first : first + n + 2 * SIDE] + len(w["seen"]) * np.arange(WIDTH)[:, None]
    seen = np.bincount(cell.ravel(), felt.ravel(), w["seen"].size)
    g["seen"] = seen.reshape(WIDTH, -1).T.astype(h.dtype)
    return g


class Learner:
    """Adagrad steps on batches of masked tokens."""

    def __init__(self, w: dict[str, np.ndarray]):
        self.w = {k: v.copy() for k, v in w.items()}
        self.squares = {k: np.full(s, 1e-3, np.float32) for k, s in SHAPES.items()}
        self.n = 0

    def learn(self, tokens: np.ndarray, place: np.ndarray) -> None:
        for i in range(0, len(place), BATCH):
            at = place[i : i + BATCH]
            for k, g in gradient(self.w, tokens, at).items():
                self.squares[k] += g * g
                self.w[k] -= RATE * g / np.sqrt(self.squares[k])
            self.n += len(at)


def targets(place: np.ndarray, turn: int) -> np.ndarray:
    """The places that are predicted in a round."""
    return place[turn % MASKED :: MASKED]


WEIGHTS = "task bigint, n bigint, weights binary"


def one_round(docs: DataFrame, text_col: str, words: Vocabulary, w: dict, turn: int) -> dict:
    """Every task goes on from the same weights over all its documents; the mean of
    what they learn, by the tokens they have seen.

    The tasks' weights are added up by a fixed number of tasks, in the order of the
    tasks, so a task that runs again changes nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = Learner(w)
        for batch in batches:
            for _, data, edges in chunks(batch.column(0), PIECE_BYTES):
                tokens, place, _ = laid_out(data, edges, words)
                learner.learn(tokens, targets(place, turn))
        if learner.n:
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pylist(
                [{"task": task, "n": learner.n, "weights": flat(learner.w).tobytes()}]
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = n = None
        for batch in batches:
            for row in batch.to_pylist():
                x = np.frombuffer(row["weights"], np.float64) * row["n"]
                total, n = (x, row["n"]) if total is None else (total + x, n + row["n"])
        if n:
            yield pa.RecordBatch.from_pylist([{"task": 0, "n": n, "weights": (total / n).tobytes()}])

    parts = docs.select(text_col).mapInArrow(run, WEIGHTS)
    parts = parts.repartitionById(REDUCERS, (F.col("task") % REDUCERS).cast("int")).sortWithinPartitions("task")
    sums = sorted((r["weights"], r["n"]) for r in parts.mapInArrow(add, WEIGHTS).collect())
    if not sums:
        return w
    total = sum(n for _, n in sums)
    return shaped(sum(np.frombuffer(bytes(x), np.float64) * (n / total) for x, n in sums))


@dataclass
class Model:
    words: Vocabulary
    weights: dict[str, np.ndarray]


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """The vocabulary from the counts of all words, and the network from all
    documents: over the rounds every token is masked and predicted once."""
    words = learnt_vocabulary(docs, text_col)
    w = first_weights()
    for turn in range(ROUNDS):
        w = one_round(docs, text_col, words, w, turn)
    return Model(words, w)


def in_pieces(docs: DataFrame, text_col: str) -> DataFrame:
    """docs with the number of the piece a row is in: rows of one task of at most
    TABLE_BYTES of text, or a longer one.  Kept in the shared folder, so that a row has one
    number however often it is read."""
    columns = docs.columns
    place_of = columns.index(text_col)
    schema = StructType([*docs.schema.fields]).add(PIECE, LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, _, edges in chunks(batch.column(place_of), TABLE_BYTES):
                n = len(edges) - 1
                number = pa.array(np.full(n, piece))
                yield pa.RecordBatch.from_arrays([*batch.slice(first, n).columns, number], [*columns, PIECE])
                piece += 1

    return stored(docs.mapInArrow(run, schema), "texts")


def rare_words(texts: DataFrame, words: Vocabulary, text_col: str) -> DataFrame:
    """word, n (0 if it was never counted) and the pieces that have it; frequent words
    are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            piece = batch.column(0).to_numpy()
            for a, b in pairwise([0, *(np.flatnonzero(np.diff(piece)) + 1), len(piece)]):
                parts = [words_at(data, edges)[0] for _, data, edges in chunks(batch.column(1).slice(a, b - a))]
                found = np.unique(np.concatenate(parts or [np.zeros(0, np.uint64)]))
                found = found[words.tokens(found) >= FREQUENT].view(np.int64)
                where = np.repeat(piece[a:b][:1], len(found))
                yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(found)], [PIECE, "word"])

    found = texts.select(PIECE, F.col(f"`{text_col}`")).mapInArrow(run, f"{PIECE} bigint, word bigint")
    counts = texts.sparkSession.read.schema(COUNTS).parquet(words.counts)
    return found.join(counts, "word", "left").select(PIECE, "word", F.coalesce("n", F.lit(0)).alias("n"))


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with tokens (number of words), log_likelihood (sum of the logarithms of
    the chances of all words, each given its neighbours) and mean_log_likelihood.

    Words are runs without ASCII blanks, A-Z in lower case.  A null, empty or blank
    text has no tokens, a sum of 0 and no mean.  Input columns of the added names are
    replaced.  Rows are scored one by one, whole;
    no rows give no rows.

    The texts are kept in pieces.  The distinct rare words of every piece meet the counts
    of all words by a join, and their numbers go back to the piece."""
    added = ["tokens", "log_likelihood", "mean_log_likelihood"]
    docs = without(docs, *added)
    columns, words, weights = docs.columns, model.words, model.weights
    schema = docs.select(
        *[F.col(f"`{c}`") for c in columns],
        F.lit(0).cast("bigint").alias(added[0]),
        F.lit(0.0).alias(added[1]),
        F.lit(None).cast("double").alias(added[2]),
    ).schema

    def run(rows: pa.Table, known: pa.Table) -> pa.Table:
        known = known.sort_by("word")
        listed = known["word"].to_numpy()
        shares = words.log_shares(listed.view(np.uint64), known["n"].to_numpy())
        counts, sums = [], []
        for _, data, edges in chunks(rows[text_col].combine_chunks()):
            h, starts = words_at(data, edges)
            tokens, place, row = laid(h, starts, edges, words)
            chance = log_chances(weights, tokens, place).astype(float)
            rare = tokens[place] >= FREQUENT
            chance[rare] += shares[np.searchsorted(listed, h[rare].view(np.int64))]
            counts.append(np.bincount(row, minlength=len(edges) - 1))
            sums.append(np.bincount(row, chance, len(edges) - 1))
        n = np.concatenate(counts).astype(np.int64)
        total = np.concatenate(sums).astype(float)
        mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
        return pa.Table.from_arrays(
            [*[rows[c] for c in columns], pa.array(n), pa.array(total), mean], [*columns, *added]
        )

    texts = in_pieces(docs, text_col)
    known = rare_words(texts, words, text_col)
    return texts.groupBy(PIECE).cogroup(known.groupBy(PIECE)).applyInArrow(run, schema)

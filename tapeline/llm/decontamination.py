"""Passages of a benchmark in documents, found by spaced seeds.

A seed is a fixed mask over a few neighbouring words.  Only the words under its
ones are hashed, so a changed word under a zero does not hide a passage.  Equal
hashes of test and training text are hits; around each hit the two texts are laid
over each other word by word, and any stretch that is equal enough is a leak.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed masks.  Every stretch of 10 words or more of which three quarters are equal is
#: hit by one of them, wherever its changes are: a test tries all patterns of 10 to 19
#: words, and of two halves of a longer stretch one has its share of equal words.
MASKS = ("110111", "11010011", "1010001011", "11100000101")
MIN_WORDS = 10  # of a stretch, or nine tenths of a shorter item
IDENTITY = 0.75  # share of equal words in a stretch
BLOCK_WORDS = 1_000_000  # words of benchmark that a task holds at a time
BATCH_WORDS = 500_000  # words of documents that are hashed at a time
HIT_ROWS = 2_000_000  # hits that are looked at together (but those of a place as a whole)

#: Blanks and ASCII punctuation but _ become blanks, in one pass over the bytes.
SPACED = bytes(c if c > 127 or chr(c).isalnum() or c == 95 else 32 for c in range(256))
OTHER_SIGNS = re.compile(r"[^\w\x00-\x7f]+")
#: A multiplier per word of a mask; any odd numbers would do.
ODD = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1 for k in range(64)], dtype=np.uint64)

HITS = "item_id bigint, doc_word bigint, item_word int, words int, equal_words int"


def words_of(text: str | None) -> list[bytes]:
    """Runs of letters, digits and _, in lower case, as UTF-8."""
    if not text:
        return []
    text = text.lower()
    if not text.isascii():
        text = OTHER_SIGNS.sub(" ", text)
    return text.encode("utf-8", "replace").translate(SPACED).split()


class Seeds:
    """The seeds of a block of items, ready to look documents up in.

    Words get numbers from 1; a word that no item has is 0 and meets nothing.  An
    item of MIN_WORDS or more has a seed per mask and place.  One shorter is a leak as a
    whole or not at all: where it may have c changed words, each of its c + 1 seeds has
    every (c + 1)th word, so that one of them is free of changes."""

    def __init__(self, items: Sequence[tuple[int, str | None]], masks: Sequence[str] = MASKS):
        self.ids, texts = [], []
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        for item, text in items:
            words = words_of(text)
            if words:
                self.ids.append(item)
                texts.append(np.array([number(w, len(self.vocabulary) + 1) for w in words]))
        self.lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1].astype(np.int64)
        self.flat = np.concatenate([*texts, np.zeros(64, np.int64)])
        seeds: dict[tuple, list[tuple[int, np.ndarray]]] = {}
        fixed = [tuple(k for k, c in enumerate(mask) if c == "1") for mask in masks]
        for k, n in enumerate(self.lengths.tolist()):
            if n >= MIN_WORDS:
                for mask in fixed:
                    seeds.setdefault(mask, []).append((k, np.arange(max(n - mask[-1], 0))))
            else:
                step = n - least_equal(n) + 1
                for first in range(step):
                    mask = tuple(range(0, n - first, step))
                    seeds.setdefault(mask, []).append((k, np.array([first])))
        self.masks = [np.array(mask) for mask in seeds]
        self.tables = [self.table(np.array(mask), places) for mask, places in seeds.items()]

    def table(self, mask: np.ndarray, places: list[tuple[int, np.ndarray]]) -> tuple:
        """Sorted hashes, where each is (item, place), and a bit map over the high
        bits of the hashes that spares most lookups."""
        item = np.repeat([k for k, _ in places], [len(at) for _, at in places])
        place = np.concatenate([at for _, at in places])
        hashes = hashed(self.flat, mask)[self.starts[item] + place]
        order = np.argsort(hashes, kind="stable")
        bits = np.zeros(1 << 20, dtype=bool)
        bits[(hashes >> np.uint64(44)).astype(np.int64)] = True
        return hashes[order], item[order], place[order], bits


def hashed(words: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The hash of the words under the mask at each place that it fits."""
    n = len(words) - int(mask[-1])
    if n <= 0:
        return np.zeros(0, np.uint64)
    words = words.astype(np.uint64)
    total = np.zeros(n, np.uint64)
    for k, at in enumerate(mask):
        total += words[at : at + n] * ODD[k]
    total ^= total >> np.uint64(29)
    return total * np.uint64(0xBF58476D1CE4E5B9)


def best_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """Start, length and equal words of the stretch with the most equal words less
    unequal ones; the shortest of equals, then the first."""
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -1))])
    lowest = np.minimum.accumulate(total)
    gain = total - lowest
    ends = np.flatnonzero(gain == gain.max())
    last = np.maximum.accumulate(np.where(total == lowest, np.arange(len(total)), 0))
    end = int(ends[np.argmin(ends - last[ends])])
    start = int(last[end])
    return start, end - start, int(equal[start:end].sum())


def least_words(item_words: int) -> int:
    """Of a stretch that is a leak of an item of so many words."""
    return MIN_WORDS if item_words >= MIN_WORDS else -(-9 * item_words // 10)


def least_equal(words: int) -> int:
    """Equal words that a stretch of so many needs."""
    return math.ceil(IDENTITY * words)


def leak_in(equal: np.ndarray, least: int) -> tuple[int, int, int] | None:
    """Start, length and equal words of a stretch of at least so many words of which
    three quarters are equal, if there is any: the best stretch if it is one, else the
    one with the most equal words less three times the unequal ones; the shortest of
    equals, then the first."""
    if len(equal) < least:
        return None
    start, n, same = best_stretch(equal)
    if n >= least and same >= IDENTITY * n:
        return start, n, same
    # a stretch has its share of equal words if its sum is not below 0
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, IDENTITY / (IDENTITY - 1)))])
    starts = total[: len(total) - least]
    lowest = np.minimum.accumulate(starts)
    gain = total[least:] - lowest
    if gain.max() < 0:
        return None
    last = np.maximum.accumulate(np.where(starts == lowest, np.arange(len(starts)), 0))
    ends = np.flatnonzero(gain == gain.max())
    end = int(ends[np.argmin(ends - last[ends])])
    start, end = int(last[end]), end + least
    return start, end - start, int(equal[start:end].sum())


def found(words: np.ndarray, starts: np.ndarray, seeds: Seeds) -> Iterator[tuple]:
    """(document, item, place in the document, place in the item, words, equal words)
    of the best leak of each item in each document.

    ``words`` has the documents one after the other, each followed by as many zeros
    as a mask is long, so that no seed reaches over into the next."""
    edges = np.append(starts, len(words))
    best: dict[tuple, tuple] = {}
    seen = set()
    for item, lies in layings(words, seeds):
        length = int(seeds.lengths[item])
        # of the documents that the item could lie over, those with equal words there
        doc = int(np.searchsorted(starts, max(lies, 0), side="right")) - 1
        while doc < len(starts) and starts[doc] < lies + length:
            low, high = max(lies, int(edges[doc])), min(lies + length, int(edges[doc + 1]))
            if low < high and (item, lies, doc) not in seen:
                seen.add((item, lies, doc))
                first = int(seeds.starts[item])
                mine = seeds.flat[first + low - lies : first + high - lies]
                leak = leak_in(words[low:high] == mine, least_words(length))
                if leak:
                    start, n, equal = leak
                    hit = (equal, -n, -(low + start), low + start - lies)
                    best[doc, item] = max(best.get((doc, item), hit), hit)
            doc += 1
    for (doc, item), (equal, n, at, place) in sorted(best.items()):
        yield doc, item, -at - int(starts[doc]), place, -n, equal


def layings(words: np.ndarray, seeds: Seeds) -> Iterator[tuple[int, int]]:
    """(item, where its first word lies) of all hits, some more than once."""
    for mask, (hashes, item, place, bits) in zip(seeds.masks, seeds.tables):
        if not len(hashes):
            continue
        here = hashed(words, mask)
        at = np.flatnonzero(bits[(here >> np.uint64(44)).astype(np.int64)])
        low = np.searchsorted(hashes, here[at], side="left")
        n = np.searchsorted(hashes, here[at], side="right") - low
        at, low, n = at[n > 0], low[n > 0], n[n > 0]
        piece = (np.cumsum(n) - n) // HIT_ROWS
        for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(piece)) + 1):
            m = n[part]
            row = np.repeat(low[part], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            lies = np.stack([item[row], np.repeat(at[part], m) - place[row]], axis=1)
            yield from map(tuple, np.unique(lies, axis=0).tolist())


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document and item of which it holds a passage: the id, item_id,
    doc_word and item_word (where the passage starts, in words), words (its length)
    and equal_words.

    The item is laid over the document word by word, case and punctuation apart,
    where a seed hits.  It is a leak if any stretch of 10 words or more (nine tenths of
    a shorter item) has three quarters equal words, changed ones at its edges counted.
    Of each way to lay it the stretch with the most equal less unequal words is given
    if it is such a stretch, else the one with the most equal words less three times
    the unequal ones; of several in a document the one with the most equal words, then
    the shortest, then the first.
    Every stretch that is a leak is hit, whatever words of it are changed.

    Null and empty texts hold nothing and are held by nothing.  Repeated rows of
    documents give repeated rows; items equal in id and text count once, those of
    one id and other texts each for themselves.  Other columns are not looked at.

    Test text is far smaller than training text: it goes to the tasks in blocks of
    at most ``block_words`` words (an item of more is a block of its own), each with
    one pass over the documents, which are neither shuffled nor collected.
    """
    items = benchmark.select("item_id", F.col("text").alias("text")).distinct()
    weight = F.size(F.split(F.coalesce("text", F.lit("")), r"\W+"))
    out = None
    for block in blocks(items.withColumn("n", weight), block_words):
        part = passages(docs, block, id_col, text_col)
        out = part if out is None else out.unionByName(part)
    return passages(docs, [], id_col, text_col) if out is None else out


def blocks(items: DataFrame, block_words: int) -> Iterator[list[tuple]]:
    """The items in blocks, read one after the other from the cluster."""
    block: list[tuple] = []
    held = 0
    for row in items.toLocalIterator():
        if block and held + row["n"] > block_words:
            yield block
            block, held = [], 0
        block.append((row["item_id"], row["text"]))
        held += row["n"]
    if block:
        yield block


def passages(docs: DataFrame, items: list[tuple], id_col: str, text_col: str) -> DataFrame:
    """Leaks of one block of items."""
    sent = docs.sparkSession.sparkContext.broadcast(items)
    key = docs.schema[id_col].dataType.simpleString()
    names = [id_col, *(x.split()[0] for x in HITS.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = Seeds(sent.value)
        for batch in batches:
            hits = list(batch_leaks(batch.column(1), seeds))
            columns = [batch.column(0).take(pa.array([h[0] for h in hits], pa.int64()))]
            columns.append(pa.array([seeds.ids[h[1]] for h in hits], pa.int64()))
            for k, kind in ((2, pa.int64()), (3, pa.int32()), (4, pa.int32()), (5, pa.int32())):
                columns.append(pa.array([h[k] for h in hits], kind))
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {key}, {HITS}")


def batch_leaks(texts: pa.Array, seeds: Seeds) -> Iterator[tuple]:
    """As found, over a column of texts, a bounded number of words at a time (but a
    document as a whole)."""
    number = seeds.vocabulary.get
    gap = [0] * max([1, *(int(m[-1]) + 1 for m in seeds.masks)])
    flat: list[int] = []
    starts: list[int] = []
    done = 0

    def hits() -> Iterator[tuple]:
        for doc, *rest in found(np.array(flat, np.int64), np.array(starts, np.int64), seeds):
            yield done + doc, *rest

    for text in texts:
        starts.append(len(flat))
        flat.extend(map(number, words_of(text.as_py()), repeat(0)))
        flat.extend(gap)
        if len(flat) >= BATCH_WORDS:
            yield from hits()
            done += len(starts)
            flat, starts = [], []
    if starts:
        yield from hits()


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The documents that hold no passage of the benchmark (see leaks), with all
    their columns.  Rows are judged one by one and never shuffled."""
    items = benchmark.select("item_id", "text").distinct()
    columns = docs.columns
    place = columns.index(text_col)
    weight = F.size(F.split(F.coalesce("text", F.lit("")), r"\W+"))
    for block in blocks(items.withColumn("n", weight), block_words):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            seeds = Seeds(sent.value)
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[h[0] for h in batch_leaks(batch.column(place), seeds)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs

"""The language of a text, by n-gram filters that answer for all languages at once.

One Bloom filter per language would be looked up once per language.  Here the
filters are sliced by bits: a slot is a mask with one bit per language, and the AND
of the few slots of an n-gram gives all languages that contain it.  Masks have 64
bits; each 64 languages have slots of their own, under the same numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.llm.common import without
from tapeline.llm.shingles import mixed

GRAM = 4  # characters; the edge of a word counts as one
HASHES = 3
SLOTS_PER_GRAM = 16  # slots for each n-gram of the language that has the most
MAX_LABELLED = 2_000  # documents of a language that its n-grams are taken from
MASK_BITS = 64  # languages that a mask has bits for
LEAST_DOCS = 2  # of a language that an n-gram must be in
LEAST_SHARE = 0.1  # of its rate in the language where it is most frequent
CHUNK_CHARS = 1 << 20
UNKNOWN = "und"

ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


class Letters:
    """Which code points are letters; made once in a worker."""

    table: np.ndarray | None = None

    @classmethod
    def of(cls, codes: np.ndarray) -> np.ndarray:
        if cls.table is None:
            cls.table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        return cls.table[codes]


def pieces(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of some rows of a column at a time the code points, in lower case, and the
    row edges; a long text is a piece of its own."""
    held: list[str] = []
    size = 0
    for text in texts:
        low = (text.as_py() or "").lower()
        if held and size + len(low) > CHUNK_CHARS:
            yield codes(held)
            held, size = [], 0
        held.append(low)
        size += len(low)
    if held:
        yield codes(held)


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
    return flat, np.append(0, np.cumsum([len(t) for t in texts]))


def grams(flat: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams of a piece, their rows, and whether a row has letters.

    Runs of other signs are one edge of a word; an n-gram has letters only, but for
    an edge in front and behind."""
    rows = len(edges) - 1
    letter = Letters.of(flat)
    row = np.repeat(np.arange(rows), np.diff(edges))
    has = np.bincount(row[letter], minlength=rows) > 0
    edge = ~letter
    first = np.zeros(len(flat) + 1, bool)
    first[edges] = True
    keep = letter | ~np.append(False, edge[:-1]) | first[:-1]
    flat, letter, row = np.where(letter, flat, 0)[keep], letter[keep], row[keep]
    # an edge before and after each row
    at = np.searchsorted(row, np.arange(rows + 1))
    flat = np.insert(flat, at, 0).astype(np.uint64)
    row = np.insert(row, at, np.arange(rows + 1))
    n = max(len(flat) - GRAM + 1, 0)
    total = np.zeros(n, np.uint64)
    inner = np.ones(n, bool)
    for k in range(GRAM):
        part = flat[k : k + n]
        total += (part + np.uint64(1)) * ODD[k]
        if 0 < k < GRAM - 1:
            inner &= part > 0
    return mixed(total)[inner], row[1 : n + 1][inner], has


@dataclass
class Filters:
    """languages, by falling number of training documents; slots, masks over the
    first 64 of them, and further, over each 64 that follow; false_rate, the chance
    that a language answers to an n-gram it lacks."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray
    further: list[np.ndarray] = field(default_factory=list)


def slot_numbers(h: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The slots of n-grams, by double hashing; size is a power of two."""
    step = (h >> np.uint64(32)) | np.uint64(1)
    for k in range(HASHES):
        yield ((h + np.uint64(k) * step) & np.uint64(size - 1)).astype(np.int64)


def filled(languages: list[str], found: list[tuple[int, np.ndarray]]) -> Filters:
    """Filters from (language, n-gram hashes)."""
    most = max([len(h) for _, h in found] or [1])
    size = 1 << int(np.ceil(np.log2(max(SLOTS_PER_GRAM * most, 64))))
    slots = [np.zeros(size, np.uint64) for _ in range(0, max(len(languages), 1), MASK_BITS)]
    for language, h in found:
        for at in slot_numbers(h, size):
            slots[language // MASK_BITS][np.unique(at)] |= np.uint64(1 << language % MASK_BITS)
    full = [
        np.count_nonzero(slots[k // MASK_BITS] >> np.uint64(k % MASK_BITS) & np.uint64(1)) / size
        for k in range(len(languages))
    ]
    return Filters(languages, slots[0], np.array(full) ** HASHES, slots[1:])


def sample(docs: DataFrame, learn: Column, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """lang and text of at most MAX_LABELLED documents of each language, those of the
    smallest CRC-32 of the id."""
    known = docs.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    order = F.crc32(F.col(id_col).cast("string"))
    sizes = known.groupBy(F.col(lang_col).alias("lang")).count()
    # CRC-32 deals documents out evenly: twice as many as needed stay, then the first
    ids = known.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("_id"), order.alias("_order"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("_order", "_id"))
    sizes = F.broadcast(sizes)  # a row per language

    def early(rows: DataFrame) -> DataFrame:
        return rows.join(sizes, "lang").filter(F.col("count") * F.col("_order") <= 2.0 * MAX_LABELLED * 2**32)

    near = early(ids).withColumn("_n", first).filter(F.col("_n") <= MAX_LABELLED)
    near = near.select("lang", "_id").distinct()
    texts = known.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("_id"), order.alias("_order"), text_col)
    # not a semi join: Spark would move it before early, and all texts with it
    return early(texts).join(near, ["lang", "_id"]).select("lang", text_col)


def train(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Filters:
    """Filters of all languages, from the documents with a
    language for which ``learn``, a condition on the id, holds; of the others neither
    text nor language is looked at.

    A language contains an n-gram that two of its documents or more have, at a rate
    of at least a tenth of that in the language where it is most frequent: so strewn
    foreign passages count for nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            done = 0
            for flat, edges in pieces(batch.column(1)):
                h, row, _ = grams(flat, edges)
                order = np.lexsort((row, h))
                h, row = h[order], row[order]
                new = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))[: len(h)]
                h, row = h[new], row[new]
                lang = np.array(names[done : done + len(edges) - 1], object)
                for name in sorted(set(lang.tolist())):
                    values, n = np.unique(h[(lang == name)[row]], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(n), pa.string()), pa.array(values.view(np.int64)), pa.array(n)],
                        ["lang", "gram", "n"],
                    )
                done += len(edges) - 1

    texts = sample(docs, learn, id_col, text_col, lang_col)
    known = docs.filter(learn & F.col(lang_col).isNotNull())
    sizes = known.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col)
    languages = [r[0] for r in sizes.collect()]
    counts = texts.mapInArrow(run, "lang string, gram bigint, n bigint")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_DOCS)
    of_lang = texts.groupBy("lang").agg(F.count("*").alias("docs"))
    rates = counts.join(F.broadcast(of_lang), "lang").withColumn("rate", F.col("n") / F.col("docs"))
    most = F.max("rate").over(Window.partitionBy("gram"))
    good = rates.withColumn("most", most).filter(F.col("rate") >= LEAST_SHARE * F.col("most"))
    # n-grams of a bounded sample of each language
    found = good.groupBy("lang").agg(F.collect_set("gram").alias("grams")).toLocalIterator()
    by_lang = {r["lang"]: np.array(r["grams"], np.int64).view(np.uint64) for r in found}
    return filled(languages, [(k, by_lang[name]) for k, name in enumerate(languages) if name in by_lang])


def detected(docs: DataFrame, filters: Filters, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score.

    Of each language the n-grams it answers to are counted, less those expected of
    its filter by mistake; the language with the most wins, the one with more
    training documents if two are equal.  The score is its part of all languages'
    counts.  Texts that are null or have no letter are ``und`` with score 0, as is
    every text if no language was learnt.  A text with letters that no language
    knows gets the most frequent language and score 0.  Input columns of the added
    names are replaced.  Rows are judged one by one,
    whole; no rows give no rows."""
    docs = without(docs, "lang_pred", "score")
    columns = docs.columns
    place = columns.index(text_col)
    schema = docs.select(
        *[F.col(f"`{c}`") for c in columns], F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")
    ).schema
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            names: list[str] = []
            scores: list[float] = []
            for flat, edges in pieces(batch.column(place)):
                best, score = piece_languages(flat, edges, own)
                names.extend(own.languages[b] if b >= 0 else UNKNOWN for b in best.tolist())
                scores.extend(score.tolist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*columns, "lang_pred", "score"],
            )

    return docs.mapInArrow(run, schema)


def piece_languages(flat: np.ndarray, edges: np.ndarray, filters: Filters) -> tuple[np.ndarray, np.ndarray]:
    """Number of the language (-1: none) and score of each row of a piece."""
    rows = len(edges) - 1
    h, row, has = grams(flat, edges)
    if not filters.languages:
        return np.full(rows, -1), np.zeros(rows)
    numbers = list(slot_numbers(h, len(filters.slots)))
    total = np.bincount(row, minlength=rows)[:rows]
    best, most, whole = np.zeros(rows, np.int64), np.zeros(rows), np.zeros(rows)
    for first, slots in enumerate([filters.slots, *filters.further]):
        mask = np.full(len(h), np.iinfo(np.uint64).max)
        for at in numbers:
            mask &= slots[at]
        some = np.flatnonzero(mask)
        mask, place = mask[some], row[some]
        for k, wrong in enumerate(filters.false_rate[first * MASK_BITS : (first + 1) * MASK_BITS]):
            bit = (mask >> np.uint64(k) & np.uint64(1)).astype(bool)
            n = np.bincount(place[bit], minlength=rows)[:rows]
            count = np.maximum((n - total * wrong) / (1 - wrong), 0.0)
            whole += count
            best = np.where(count > most, first * MASK_BITS + k, best)
            most = np.maximum(most, count)
    score = np.where(whole > 0, most / np.maximum(whole, 1e-12), 0.0)
    return np.where(has, best, -1), np.where(has, np.clip(score, 0.0, 1.0), 0.0)

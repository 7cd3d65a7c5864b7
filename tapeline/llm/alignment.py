"""Alignment of the tokens of two tokenizers over the bytes of each document.

Where a token of either side ends at the same byte, a group ends.  A byte range of a
document yields a fragment: an open prefix (tokens up to its first common end), closed
groups, and an open suffix (tokens behind its last common end).  Two neighbouring
fragments compose to the fragment of both ranges, suffix and prefix closing to a group;
composing is associative, so the ranges of a very long document are read by many tasks
and put together in a tree.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import stored
from tapeline.llm.tokens import SAFE, Tokens, Units, flat, pieces, room, sums

#: Characters of a range; longer texts are read in several ranges.
RANGE_CHARS = 1 << 16
#: Fragments composed by one task in a step of the tree.
FAN_IN = 8
#: Id pairs of the corpus that are looked up at a time: about 20 bytes each.
PAIRS = 1 << 21
#: Units whose links are made at a time.
LINKED = 1 << 16
#: Id pairs a task holds before it hands its counts on.
HELD_PAIRS = 1 << 20
#: How far from the end of a range its last unit may reach before ranges are joined.
FAR_CHARS = 1 << 16

NOWHERE = np.empty(0, np.int64)


# Tokens -----------------------------------------------------------------------


class Sides:
    """Both tokenizers: ids and byte lengths of the tokens of units."""

    def __init__(self, bpe_file: str, piece_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece

        self.tokens_a = Tokens(bpe_file, special=False)
        self.a, self.a_bytes = self.tokens_a.tokenizer, self.tokens_a.bytes
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.blank = self.b.piece_to_id("▁")
        self.radix = self.b.get_piece_size()
        self.lengths = [self.tokens_a.lengths, np.array([len(x) for x in self.b_bytes])]
        self.units = Units(self._encoded, 3)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def _encoded(self, new: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides, and whether both say the bytes of the unit, for each unit."""
        b = self.b.encode(new, num_threads=1)
        sides = [self.tokens_a.ids(new), flat([x if u else [self.blank] for u, x in zip(new, b)])]
        raw = [b" " + u.encode() for u in new]
        ends = np.cumsum([len(r) for r in raw])
        good = np.ones(len(new), np.int32)
        for (ids, n), lengths, words in zip(sides, self.lengths, (self.a_bytes, self.b_bytes)):
            # nearly always all units are said, which is seen at once
            said = b"".join(map(words.__getitem__, ids.tolist()))
            if said != b"".join(raw) or not np.array_equal(np.cumsum(sums(lengths[ids], n)), ends):
                lists = np.split(ids, np.cumsum(n)[:-1])
                good &= np.array([b"".join(words[i] for i in x.tolist()) == r for x, r in zip(lists, raw)], np.int32)
        return [*sides, (good, np.ones(len(new), np.int64))]

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The unit codes of a space and each text, how many each text has, and whether
        both sides say the bytes of the text."""
        codes, n = self.units.of(texts, bare=False)
        return codes, n, sums(1 - self.units.lists[2].gather(codes)[0], n) == 0

    def sides(self, codes: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each side the ids and byte lengths of all tokens of the units, and the
        number of tokens per run of n units."""
        found = []
        for ids, lengths in zip(self.units.lists, self.lengths):
            values, each = ids.gather(codes)
            found.append((values.astype(np.int64), lengths[values], sums(each, n)))
        return found

    def tokens(self, texts: list[str]):
        """``sides`` of a space and each text, and whether both say the bytes of it."""
        if self.units.full():
            self.units.trim()
        codes, n, good = self.of(texts)
        return self.sides(codes, n), good


@cache
def sides_of(files: tuple[str, str]) -> Sides:
    """One for all tasks of a worker."""
    return Sides(*files)


# Groups and links -------------------------------------------------------------


def links(a_ids, a_ends, b_ids, b_ends, radix: int) -> tuple[np.ndarray, np.ndarray]:
    """The id pairs of all tokens that share a byte, and the token of side a of each.
    Both sides cover the same bytes."""
    if not len(a_ends):
        return NOWHERE, NOWHERE
    starts = np.concatenate([[-1], a_ends[:-1]])
    first = np.searchsorted(b_ends, starts, side="right")
    first[0] = 0
    n = np.searchsorted(b_ends, a_ends, side="left") - first + 1
    of = np.repeat(np.arange(len(n)), n)
    b = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return a_ids[of] * radix + b_ids[b], of


def digits(largest: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of all ids up to the largest, left-aligned, and their number."""
    text = np.arange(largest + 1).astype("S")
    width = text.dtype.itemsize
    cells = np.zeros((len(text), width + 1), np.uint8)
    cells[:, :width] = text.view(np.uint8).reshape(-1, width)
    return cells, np.char.str_len(text)


def written(a_ids, a_group, b_ids, b_group, table) -> tuple[bytes, np.ndarray]:
    """All groups in the form ``a1,a2|b1;``, and for each token of side b the place behind
    it.  A group number is that of the group the token lies in, from 0."""
    a_at = np.arange(len(a_ids)) + np.searchsorted(b_group, a_group, side="left")
    b_at = np.arange(len(b_ids)) + np.searchsorted(a_group, b_group, side="right")
    ids = np.empty(len(a_ids) + len(b_ids), np.int64)
    ids[a_at], ids[b_at] = a_ids, b_ids
    after = np.full(len(ids), ord(","), np.uint8)
    after[a_at[np.append(np.diff(a_group) > 0, True)]] = ord("|")
    after[b_at[np.append(np.diff(b_group) > 0, True)]] = ord(";")
    cells, n = table
    rows, n = cells[ids], n[ids]
    rows[np.arange(len(ids)), n] = after
    text = rows[np.arange(rows.shape[1]) <= n[:, None]].tobytes()
    return text, np.cumsum(n + 1)[b_at]


@dataclass
class Open:
    """Tokens of a group that is not closed: ids and ends of both sides."""

    a: np.ndarray = field(default_factory=lambda: NOWHERE)
    a_ends: np.ndarray = field(default_factory=lambda: NOWHERE)
    b: np.ndarray = field(default_factory=lambda: NOWHERE)
    b_ends: np.ndarray = field(default_factory=lambda: NOWHERE)

    def __add__(self, other: Open) -> Open:
        return Open(*[np.concatenate([getattr(self, k), getattr(other, k)]) for k in OPEN])


OPEN = ["a", "a_ends", "b", "b_ends"]


@dataclass
class Fragment:
    """What a byte range says about the alignment.  Without a common end in it the range
    is all prefix.  ``text`` holds the closed groups, each with a semicolon behind it;
    ``pairs`` and ``counts`` the id pairs of their links."""

    good: bool = True
    closes: bool = False
    prefix: Open = field(default_factory=Open)
    suffix: Open = field(default_factory=Open)
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    text: bytes = b""
    pairs: np.ndarray = field(default_factory=lambda: NOWHERE)
    counts: np.ndarray = field(default_factory=lambda: NOWHERE)


def closed(part: Open, radix: int) -> Fragment:
    """A group of its own."""
    pairs, counts = np.unique(links(part.a, part.a_ends, part.b, part.b_ends, radix)[0], return_counts=True)
    text = ",".join(map(str, part.a.tolist())) + "|" + ",".join(map(str, part.b.tolist())) + ";"
    return Fragment(n_groups=1, text=text.encode(), pairs=pairs, counts=counts)


def merged(parts: list[Fragment]) -> tuple[np.ndarray, np.ndarray]:
    """The id pairs of all parts with their counts."""
    pairs, place = np.unique(np.concatenate([p.pairs for p in parts]), return_inverse=True)
    counts = np.zeros(len(pairs), np.int64)
    np.add.at(counts, place, np.concatenate([p.counts for p in parts]))
    return pairs, counts


def composed(x: Fragment, y: Fragment, radix: int) -> Fragment:
    """The fragment of the range of x and the range of y behind it."""
    both = {"good": x.good and y.good, "n_a": x.n_a + y.n_a, "n_b": x.n_b + y.n_b}
    if not y.closes:
        if not x.closes:
            return replace(x, prefix=x.prefix + y.prefix, **both)
        return replace(x, suffix=x.suffix + y.prefix, **both)
    if not x.closes:
        return replace(y, prefix=x.prefix + y.prefix, **both)
    middle = closed(x.suffix + y.prefix, radix)
    pairs, counts = merged([x, middle, y])
    return Fragment(
        closes=True, prefix=x.prefix, suffix=y.suffix, n_groups=x.n_groups + 1 + y.n_groups,
        text=x.text + middle.text + y.text, pairs=pairs, counts=counts, **both,
    )


def fragment(a_ids, a_ends, b_ids, b_ends, radix: int, table) -> Fragment:
    """The fragment of the tokens that end in a range; ends count from the document's
    first byte."""
    common = a_ends[np.isin(a_ends, b_ends, assume_unique=True)]
    n = {"n_a": len(a_ids), "n_b": len(b_ids)}
    if not len(common):
        return Fragment(prefix=Open(a_ids, a_ends, b_ids, b_ends), **n)

    def between(low: int, high: int) -> Open:
        sides = []
        for ids, ends in ((a_ids, a_ends), (b_ids, b_ends)):
            some = slice(*np.searchsorted(ends, [low, high], side="right"))
            sides += [ids[some], ends[some]]
        return Open(*sides)

    inner = between(common[0], common[-1])
    text, pairs, counts = b"", NOWHERE, NOWHERE
    if len(common) > 1:
        a_group, b_group = (np.searchsorted(common[1:], e, side="left") for e in (inner.a_ends, inner.b_ends))
        text = written(inner.a, a_group, inner.b, b_group, table)[0]
        found = links(inner.a, inner.a_ends, inner.b, inner.b_ends, radix)[0]
        pairs, counts = np.unique(found, return_counts=True)
    return Fragment(
        closes=True, prefix=between(-1, common[0]), suffix=between(common[-1], np.iinfo(np.int64).max),
        n_groups=len(common) - 1, text=text, pairs=pairs, counts=counts, **n,
    )


def finished(whole: Fragment, radix: int) -> Fragment:
    """The fragment of a whole document with its first group closed: nothing lies before
    it, and both sides end with the document."""
    if not whole.good or not whole.closes:
        return Fragment(good=False)
    first = closed(whole.prefix, radix)
    pairs, counts = merged([first, whole])
    return replace(
        whole, prefix=Open(), n_groups=whole.n_groups + 1, text=first.text + whole.text, pairs=pairs, counts=counts
    )


# Short documents: a batch at a time --------------------------------------------


@dataclass
class Aligned:
    """Whole documents: figures of each, and the links of all with their document."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    digest: list[str]
    pairs: np.ndarray
    of: np.ndarray


def aligned(sides: Sides, texts: list[str], table, digests: bool) -> Aligned:
    """The alignment of texts that are one range each: their bytes lie one behind the
    other, and the end of each is a common end."""
    (a, b), good = sides.tokens(texts)
    good &= np.array([bool(t) for t in texts], bool)
    kept = []
    for ids, lengths, n in (a, b):
        some = np.repeat(good, n)
        kept.append((ids[some], np.cumsum(lengths[some]), np.where(good, n, 0)))
    (a_ids, a_ends, n_a), (b_ids, b_ends, n_b) = kept
    doc_of_a = np.repeat(np.arange(len(texts)), n_a)
    is_common = np.isin(a_ends, b_ends, assume_unique=True)
    n_groups = np.bincount(doc_of_a[is_common], minlength=len(texts))
    pairs, of = links(a_ids, a_ends, b_ids, b_ends, sides.radix)
    digest = [""] * len(texts)
    if digests and len(a_ids):
        common = a_ends[is_common]
        a_group, b_group = (np.searchsorted(common, e, side="left") for e in (a_ends, b_ends))
        text, behind = written(a_ids, a_group, b_ids, b_group, table)
        at, last = 0, np.cumsum(n_b)
        for i in np.flatnonzero(good).tolist():
            stop = int(behind[last[i] - 1])
            digest[i] = hashlib.sha256(text[at : stop - 1]).hexdigest()
            at = stop
    return Aligned(n_a, n_b, n_groups, digest, pairs, doc_of_a[of])


# Long documents: ranges over tasks ---------------------------------------------

RANGES = "row bigint, doc_id bigint, range_no int, base bigint, low bigint, high bigint, text string"
#: Where the text at a place may be cut: a space behind a non-blank.
PLACES = re.compile(SAFE.pattern)


def cut_before(text: str, at: int) -> int | None:
    """The last place up to ``at`` where no token reaches across, or None if far away."""
    far = max(0, at - FAR_CHARS)
    found = [m.start() for m in PLACES.finditer(text, far, at + 1) if m.start() > far]
    return found[-1] if found else (0 if far == 0 else None)


def cut_behind(text: str, at: int) -> int | None:
    found = PLACES.search(text, at, at + FAR_CHARS)
    return found.start() if found else (len(text) if at + FAR_CHARS >= len(text) else None)


def ranges(text: str, size: int) -> Iterator[tuple[int, int, int, str]]:
    """A space and a long text in byte ranges of ``size`` characters: for each the bytes before its stretch of
    text, the first byte and the end of the range, and the stretch, which reaches over
    the range to the next places where no token crosses.  A range whose edge has no such
    place nearby is joined with its neighbour."""
    whole = " " + text
    edges: list[tuple[int, int, int]] = []
    for at in range(size, len(whole) - 1, size):
        before, behind = cut_before(whole, at), cut_behind(whole, at)
        if before is not None and behind is not None:
            edges.append((before, at, behind))
    edges = [(0, 0, 0), *edges, (len(whole), len(whole), len(whole))]
    low_byte = 0
    for (before, low, _), (_, high, behind) in zip(edges, edges[1:]):
        base = low_byte - len(whole[before:low].encode())
        after = low_byte + len(whole[low:high].encode())
        yield base, low_byte, after, whole[before:behind]
        low_byte = after


def range_fragment(sides: Sides, row: dict, table) -> Fragment:
    """The fragment of one range: the tokens of its stretch that end in the range."""
    (a, b), good = sides.tokens([row["text"][1:]])
    found = []
    for ids, lengths, _ in (a, b):
        ends = row["base"] + np.cumsum(lengths)
        some = (ends > row["low"]) & (ends <= row["high"])
        found += [ids[some], ends[some]]
    if not good[0]:
        return Fragment(good=False)
    return fragment(*found, sides.radix, table)


PACKED = (
    "good boolean, closes boolean, n_a bigint, n_b bigint, n_groups bigint, text binary, pairs binary, counts binary, "
    + ", ".join(f"{end}_{k} binary" for end in ("prefix", "suffix") for k in OPEN)
)
FRAGMENTS = f"row bigint, doc_id bigint, range_no int, {PACKED}"
KEYS = ["row", "doc_id"]


def packed(f: Fragment) -> dict:
    out = {k: getattr(f, k) for k in ("good", "closes", "n_a", "n_b", "n_groups", "text")}
    out |= {k: getattr(f, k).astype(np.int64).tobytes() for k in ("pairs", "counts")}
    for end in ("prefix", "suffix"):
        out |= {f"{end}_{k}": getattr(getattr(f, end), k).astype(np.int64).tobytes() for k in OPEN}
    return out


def unpacked(row: dict) -> Fragment:
    numbers = lambda k: np.frombuffer(row[k], np.int64)
    ends = {end: Open(*[numbers(f"{end}_{k}") for k in OPEN]) for end in ("prefix", "suffix")}
    plain = {k: row[k] for k in ("good", "closes", "n_a", "n_b", "n_groups", "text")}
    return Fragment(**plain, **ends, pairs=numbers("pairs"), counts=numbers("counts"))


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def long_documents(rows: DataFrame, files: tuple[str, str], radix: int) -> DataFrame:
    """The whole fragment of each long text (row, doc_id, text), finished: KEYS and PACKED.

    Ranges are dealt over all tasks; fragments of neighbouring ranges are composed FAN_IN
    at a time until each document has one."""
    schema, range_schema, size = arrow_schema(FRAGMENTS), arrow_schema(RANGES), RANGE_CHARS

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            for i, (base, low, high, text) in enumerate(ranges(row["text"], size)):
                one = {k: row[k] for k in KEYS} | {"range_no": i, "base": base, "low": low, "high": high, "text": text}
                yield pa.RecordBatch.from_pylist([one], range_schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, table = sides_of(files), None
        for row in (r for batch in batches for r in batch.to_pylist()):
            table = table or digits(max(max(sides.a_bytes), sides.radix))
            one = {k: row[k] for k in [*KEYS, "range_no"]} | packed(range_fragment(sides, row, table))
            yield pa.RecordBatch.from_pylist([one], schema)

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for row in (r for batch in batches for r in batch.to_pylist()):
            at = {k: row[k] for k in KEYS} | {"range_no": row["range_no"] // FAN_IN}
            if at != key and held is not None:
                yield pa.RecordBatch.from_pylist([key | packed(held)], schema)
                held = None
            held = unpacked(row) if held is None else composed(held, unpacked(row), radix)
            key = at
        if held is not None:
            yield pa.RecordBatch.from_pylist([key | packed(held)], schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            one = {k: row[k] for k in KEYS} | {"range_no": 0} | packed(finished(unpacked(row), radix))
            yield pa.RecordBatch.from_pylist([one], schema)

    parts = rows.mapInArrow(dealt, RANGES).repartition("row", "range_no").mapInArrow(read, FRAGMENTS)
    parts = stored(parts, "fragments")
    most = parts.agg(F.max("range_no")).first()[0] or 0
    while most > 0:
        block = F.floor(F.col("range_no") / FAN_IN)
        parts = parts.repartition("row", block).sortWithinPartitions("row", "range_no").mapInArrow(compose, FRAGMENTS)
        most //= FAN_IN
    return stored(parts.mapInArrow(finish, FRAGMENTS).drop("range_no"), "long-documents")


# Counts of the corpus ---------------------------------------------------------


class Held:
    """Counts of id pairs in a task; handed on when they are many."""

    def __init__(self):
        self.pairs, self.counts, self.waiting, self.n = NOWHERE, NOWHERE, [], 0

    def add(self, pairs: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((pairs, counts))
        self.n += len(pairs)
        if self.n > HELD_PAIRS:
            self.settle()

    def settle(self) -> None:
        parts = [Fragment(pairs=p, counts=c) for p, c in ((self.pairs, self.counts), *self.waiting)]
        self.pairs, self.counts = merged(parts)
        self.waiting, self.n = [], 0

    def batch(self) -> pa.RecordBatch:
        self.settle()
        out = pa.RecordBatch.from_arrays([pa.array(self.pairs), pa.array(self.counts)], ["pair", "n"])
        self.pairs, self.counts = NOWHERE, NOWHERE
        return out


def counted(batches: Iterator[pa.RecordBatch], found) -> Iterator[pa.RecordBatch]:
    """Counts of the id pairs that ``found`` says of each batch, and of None at the end."""
    held = Held()
    for batch in chain(batches, [None]):
        for pairs, counts in found(batch):
            held.add(pairs, counts)
        if len(held.pairs) > HELD_PAIRS:
            yield held.batch()
    yield held.batch()


def pair_counts(short: DataFrame, long: DataFrame, files: tuple[str, str], radix: int) -> DataFrame:
    """pair, n and best (whether n is the highest of its id of side b) over the corpus."""

    def of_short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, seen = sides_of(files), np.zeros(1024, np.int64)

        def settled():
            """The pairs of all units seen: a unit's tokens end with it on both sides, so
            the links of a text are those of its units."""
            used = np.flatnonzero(seen)
            for codes in np.split(used, range(LINKED, len(used), LINKED)):
                (a, la, n_a), (b, lb, _) = sides.sides(codes, np.ones(len(codes), np.int64))
                pairs, of = links(a, np.cumsum(la), b, np.cumsum(lb), sides.radix)
                yield pairs, np.repeat(seen[codes], n_a)[of]
            seen[:] = 0

        def found(batch: pa.RecordBatch | None):
            nonlocal seen
            if batch is None:
                yield from settled()
                return
            texts = batch.column("text").to_pylist()
            for piece in pieces(texts):
                if sides.units.full():
                    yield from settled()
                    sides.units.trim()
                codes, n, good = sides.of(texts[piece])
                good &= np.array([bool(t) for t in texts[piece]], bool)
                seen = room(seen, len(sides.units.codes))
                seen += np.bincount(codes[np.repeat(good, n)], minlength=len(seen))

        yield from counted(batches, found)

    def of_long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(batch: pa.RecordBatch | None):
            for row in batch.to_pylist() if batch else []:
                yield np.frombuffer(row["pairs"], np.int64), np.frombuffer(row["counts"], np.int64)

        yield from counted(batches, found)

    parts = short.select("text").mapInArrow(of_short, "pair bigint, n bigint")
    parts = parts.unionByName(long.select("pairs", "counts").mapInArrow(of_long, "pair bigint, n bigint"))
    counts = stored(parts.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = (F.col("pair") % radix).alias("b")
    # a row per id of side b
    best = counts.groupBy(b).agg(F.max("n").alias("most"))
    return counts.withColumn("b", b).join(best, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def blocks_of(counts: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The pairs in order, PAIRS at a time at most: pairs, their counts, best or not."""
    counts = stored(counts, "best-pairs")
    n = counts.count()
    parts = max(1, -(-n // PAIRS) * 2) if n > PAIRS else 1
    for k in range(parts):
        some = counts if parts == 1 else counts.filter(F.pmod(F.xxhash64("pair"), F.lit(parts)) == k)
        table = some.toArrow().sort_by("pair").combine_chunks()
        yield tuple(table.column(c).to_numpy() for c in ("pair", "n", "best"))


FOUND = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


class Lookup:
    """Counts of the pairs of one block; other pairs count nothing."""

    def __init__(self, block):
        self.pairs, self.counts, self.best = block

    def __call__(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.pairs):
            return np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        here = self.pairs[at] == pairs
        return np.where(here, self.counts[at], 0), here & self.best[at]


def scores(short: DataFrame, long: DataFrame, files: tuple[str, str], block, first: bool) -> DataFrame:
    """The rows of all documents with the links of one block of pairs; the other figures
    come with the first block."""
    shared = short.sparkSession.sparkContext.broadcast(block)

    def of_short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, look = sides_of(files), Lookup(shared.value)
        table = digits(max(max(sides.a_bytes), sides.radix))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for piece in pieces(texts):
                found = aligned(sides, texts[piece], table, first)
                counts, best = look(found.pairs)
                size = len(found.n_a)
                n_links = np.bincount(found.of, minlength=size)
                keys = batch.slice(piece.start, piece.stop - piece.start)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.column("row"), keys.column("doc_id"),
                        *[pa.array(x * first) for x in (found.n_a, found.n_b, found.n_groups)],
                        pa.array(n_links * first),
                        pa.array(sums(best, n_links)), pa.array(sums(counts, n_links)), pa.array(found.digest),
                    ],
                    schema=arrow_schema(FOUND),
                )

    def of_long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(shared.value)
        for row in (r for batch in batches for r in batch.to_pylist()):
            f = unpacked(row)
            counts, best = look(f.pairs)
            one = {
                "row": row["row"], "doc_id": row["doc_id"],
                "n_a": f.n_a * first, "n_b": f.n_b * first, "n_groups": f.n_groups * first,
                "n_links": int(f.counts.sum()) * first,
                "n_best": int(f.counts[best].sum()), "count_sum": int((f.counts * counts).sum()),
                "groups_sha256": hashlib.sha256(f.text[:-1]).hexdigest() if first and f.text else "",
            }
            yield pa.RecordBatch.from_pylist([one], arrow_schema(FOUND))

    return short.mapInArrow(of_short, FOUND).unionByName(long.mapInArrow(of_long, FOUND))


def alignments(docs: DataFrame, bpe_file: str, piece_file: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each of
    docs (doc_id, text).

    Side a is the byte-level BPE in ``bpe_file`` over a space and the text, side b the
    piece model in ``piece_file``, which adds the space itself.  Texts that are null or
    empty, or whose tokens do not say their bytes (a text with U+2581), have no tokens and
    zeros.  Rows that repeat are documents of their own; other columns are ignored; no
    rows give no rows.

    Texts up to RANGE_CHARS are one range; the others are cut into ranges.  Neither texts
    nor links are shuffled for short documents: one pass counts id pairs, with one row
    per pair and task handed on, another one looks them up.  Should the corpus hold more
    than PAIRS pairs, they are looked up in several passes.
    """
    import sentencepiece

    files = (bpe_file, piece_file)
    radix = sentencepiece.SentencePieceProcessor(model_file=piece_file).get_piece_size()
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    is_long = F.length("text") > RANGE_CHARS
    short = rows.filter(~is_long)
    # several jobs name long texts, so they and their numbers are kept
    long = stored(rows.filter(is_long).withColumn("row", -1 - F.col("row")), "long-texts")
    long = long_documents(long, files, radix)
    counts = pair_counts(short, long, files, radix)
    parts = [scores(short, long, files, block, k == 0) for k, block in enumerate(blocks_of(counts))]
    if len(parts) == 1:
        return parts[0].drop("row")
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    totals = [F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return out.groupBy("row", "doc_id").agg(*totals, F.max("groups_sha256").alias("groups_sha256")).drop("row")

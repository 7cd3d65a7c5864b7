"""Hashes of the words and five-word shingles of whole columns of texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

SHINGLE_WORDS = 5
CHUNK_BYTES = 1 << 20  # of text that is hashed at a time, some 80 MB of arrays; a longer text is one chunk

# A byte counts as a random number times a power of an odd one, by its place.
ODD = 0x9E3779B97F4A7C15
INVERSE = pow(ODD, -1, 1 << 64)
BYTE = np.frombuffer(hashlib.shake_128(b"bytes").digest(256 * 8), dtype=np.uint64).copy()
PLACE = np.frombuffer(hashlib.shake_128(b"places").digest(64), dtype=np.uint64) | np.uint64(1)
IS_WORD = np.array([not (c == 32 or 9 <= c <= 13) for c in range(256)])
for upper in range(ord("A"), ord("Z") + 1):
    BYTE[upper] = BYTE[upper + 32]


class Powers:
    """ODD and its inverse to the powers 0, 1, 2, ..., as far as asked for so far."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            for name, base in (("up", ODD), ("down", INVERSE)):
                steps = np.full(-(-n // CHUNK_BYTES) * CHUNK_BYTES, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))
        return cls.up[:n], cls.down[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads differences over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def chunks(
    texts: pa.Array, size: int = CHUNK_BYTES
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and row edges of pieces of a column; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = int(np.searchsorted(edges, edges[i] + size, side="right")) - 1
        j = min(max(j, i + 1), len(texts))
        yield i, data[edges[i] : edges[j]], edges[i : j + 1] - edges[i]
        i = j


def words_at(
    data: np.ndarray,
    edges: np.ndarray,
    is_word: np.ndarray = IS_WORD,
    prefixes: Sequence[int] = (),
) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a piece, A-Z in lower case, and where they
    start.  ``is_word`` tells which bytes words are made of; no word reaches from a
    row into the next.  After the words come, for each length asked for, the first
    so many bytes of the words that are longer."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = np.zeros(n + 2, bool)
    word[1:-1] = is_word[data]
    first = np.zeros(n + 1, bool)
    first[edges] = True  # of a row
    starts = np.flatnonzero(word[1:-1] & (~word[:-2] | first[:-1]))
    ends = np.flatnonzero(word[1:-1] & (~word[2:] | first[1:])) + 1
    up, down = Powers.to(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE[data] * up[:n], out=total[1:])
    hashes, places = [mixed((total[ends] - total[starts]) * down[starts])], [starts]
    for length in prefixes:
        long = starts[ends - starts > length]
        start = (total[long + length] - total[long]) * down[long]
        hashes.append(mixed(start ^ np.uint64(length)))
        places.append(long)
    return np.concatenate(hashes), np.concatenate(places)


def word_hashes(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words between blanks, and how many words each row has."""
    h, starts = words_at(data, edges)
    return h, np.diff(np.searchsorted(starts, edges))


class Lookup:
    """The place of hashes in a fixed sorted list; -1 for others.  A bit map over
    the high bits spares most searches."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(hashes >> np.uint64(44)).astype(np.int64)] = True

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are in the list, and where."""
        if not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        maybe = np.flatnonzero(self.bits[(hashes >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        good = self.hashes[at] == hashes[maybe]
        return maybe[good], at[good]


def shingle_sets(words: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its shingles: five words in a row,
    or all words of a row that has fewer; none without words."""
    k = SHINGLE_WORDS
    run = np.zeros(max(len(words) - k + 1, 0), np.uint64)
    for i in range(k):
        run += words[i : i + len(run)] * PLACE[i]
    run = mixed(run)
    at = 0
    for n in counts.tolist():
        if n >= k:
            grams = np.sort(run[at : at + n - k + 1])
            yield grams[np.append(True, grams[1:] != grams[:-1])]
        elif n:
            short = (words[at : at + n] * PLACE[:n]).sum(dtype=np.uint64) + np.uint64(n)
            yield mixed(np.array([short], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
        at += n


def sets_of(texts: pa.Array) -> Iterator[np.ndarray]:
    """The shingle set of each text of a column."""
    for _, data, edges in chunks(texts):
        yield from shingle_sets(*word_hashes(data, edges))


def set_key(grams: np.ndarray) -> bytes | None:
    """96 bits that name a set; None for the empty one."""
    return hashlib.blake2b(grams.tobytes(), digest_size=12).digest() if len(grams) else None

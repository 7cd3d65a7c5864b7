"""Tokens of texts by way of their units, each of which is encoded once.

A unit is a stretch of text between two places that no token reaches across: before a
space that follows a non-blank or that a non-blank follows.  Byte-level BPE with the usual
pre-tokenizer and piece models without pieces of a non-blank and a space cut there, so
the tokens of a text are those of its units, one after the other.  Words repeat, so a
worker meets few new ones; when its memory of units is full it forgets those of little use.
New units of common letters, digits and marks are taken apart where the pre-tokenizer cuts
too, as their parts repeat more often.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units a worker remembers.
UNITS = 1 << 19
#: Characters of texts that are handled at a time, and at least one text.
PIECE_CHARS = 1 << 19

SAFE = re.compile(r"(?<=\S)(?= )")
RISKY = re.compile(r" (?<=\s )\s")
#: Units of these characters only, line feeds inside, are cut as byte-level pre-tokenizers
#: do it, whose classes of letters, digits and other marks are written out here for them.
SIMPLE = re.compile(r"[!-~À-ÖØ-öø-ɏ]+(?:\n+[!-~À-ÖØ-öø-ɏ]+)*")
PARTS = re.compile(
    r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-zÀ-ÖØ-öø-ɏ]+| ?[0-9]+| ?[!-/:-@\[-`{-~]+|\s+(?!\S)|\s+"
)
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def is_odd(text: str, bare: bool) -> bool:
    """Whether units may begin elsewhere than at every space of the text."""
    whole = text if bare else " " + text
    return "  " in whole or whole.endswith(" ") or RISKY.search(whole) is not None


def units(text: str, bare: bool) -> list:
    """The units of a text, or with ``bare=False`` of a space and the text.

    A string stands for a space and itself, a tuple for the string in it."""
    if is_odd(text, bare):
        found = SAFE.split(text if bare else " " + text)
        return [(found[0],) if bare else found[0][1:], *[u[1:] for u in found[1:]]]
    found = text.split(" ")
    if bare:
        found[0] = (found[0],)
    return found


def distinct(texts: list[str], bare: bool) -> tuple[list, np.ndarray, np.ndarray]:
    """The ``units`` of some texts, repeated ones mostly once, where in this list each
    unit of the texts stands, and how many each text has."""
    odd = np.fromiter((is_odd(t, bare) for t in texts), bool, len(texts))
    found = [units(t, bare) for t, o in zip(texts, odd) if o]
    even = [t for t, o in zip(texts, odd) if not o] if found else texts
    n = np.empty(len(texts), np.int64)
    n[odd] = [len(f) for f in found]
    first = [t.partition(" ") for t in even] if bare else []
    rest = pa.array([r if space else None for _, space, r in first] if bare else even, pa.large_string())
    lists = pc.split_pattern(rest, " ")
    coded = lists.values.dictionary_encode()
    names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # far quicker than to_pylist
    ends = lists.offsets.to_numpy()
    places = coded.indices.to_numpy().astype(np.int64)
    n[~odd] = np.diff(ends) + bare
    if bare:
        places = np.insert(places, ends[:-1], len(names) + np.arange(len(first)))
        names += [(f,) for f, _, _ in first]
    if found:
        is_own = np.repeat(odd, n)
        both = np.empty(len(is_own), np.int64)
        both[~is_own] = places
        both[is_own] = len(names) + np.arange(len(is_own) - len(places))
        places = both
        names += chain.from_iterable(found)
    return names, places, n


class Codes(dict):
    """Numbers of units in the order of their first sight; ``new`` are those seen since
    it was last emptied."""

    def __init__(self, known: Iterable = ()):
        super().__init__((unit, code) for code, unit in enumerate(known))
        self.new: list = []

    def __missing__(self, unit) -> int:
        code = self[unit] = len(self)
        self.new.append(unit)
        return code


class Lists:
    """Lists of whole numbers, one behind the other, gathered by their places."""

    def __init__(self):
        self.flat, self.at, self.n = np.empty(1024, np.int32), np.zeros(1024, np.int64), 0

    def append(self, values: np.ndarray, n: np.ndarray) -> None:
        first, last = int(self.at[self.n]), self.n + len(n)
        self.flat, self.at = room(self.flat, first + len(values)), room(self.at, last + 1)
        self.flat[first : first + len(values)] = values
        self.at[self.n + 1 : last + 1] = first + np.cumsum(n)
        self.n = last

    def gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of the codes as one array, and the length of each."""
        first = self.at[codes]
        n = self.at[codes + 1] - first
        place = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return self.flat[place], n


def flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    """Lists as one array, and the length of each."""
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, int(n.sum())), n


def room(array: np.ndarray, size: int) -> np.ndarray:
    """The array, in twice the space where it would not hold so many values."""
    if size <= len(array):
        return array
    more = np.zeros(max(size, 2 * len(array)), array.dtype)
    more[: len(array)] = array
    return more


class Units:
    """The units a worker has met, each with some lists of numbers; ``encode`` makes them,
    each kind as one array with the length of each list."""

    def __init__(self, encode: Callable[[list], list[tuple[np.ndarray, np.ndarray]]], lists: int):
        self.encode, self.codes = encode, Codes()
        self.lists = [Lists() for _ in range(lists)]
        self.uses = np.zeros(1024, np.int64)

    def full(self) -> bool:
        return len(self.codes) > UNITS

    def trim(self) -> None:
        """Forgets units used once lately, and of the others the least used half if they
        are too many.  Codes change."""
        uses = self.uses[: len(self.codes)]
        kept = np.flatnonzero(uses > 1)
        if len(kept) > UNITS // 2:
            kept = np.sort(np.argsort(-uses, kind="stable")[: UNITS // 2])
        names = list(self.codes)
        self.codes = Codes(names[i] for i in kept.tolist())
        self.uses = np.concatenate([uses[kept] // 2, np.zeros(1024, np.int64)])
        for i, old in enumerate(self.lists):
            self.lists[i] = Lists()
            self.lists[i].append(*old.gather(kept))

    def of(self, texts: list[str], bare: bool) -> tuple[np.ndarray, np.ndarray]:
        """The codes of all units of the texts, and how many each text has."""
        found, places, n = distinct(texts, bare)
        codes = np.fromiter(map(self.codes.__getitem__, found), np.int64, len(found))[places]
        if self.codes.new:
            new, self.codes.new = self.codes.new, []
            for lists, more in zip(self.lists, self.encode(new)):
                lists.append(*more)
        self.uses = room(self.uses, len(self.codes))
        self.uses[: len(self.codes)] += np.bincount(codes, minlength=len(self.codes))
        return codes, n


def sums(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of n values."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(n)
    return total[ends] - total[ends - n]


def pieces(texts: list[str]) -> Iterator[slice]:
    """Runs of texts of at most PIECE_CHARS characters, or of one text."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > PIECE_CHARS:
            yield slice(start, i)
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level tokenizers write bytes: printable ones stand for
    themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokens:
    """Ids of texts by a byte-level tokenizer of the ``tokenizers`` library, without added
    tokens; with ``special`` the strings of special tokens in a text stand for these."""

    def __init__(self, file: str, special: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = not special
        letters = byte_letters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes = {i: bytes(letters[c] for c in token) for token, i in vocabulary.items()}
        for i, token in self.tokenizer.get_added_tokens_decoder().items():
            self.bytes[i] = token.content.encode()
        self.lengths = np.zeros(max(self.bytes) + 1, np.int64)
        self.lengths[list(self.bytes)] = [len(x) for x in self.bytes.values()]
        self.units = Units(lambda new: [self.ids(new)], 1)
        self.parts, self.part_ids = Codes(), Lists()
        how = json.loads(self.tokenizer.to_str())
        self.cuts = how["normalizer"] is None and (how["pre_tokenizer"] or {}).items() >= BYTE_LEVEL.items()
        added = [t["content"] for t in how["added_tokens"]]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.cuts &= not any(map(str.isspace, "".join(added)))

    def ids(self, new: list) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units: by their parts, or of those without blanks as one text, as
        their edges are places no token reaches across, or one by one."""
        simple = [i for i, u in enumerate(new) if isinstance(u, str) and SIMPLE.fullmatch(u)] if self.cuts else []
        if self.added.search(" ".join([new[i] for i in simple])):
            simple = [i for i in simple if not self.added.search(new[i])]
        left = np.ones(len(new), bool)
        left[simple] = False
        plain, odd = [], []
        for i in np.flatnonzero(left).tolist():
            u = new[i]
            (plain if isinstance(u, str) and u.split() == [u] else odd).append(i)
        lists = Lists()
        lists.append(*self.by_parts([new[i] for i in simple]))
        lists.append(*self.joined([" " + new[i] for i in plain]))
        alone = [new[i][0] if isinstance(new[i], tuple) else " " + new[i] for i in odd]
        lists.append(*flat([e.ids for e in self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)]))
        order = np.empty(len(new), np.int64)
        order[np.array(simple + plain + odd, np.int64)] = np.arange(len(new))
        return lists.gather(order)

    def joined(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of strings that no token reaches across, encoded as one text and told
        apart by their bytes."""
        if not strings:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        text = "".join(strings)
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        ids = np.fromiter(ids, np.int32, len(ids))
        ends = np.cumsum(np.fromiter(map(len, strings), np.int64, len(strings)))
        if not text.isascii():  # from characters to bytes
            raw = np.frombuffer(text.encode(), np.uint8)
            ends = np.append(np.flatnonzero(raw & 0xC0 != 0x80), len(raw))[ends]
        last = np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1
        return ids, np.diff(last, prepend=0)

    def by_parts(self, simple: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units of SIMPLE characters, gathered from those of their parts."""
        if len(self.parts) > UNITS:
            self.parts, self.part_ids = Codes(), Lists()
        found = PARTS.findall("".join([" " + u for u in simple]))
        codes = np.fromiter(map(self.parts.__getitem__, found), np.int64, len(found))
        if self.parts.new:
            new, self.parts.new = self.parts.new, []
            spaced, tight, blank = [], [], []
            for i, p in enumerate(new):
                (blank if p.isspace() else spaced if p[0] == " " else tight).append(i)
            lists = Lists()
            # the space in front of a part keeps it from the one before
            lists.append(*self.joined([new[i] for i in spaced]))
            # a line feed behind a part is one by itself; blanks would join with it
            fed = Lists()
            fed.append(*self.joined([s for i in tight for s in (new[i], "\n")]))
            lists.append(*fed.gather(np.arange(0, fed.n, 2)))
            alone = self.tokenizer.encode_batch_fast([new[i] for i in blank], add_special_tokens=False)
            lists.append(*flat([e.ids for e in alone]))
            order = np.empty(len(new), np.int64)
            order[np.array(spaced + tight + blank, np.int64)] = np.arange(len(new))
            self.part_ids.append(*lists.gather(order))
        ids, each = self.part_ids.gather(codes)
        ends = np.cumsum(np.fromiter(map(len, simple), np.int64, len(simple)) + 1)
        last = np.searchsorted(np.cumsum(np.fromiter(map(len, found), np.int64, len(found))), ends) + 1
        return ids, sums(each, np.diff(last, prepend=0))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts as one array, and how many each text has."""
        if self.units.full():
            self.units.trim()
        codes, n = self.units.of(texts, bare=True)
        ids, each = self.units.lists[0].gather(codes)
        return ids, sums(each, n)


@cache
def tokens_of(file: str, special: bool = True) -> Tokens:
    """One for all tasks of a worker."""
    return Tokens(file, special)

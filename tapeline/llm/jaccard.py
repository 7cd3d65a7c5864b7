"""Documents linked by the Jaccard similarity of their five-word shingles.

The overlaps are entries of the product of the document by n-gram incidence matrix
with its transpose.  The matrix is built in blocks of columns (n-grams).  A first
pass over the blocks finds which entries any product can meet at all; size bounds
then leave a few rows, and of their products only those that the bounds allow and
that could join what is not joined yet are added up.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.llm.common import cut, stored
from tapeline.llm.graph import smallest_reachable
from tapeline.llm.shingles import set_key, sets_of

PERCENT = 75  # least share of the common n-grams in all n-grams of a pair
FLUSH = 500_000  # entries that a task gathers before it sends them to the blocks
BLOCK_ENTRIES = 2_000_000  # entries of a block of columns, some 150 MB while it is read
PIVOTS = 4  # sets of a column that the others are held against in a round
ROUNDS = 2
SIGNATURE = 8  # words of 64 bits
BITS = [f"bits_{k}" for k in range(SIGNATURE)]


def linked(overlap: str | Column, a: str = "a_n", b: str = "b_n") -> Column:
    """Whether sets of these sizes with this overlap are similar enough.  With the
    most that an overlap could be, this is the bound that discards pairs."""
    overlap = F.col(overlap) if isinstance(overlap, str) else overlap
    return 100 * overlap >= PERCENT * (F.col(a) + F.col(b) - overlap)


def sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n_shingles and key (of the set) of each document."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [(len(g), set_key(g)) for g in sets_of(batch.column(1))]
            n = pa.array([g[0] for g in grams], pa.int64())
            key = pa.array([g[1] for g in grams], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), n, key], ["_id", "n", "key"])

    return docs.select(id_col, text_col).mapInArrow(run, f"_id {kind}, n bigint, key binary")


PIECE = "block int, keys binary, sizes binary, counts binary, grams binary"


def column_blocks(docs: DataFrame, text_col: str, blocks: int) -> DataFrame:
    """The incidence matrix by blocks of columns.  A row holds the entries of many
    documents in one block: the key, the size and the number of entries of each
    document, and the entries.  A set that a task has met before is not repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        keys: list[bytes] = []
        grams: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for g in sets_of(batch.column(0)):
                key = set_key(g)
                if key is None or key in met:
                    continue
                if len(met) >= 1_000_000:
                    met.clear()
                met.add(key)
                keys.append(key)
                grams.append(g)
                held += len(g)
                if held >= FLUSH:
                    yield by_block(keys, grams, blocks)
                    keys, grams, held = [], [], 0
        if keys:
            yield by_block(keys, grams, blocks)

    return docs.select(text_col).mapInArrow(run, PIECE)


def by_block(keys: list[bytes], grams: list[np.ndarray], blocks: int) -> pa.RecordBatch:
    sizes = np.array([len(g) for g in grams], np.uint32)
    flat = np.concatenate(grams)
    row = np.repeat(np.arange(len(keys)), sizes)
    block = (flat % np.uint64(blocks)).astype(np.int64)
    order = np.argsort(block, kind="stable")
    flat, row = flat[order], row[order]
    edges = np.searchsorted(block[order], np.arange(blocks + 1))
    out: list[tuple] = []
    for b in np.flatnonzero(np.diff(edges)).tolist():
        part = slice(edges[b], edges[b + 1])
        rows, counts = np.unique(row[part], return_counts=True)
        out.append(
            (
                b,
                b"".join([keys[r] for r in rows]),
                sizes[rows].tobytes(),
                counts.astype(np.uint32).tobytes(),
                flat[part].tobytes(),
            )
        )
    kinds = [pa.int32(), *[pa.binary()] * 4]
    names = [x.split()[0] for x in PIECE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


SHARED = PIECE + ", degrees binary"
SURVIVORS = "key binary, n bigint, grams array<bigint>, " + ", ".join(f"{b} bigint" for b in BITS)


def read_all(batches: Iterator[pa.RecordBatch], names: list[str]) -> dict[str, bytes]:
    """The pieces of one or more whole blocks, put together."""
    parts: dict[str, list[bytes]] = {n: [] for n in names}
    for batch in batches:
        for n in names:
            parts[n].extend(x.as_py() for x in batch.column(n))
    return {n: b"".join(parts.pop(n)) for n in names}


def runs(pieces: dict[str, bytes]) -> tuple:
    """Key, number of the key, size of the set and number of entries of each run."""
    keys = pa.array(np.frombuffer(pieces["keys"], "V12").tolist(), pa.binary())
    code = keys.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    counts = np.frombuffer(pieces["counts"], np.uint32).astype(np.int64)
    return keys, code, np.frombuffer(pieces["sizes"], np.uint32), counts


def shared_entries(blocks: int):
    """Of blocks of columns the entries in columns of two sets or more, with the
    number of sets in the column, dealt out to as many blocks of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = read_all(batches, ["keys", "sizes", "counts", "grams"])
        if not pieces["keys"]:
            return
        keys, code, sizes, counts = runs(pieces)
        grams = np.frombuffer(pieces.pop("grams"), np.uint64)
        # Two tasks may have sent one set; a block of it then comes twice, whole.  A
        # set may also have runs in several blocks of this task, which stay apart.
        start = grams[np.cumsum(counts) - counts]
        order = np.lexsort((start, code))
        new = np.append(True, (np.diff(code[order]) != 0) | (start[order][1:] != start[order][:-1]))
        first = np.zeros(len(code), bool)
        first[order[new]] = True
        grams = grams[np.repeat(first, counts)]
        keys, sizes, counts = keys.filter(pa.array(first)), sizes[first], counts[first]
        order = np.argsort(grams, kind="stable")
        ordered = grams[order]
        edges = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        width = np.diff(np.append(edges, len(ordered)))
        degree = np.empty(len(grams), np.int32)
        degree[order] = np.repeat(width, width)
        many = degree > 1
        row = np.repeat(np.arange(len(counts)), counts)[many]
        grams, degree = grams[many], degree[many]
        name = np.frombuffer(b"".join(keys.to_pylist()), np.uint32).reshape(-1, 3)[:, 0]
        block = (name % np.uint32(blocks)).astype(np.int64)
        order = np.argsort(block[row], kind="stable")
        row, grams, degree = row[order], grams[order], degree[order]
        edges = np.searchsorted(block[row], np.arange(blocks + 1))
        for b in np.flatnonzero(np.diff(edges)).tolist():
            part = slice(edges[b], edges[b + 1])
            rows, n = np.unique(row[part], return_counts=True)
            piece = {
                "block": b,
                "keys": b"".join(keys.take(pa.array(rows)).to_pylist()),
                "sizes": sizes[rows].tobytes(),
                "counts": n.astype(np.uint32).tobytes(),
                "grams": grams[part].tobytes(),
                "degrees": degree[part].tobytes(),
            }
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], pa.int32() if k == "block" else pa.binary()) for k, v in piece.items()],
                list(piece),
            )

    return run


def whole_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of blocks of rows the sets that a link is possible for, with their shared
    n-grams, rarest first, and signature: each n-gram turns over one of its bits."""
    pieces = read_all(batches, ["keys", "sizes", "counts", "grams", "degrees"])
    if not pieces["keys"]:
        return
    keys, code, sizes, counts = runs(pieces)
    number = int(code.max()) + 1
    n = np.zeros(number, np.int64)
    n[code] = sizes
    shared = np.bincount(code, counts, number).astype(np.int64)
    good = 100 * shared >= PERCENT * n
    row = np.repeat(code, counts)
    keep = good[row]
    grams = np.frombuffer(pieces["grams"], np.uint64)[keep]
    degree = np.frombuffer(pieces["degrees"], np.int32)[keep]
    row = row[keep]
    order = np.lexsort((grams.view(np.int64), degree, row))
    grams, row = grams[order], row[order]
    bits = np.zeros((number, SIGNATURE), np.uint64)
    word = ((grams >> np.uint64(40)) % np.uint64(SIGNATURE)).astype(np.int64)
    np.bitwise_xor.at(bits, (row, word), np.uint64(1) << ((grams >> np.uint64(32)) & np.uint64(63)))
    names = keys.dictionary_encode().dictionary
    rows = np.flatnonzero(good)
    edges = np.searchsorted(row, np.append(rows, number))
    for i in range(0, len(rows), 10_000):
        part, edge = rows[i : i + 10_000], edges[i : i + 10_001]
        at = pa.array((edge - edge[0]).astype(np.int32))
        lists = pa.ListArray.from_arrays(at, pa.array(grams[edge[0] : edge[-1]].view(np.int64)))
        signs = [pa.array(np.ascontiguousarray(bits[part, k]).view(np.int64)) for k in range(SIGNATURE)]
        yield pa.RecordBatch.from_arrays(
            [names.take(pa.array(part)), pa.array(n[part]), lists, *signs],
            ["key", "n", "grams", *BITS],
        )


def survivors(docs: DataFrame, text_col: str, entries: int) -> DataFrame:
    """key, n, grams (those in two sets or more, rarest first) and signature of the
    sets of which so many n-grams are shared that a link is possible: an overlap is
    at most the number of shared n-grams, and a union at least the size of the set.
    ``entries`` of the matrix, or more, tell the number of blocks."""
    blocks = max(1, -(-entries // BLOCK_ENTRIES))
    columns = column_blocks(docs, text_col, blocks).repartitionById(blocks, F.col("block"))
    rows = columns.mapInArrow(shared_entries(blocks), SHARED)
    return rows.repartitionById(blocks, F.col("block")).mapInArrow(whole_rows, SURVIVORS)


def prefixes(rows: DataFrame) -> DataFrame:
    """gram, key, n, most, early: the rarest n-grams of a set, so many that the first
    one that two linked sets have in common, in this order, is among those of both.

    A linked set has three quarters of a set's n-grams or more, so their first common
    one is among any n - ceil(3n/4) + 1; and six sevenths of those of the smaller set,
    so there it is among n - ceil(6n/7) + 1: it is early.  The unshared n-grams come
    first and meet nothing."""
    most = F.size("grams").cast("bigint")
    unshared = F.col("n") - most
    length = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1 - unshared
    first = F.col("n") - F.ceil(F.col("n") * 2 * PERCENT / (100 + PERCENT)) + 1 - unshared
    few = F.posexplode(F.slice("grams", 1, length.cast("int"))).alias("place", "gram")
    found = rows.select("key", "n", most.alias("most"), first.alias("first"), few)
    return found.select("gram", "key", "n", "most", (F.col("place") < F.col("first")).alias("early"))


def distinct_columns(entries: DataFrame) -> DataFrame:
    """The entries of columns that hold the same sets (by 128 bits) as those of one
    of them, early if they are in any; the others would only meet the same pairs
    again.  Columns of one set meet none."""
    marks = [F.bit_xor(F.xxhash64(F.lit(k), "key")).alias(f"x{k}") for k in (1, 2)]
    columns = entries.groupBy("gram").agg(F.count("*").alias("sets"), *marks).filter("sets > 1")
    columns = columns.withColumn("as", F.min("gram").over(Window.partitionBy("sets", "x1", "x2")))
    named = entries.join(columns.select("gram", "as"), "gram")
    return named.groupBy(F.col("as").alias("gram"), "key", "n", "most").agg(
        F.bool_or("early").alias("early")
    )


def overlapping(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The linked ones of distinct pairs (a_key, b_key, ...), by the sum of their
    products."""
    right, left = (
        rows.select(*[F.col(c).alias(f"{s}_{c}") for c in ("key", "n", "grams")]) for s in "ba"
    )
    overlap = F.size(F.array_intersect("a_grams", "b_grams"))
    found = cut(pairs).join(right, "b_key").join(left, "a_key").filter(linked(overlap))
    return found.select(*pairs.columns)


def possible(a: str, b: str) -> Column:
    """Whether the sizes and shared n-grams of two sets allow a link."""
    most = F.least(f"{a}_most", f"{b}_most")
    return linked(most, f"{a}_n", f"{b}_n")


def signatures_allow(a: str, b: str) -> Column:
    """Whether the signatures allow a link: where bits differ, one set has an n-gram
    that the other lacks, so the overlap is at most half of what is left of the
    shared n-grams of both after as many."""
    differ = sum(F.bit_count(F.col(f"{a}_{x}").bitwiseXOR(F.col(f"{b}_{x}"))) for x in BITS)
    most = F.floor((F.col(f"{a}_most") + F.col(f"{b}_most") - differ) / 2)
    return linked(most, f"{a}_n", f"{b}_n")


ENTRY = ["key", "n", "most", "label"]


def first_common(a: str, b: str) -> Column:
    """Whether the column can be the first common one of two linked sets."""
    n, m = F.col(f"{a}_n"), F.col(f"{b}_n")
    return ((n > m) | F.col(f"{a}_early")) & ((m > n) | F.col(f"{b}_early"))


def side(entries: DataFrame, name: str, *more: str) -> DataFrame:
    return entries.select("gram", *[F.col(c).alias(f"{name}_{c}") for c in (*ENTRY, *more)])


def set_links(rows: DataFrame) -> DataFrame:
    """key, label: equal labels for sets that links connect; unlinked sets may be
    left out.

    In some rounds a few sets of each column (n-gram) are pivots that its others are
    held against; the linked ones take a pivot's label.  Sets of one label need no
    further products.  After that, in each column all sets outside its most frequent
    label are held against all sets of other labels, so no link that matters is
    missed; pairs within that label, which are nearly all pairs of a large group,
    are never looked at.  Only pairs that the bounds of sizes and signatures allow
    leave the join, and only of these the products are added up.
    """
    entries = cut(distinct_columns(stored(prefixes(rows), "prefixes")))
    entries = entries.withColumn("label", F.col("key"))
    apart = F.col("a_label") != F.col("b_label")
    links = []
    for turn in range(ROUNDS):
        ranks = [
            F.min(F.struct(F.xxhash64("label", "key", F.lit(turn * PIVOTS + k)), *ENTRY)).alias(f"p{k}")
            for k in range(PIVOTS)
        ]
        few = F.explode(F.array_distinct(F.array(*[
            F.struct(*[F.col(f"p{k}.{c}") for c in ENTRY]) for k in range(PIVOTS)
        ])))
        pivots = entries.groupBy("gram").agg(*ranks).select("gram", few.alias("p"))
        pivots = pivots.select("gram", *[F.col(f"p.{c}").alias(f"b_{c}") for c in ENTRY])
        pairs = side(entries, "a").join(pivots, "gram").filter(apart & possible("a", "b"))
        new = cut(overlapping(pairs.select("a_key", "a_label", "b_key", "b_label").distinct(), rows))
        links.append(new.select("a_key", "b_key"))
        # Labels that links join become one: a label is always the key of a set that
        # links connect to those that bear it.
        joined = new.select(F.col("a_label").alias("a"), F.col("b_label").alias("b"))
        moved = smallest_reachable(joined).select(F.col("node").alias("label"), "root")
        entries = cut(
            entries.join(moved, "label", "left").select(
                "gram", "key", "n", "most", "early", F.coalesce("root", "label").alias("label")
            )
        )
    sizes = entries.groupBy("gram", "label").agg(F.count("*").alias("sets"))
    frequent = F.max_by("label", F.struct("sets", "label")).alias("frequent")
    columns = sizes.groupBy("gram").agg(F.count("*").alias("labels"), frequent)
    entries = entries.join(columns.filter("labels > 1").select("gram", "frequent"), "gram")
    entries = cut(entries.join(rows.select("key", *BITS), "key"))
    others = side(entries.filter("label <> frequent"), "a", "early", *BITS)
    bounds = apart & first_common("a", "b") & possible("a", "b") & signatures_allow("a", "b")
    pairs = others.join(side(entries, "b", "early", *BITS), "gram").filter(bounds)
    pairs = pairs.select(
        F.least("a_key", "b_key").alias("a_key"), F.greatest("a_key", "b_key").alias("b_key")
    )
    links.append(overlapping(pairs.distinct(), rows))
    every = reduce(DataFrame.unionByName, links)
    found = smallest_reachable(every.select(F.col("a_key").alias("a"), F.col("b_key").alias("b")))
    return found.select(F.col("node").alias("key"), F.col("root").alias("label"))


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id.

    Words are runs without ASCII blanks, A-Z in lower case; a document's set are its
    distinct shingles of five words, or all its words as one if they are fewer.  Two
    documents link when the common shingles are three quarters or more of all
    shingles of both; component_id is the smallest id reachable by links.  A null,
    empty or blank text has no shingles and no links, and its own id as component.
    Null ids are larger than any other, so a group of null ids only has a null
    component.  Rows of one id are linked only if their texts are.  No rows give no
    rows; other columns are not looked at.

    Shingles are 64-bit hashes and sets are named by 96 bits.  Equal sets are one
    row of the matrix, however many documents have them.  The text is read twice,
    and of the matrix only the blocks are shuffled (8 bytes an entry and some 20 per
    document and block); there are as many blocks as BLOCK_ENTRIES asks for.
    """
    named = stored(sets(docs, id_col, text_col), "sets")
    entries = named.agg(F.sum("n")).collect()[0][0] or 0
    rows = stored(survivors(docs, text_col, entries), "survivors")
    labels = set_links(rows)
    firsts = named.filter("n > 0").groupBy("key").agg(F.min("_id").alias("first"))
    firsts = firsts.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    firsts = cut(firsts)
    least = firsts.groupBy("label").agg(F.min("first").alias("component_id"))
    found = stored(firsts.join(least, "label").select("key", "component_id"), "components")
    return named.join(found, "key", "left").select(
        F.col("_id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"),
    )


def without_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each group the documents of the smallest id, with all their columns.

    Rows without an id stay, as do all rows of an id that one of them keeps.  The ids
    that go are far fewer than those that stay; Spark broadcasts them if their table
    is small enough, and joins by shuffle if not."""
    groups = similar_groups(docs, id_col, text_col).filter(F.col(id_col).isNotNull())
    stays = F.bool_or(F.col(id_col) == F.col("component_id")).alias("_stays")
    gone = groups.groupBy(F.col(id_col).alias("_gone")).agg(stays).filter("NOT _stays")
    gone = stored(gone.select("_gone"), "gone")
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")

"""Sources interleaved to target weights by Pfair scheduling, in SQL functions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeline.llm.common import cut, without

BLOCK_ROWS = 8
CHUNK_DIGITS = 3  # a source is numbered in 16 ** 3 parts at a time
BROADCAST_ROWS = 20_000  # of the timetable, some 60 bytes each

# One turn of the schedule: of the blocks that are released, the one with the
# earliest deadline; ties go to the first source.  Block j of a source with n of
# the d turns is released at floor(j * d / n) and due at ceil((j + 1) * d / n).
NEXT = """
    array_min(transform(sequence(0, size(n) - 1), i -> IF(
        a.done[i] < n[i] AND (a.done[i] * d) DIV n[i] <= turn,
        named_struct('due', ((a.done[i] + 1) * d + n[i] - 1) DIV n[i], 'i', i), NULL))).i
"""
TURNS = f"""
    aggregate(sequence(0L, d - 1),
        named_struct('done', transform(n, x -> 0L), 'picks', cast(array() AS array<int>),
                     'pick', cast(NULL AS int)),
        (b, turn) -> transform(array(b), a -> transform(array({NEXT}), p -> named_struct(
            'done', transform(a.done, (c, i) -> IF(i = p, c + 1, c)),
            'picks', concat(a.picks, array(p)), 'pick', p))[0])[0],
        b -> b.picks)
"""


def timetable(totals: DataFrame, block_rows: int) -> DataFrame:
    """Where each block of each source goes, from one row (_src, rows, share) per
    source.

    Time runs in rounds; in a round each source has as many turns as its share, so
    the turns of all full rounds are the same.  A source's last round has what is
    left of it; from then on the rounds are made of the other sources.  Between
    these at most 2 * sources changes one timetable holds, so there is one row for
    each turn of each such stretch, whatever the number of rows in the sources.
    """
    rows_of = f"(s.rows - (s.blocks - 1) * {block_rows})"  # in the last block
    stretches = (
        totals.withColumn("blocks", F.expr(f"(rows + {block_rows - 1}) DIV {block_rows}"))
        .agg(F.sort_array(F.collect_list(F.struct("_src", "rows", "share", "blocks"))).alias("s"))
        .filter("size(s) > 0")
        .withColumn("ends", F.expr("transform(s, x -> (x.blocks - 1) DIV x.share)"))
        .selectExpr(
            "s",
            "array_sort(array_distinct(concat(array(0L), ends, transform(ends, x -> x + 1)))) t",
        )
        .selectExpr(
            "s",
            "explode(transform(sequence(1, size(t) - 1),"
            " i -> named_struct('start', t[i - 1], 'stop', t[i]))) AS q",
        )
        .selectExpr("s", "q.start", "q.stop")
        .withColumn(
            "n", F.expr("transform(s, x -> greatest(0L, least(x.share, x.blocks - start * x.share)))")
        )
        .withColumn("d", F.expr("aggregate(n, 0L, (a, x) -> a + x)"))
    )
    turns = (
        stretches.select("s", "start", "stop", F.posexplode(F.expr(TURNS)).alias("turn", "i"))
        .selectExpr("s[i] AS s", "start", "stop", "turn", "i")
        .withColumn(
            "r",
            F.row_number().over(Window.partitionBy("start", "i").orderBy("turn")).cast("bigint") - 1,
        )
        .withColumn(
            "held",
            F.expr(
                f"IF(start * s.share + r = s.blocks - 1, {rows_of}, {block_rows}L)"
            ),
        )
    )
    within = Window.partitionBy("start").orderBy("turn")
    turns = turns.withColumn("within", F.sum("held").over(within) - F.col("held")).withColumn(
        "round_rows", F.sum("held").over(Window.partitionBy("start"))
    )
    bases = turns.groupBy("start", "stop").agg(F.first("round_rows").alias("round_rows"))
    so_far = Window.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    bases = bases.select(
        "start",
        F.coalesce(
            F.sum(F.expr("(stop - start) * round_rows")).over(so_far), F.lit(0)
        ).alias("base"),
    )
    return turns.join(bases, "start").selectExpr(
        "s._src AS _src", "r AS _r", "start AS _start", "stop AS _stop",
        "base AS _base", "round_rows AS _round_rows", "within AS _within",
    )


def mixed(
    docs: DataFrame,
    shares: Mapping[str, int],
    default_share: int = 1,
    block_rows: int = BLOCK_ROWS,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """docs with source_block (number of the block within its source) and position
    (0, 1, 2, ... over all rows): the order in which the sources interleave to
    their target weights.

    A source is cut into blocks of ``block_rows`` rows, in an order that MD5 of the
    id shuffles.  Its weight is its share over the shares of all sources that still
    have rows.  At any time a source is less than one block away from its weight,
    and no row is dropped or repeated: once a source runs out, the others go on
    with their weights to each other.  Shares are whole numbers of 1 or more.

    A null source counts as the source ''.  Rows of equal ids are ordered by all
    their columns; wholly equal rows are interchangeable.  Input columns of the added names are
    replaced.  No rows give no rows.

    Rows are numbered within (source, chunk of the MD5) and chunks within sources,
    so no task holds a source.  The timetable is broadcast if it has few rows, which
    are counted, and joined by shuffle if it has more.
    """
    if min([default_share, *shares.values()]) < 1:
        raise ValueError("shares are whole numbers of 1 or more")
    docs = without(docs, "source_block", "position")
    columns = docs.columns
    everything = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    order = F.md5(F.coalesce(F.col(id_col).cast("string"), everything.cast("string")))
    source = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    share = F.lit(default_share)
    for name, weight in shares.items():
        share = F.when(F.col("_src") == name, weight).otherwise(share)
    rows = docs.select(
        *[F.col(f"`{c}`") for c in columns], source.alias("_src"), order.alias("_order")
    ).withColumn("_chunk", F.substring("_order", 1, CHUNK_DIGITS))
    chunks = cut(rows.groupBy("_src", "_chunk").count())
    totals = chunks.groupBy("_src").agg(F.sum("count").alias("rows"))
    turns = cut(timetable(totals.withColumn("share", share.cast("bigint")), block_rows))
    if turns.count() <= BROADCAST_ROWS:
        turns = F.broadcast(turns)
    before = Window.partitionBy("_src").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    places = chunks.select(
        "_src",
        "_chunk",
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"),
        share.cast("bigint").alias("_share"),
    )
    number = F.row_number().over(Window.partitionBy("_src", "_chunk").orderBy("_order", everything))
    numbered = rows.withColumn("_number", number).join(places, ["_src", "_chunk"])
    numbered = (
        numbered.withColumn("_k", F.col("_before") + F.col("_number") - 1)
        .withColumn("source_block", F.expr(f"_k DIV {block_rows}"))
        .withColumn("_round", F.expr("source_block DIV _share"))
        .withColumn("_r", F.expr("source_block % _share"))
    )
    at = F.expr("_round >= _start AND _round < _stop")
    position = F.expr(f"_base + (_round - _start) * _round_rows + _within + _k % {block_rows}")
    return numbered.join(turns.withColumnRenamed("_src", "_of").withColumnRenamed("_r", "_turn"),
        (F.col("_src") == F.col("_of")) & (F.col("_r") == F.col("_turn")) & at,
    ).select(*[F.col(f"`{c}`") for c in columns], "source_block", position.alias("position"))

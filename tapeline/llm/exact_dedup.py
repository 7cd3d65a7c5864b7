"""Exact duplicates: group by a 128-bit hash, settle by the bytes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import BLANKS, cut


def content_hash(text: Column) -> Column:
    """128 bits of a text."""
    return F.unhex(F.md5(text))


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII blanks became one
    space; null counts as empty.  Of equal texts the row with the smallest id
    stays; rows that repeat this id and text are all marked as kept.  A null id
    loses to any other; a group of null ids only has a null keep_id and keeps all.
    No rows give no rows; other columns are not looked at.

    Rows meet by hash and are then grouped by the text itself, so a collision of
    hashes ends in two groups.  A task sends one copy of a text, however many it
    has read, and of the groups only those of two rows or more come back to the
    documents, by hash and SHA-256 (384 bits that texts of different bytes would
    have to share).  That join moves no text; the few columns of a hot group are
    dealt to several tasks by Spark's skew join, as both sides are plain
    exchanges.
    """
    text = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), BLANKS, " ")
    texts = docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
    texts = texts.withColumn("_hash", hashed(F.col("_text")))
    digest = F.sha2("_text", 256)
    groups = (
        texts.groupBy("_hash", "_text")
        .agg(F.min("_id").alias("_keep"), F.count("*").alias("_size"))
        .filter("_size > 1")
        .select("_hash", digest.alias("_sha"), "_keep", "_size")
    )
    rows = texts.select("_id", "_hash", digest.alias("_sha"))
    keep = F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return rows.join(cut(groups), ["_hash", "_sha"], "left").select(
        F.col("_id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    keep = exact_groups(docs, id_col, text_col).filter("kept").select(id_col).distinct()
    return docs.join(keep, docs[id_col].eqNullSafe(keep[id_col]), "left_semi")

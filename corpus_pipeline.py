"""The corpus pipeline: documents through five of the operators.

Each stage gets the Parquet table that its predecessor left and returns what goes on:
toxic documents are rejected, of similar ones one stays, those with benchmark
passages go, the rest is brought into the order of the mix and cut into shards.
"""

from __future__ import annotations

from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.llm import decontamination, jaccard, mixing, sharding, toxicity
from tapeline.llm.common import stored, table
from tapeline.llm.registry import MIX_DEFAULT, MIX_SHARES, SHARDS


#: Of the documents, the columns that a stage may look at.
KNOWN = ["doc_id", "text", "lang", "source", "n_chars"]


def apart(stage):
    """The stage with all other columns of its input under names that nothing it adds
    can clash with, and theirs again behind it; a column that it adds replaces one of
    its name."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = {f"_other_{k}": c for k, c in enumerate(c for c in docs.columns if c not in KNOWN)}
        back = {c: name for name, c in others.items()}
        names = [back.get(c, c) for c in docs.columns]
        out = stage(spark, docs.toDF(*names) if others else docs, sf_dir)
        new = {c.lower() for c in out.columns if c not in others}
        kept = [c for c in out.columns if c not in others or others[c].lower() not in new]
        return out.select(*kept).toDF(*[others.get(c, c) for c in kept]) if others else out

    return run


@apart
def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; null and empty texts stay."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    scores = toxicity.scored(docs, model)
    return scores.filter(F.col("score") < toxicity.THRESHOLD).select(docs.columns)


@apart
def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id."""
    return jaccard.without_similar(docs)


@apart
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


@apart
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: that of the rows in the files written,
    one file after the other."""
    mixed = mixing.mixed(docs, MIX_SHARES, MIX_DEFAULT)
    return mixed.orderBy("position").select(docs.columns)


@apart
def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with shard and slot, in the order of the mix."""
    try:
        docs.select("_metadata.file_path")
    except AnalysisException:  # rows that do not come from files
        docs = stored(docs, "unsharded")
    sized = docs.withColumn("_size", sharding.row_size())
    return sharding.shards_in_stored_order(sized, SHARDS, "_size").drop("_size")


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard", one_of_similar),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]
ORACLE_SQL = None  # the first stages are a trained model and seeds; tests hold brute force against them


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

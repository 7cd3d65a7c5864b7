"""What the text operators share: tables, the shared folder, cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII blanks, the only characters that separate words here.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which driver and executors
    share.  Where it is unset, as in local tests, a temporary folder is taken; on a cluster
    this would be another folder on each machine, so it is an error."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        named = "file://" + tempfile.mkdtemp(prefix="tapeline-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The rows of df, kept in the shared folder: later steps read them there and
    need no executor that made them.  For narrow data."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """As cut, but as compressed Parquet, of which later steps read the columns
    they need."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def without(df: DataFrame, *added: str) -> DataFrame:
    """df without columns of the names that an operator adds: its own replace them."""
    names = {c.lower() for c in added}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in names])


def utf8(text: str | Column) -> Column:
    """The bytes of a text; null has none."""
    return F.coalesce(F.encode(text, "UTF-8"), F.encode(F.lit(""), "UTF-8"))

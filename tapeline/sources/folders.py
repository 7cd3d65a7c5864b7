"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the one that ``spark.checkpoint.dir`` names.

    Where it is unset and Spark runs in one process, as in tests, a temporary folder
    serves; on a cluster that would be another folder on each machine, so it is an error.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        named = "file://" + tempfile.mkdtemp(prefix="tapeline-")
    return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex}"

"""Folders for what a job writes and reads again, shared by the driver and all executors."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir. Where that is unset, a temporary one in a single process (tests); on a cluster an error."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = _own()
    return f"{root.rstrip('/')}/store-{uuid.uuid4().hex}"


@cache
def _own() -> str:
    return tempfile.mkdtemp(prefix="store-")


def written(df: DataFrame, path: str) -> DataFrame:
    """df as a table at path: computed once, with no lineage left."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

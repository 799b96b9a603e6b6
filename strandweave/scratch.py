"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; where a session on this machine alone names none, a temporary folder; else an error."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):  # a Connect session may hide its master
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="strandweave-"))
    return _LOCAL[0]


def new_path(spark: SparkSession, name: str = "table") -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back: lineage ends there, and lost executors cost tasks only."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

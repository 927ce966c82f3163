"""Intermediate tables in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session.

    Only where that is unset, and then only on a local master, a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.conf.get("spark.app.id")
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="tradewinds-")
    return _own_folders[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to a table of its own and read that, which ends its lineage.

    The table lies on shared storage, so a lost executor costs no recomputation.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

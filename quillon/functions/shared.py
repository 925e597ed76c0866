"""Tables written to the folder that driver and executors share: they cut the lineage and survive lost executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir; where that is unset, below a temporary folder in local mode only."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        top = "file:///tmp/quillon-shared"
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str = "table") -> DataFrame:
    """df written once and read again."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

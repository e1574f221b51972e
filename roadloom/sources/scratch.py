"""Scratch tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``; a local master without one gets a folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"/tmp/checkpoints/{uuid.uuid4().hex}"
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a scratch Parquet table and read back: later stages start from its files."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Frames written once to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from .session import ensure_checkpoint_dir


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table of its own under ``spark.checkpoint.dir``: lineage is cut, and
    what follows reads it as often as it likes at the price of a scan."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/staged-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Intermediate results that several branches of a report share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Name of a new folder that every executor can reach.

    The cluster names its parent in ``spark.checkpoint.dir``. Only a local
    session, where driver and executors share one disk, may do without.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/wardbook-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """Write a small intermediate result once and go on from the files.

    The branches that use it do not compute it again, a lost executor costs a
    read, and joins see its true size: Spark broadcasts it if it is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise, where
    the estimate for the joins it came from would have ruled that out.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


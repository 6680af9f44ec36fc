"""Tables that outlive the executors which made them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Only a local session without that setting (a test) gets a temporary folder; on a cluster other executors could not read it.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path is None:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
        path = sc.getCheckpointDir()
    return path


def stored(df: DataFrame, tag: str, compression: str | None = None) -> DataFrame:
    """Write the rows as Parquet into the shared folder and read them back.

    This cuts the lineage, and what is not deterministic is decided once. ``compression`` is for tables of long texts.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)

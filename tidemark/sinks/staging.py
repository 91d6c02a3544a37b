"""Tables that stand between the steps of one job, in the folder that driver and executors share.

A staged table is made once however often it is read, and cuts lineage: after a lost executor its files are read again.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``.

    Where that is unset a temporary folder is taken in local mode; on a cluster it is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table under the shared folder, read again; left there for the cluster's own clean-up."""
    spark = df.sparkSession
    path = f"{folder(spark)}/tidemark-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

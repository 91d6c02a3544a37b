"""Tables written once and read again, in the folder that driver and executors share.

A written table cuts lineage: when an executor is lost, later stages read the files again
instead of repeating what made them.  The shuffle files of a write go as soon as the table stands, and a table
goes (``drop``) once what was made of it is written, so the disk in use is that of the widest step.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that removes the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's setting of the rows that go to a Python worker at once.
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a temporary folder in local mode and an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tidemark-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again; ``batch`` rows at most go to a Python worker at once, where they are large."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    settings = {_CLEANUP: "true"} | ({_BATCH: str(batch)} if batch else {})
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` gave and that nothing reads any more."""
    for table in tables:
        remove(table.sparkSession, table.scratch_path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that ``new_path`` named, in whatever file system it lies."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def free_prefix(columns: Iterable[str]) -> str:
    """A beginning that no column has, for names that stand beside the user's."""
    found, taken = "_t", [c.lower() for c in columns]
    while any(c.startswith(found) for c in taken):
        found = "_" + found
    return found + "_"

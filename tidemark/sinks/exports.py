"""Sinks: sorted Parquet exports with derived flags, their manifest, CSV for spreadsheets, and JSON documents."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a row group: small enough for readers that fetch a few series by range requests.
ROW_GROUP = 40_000


def flagged(df: DataFrame, key: str, **sets: DataFrame) -> DataFrame:
    """``df`` with one boolean column for each set: whether the row's key is among the keys there; false for a null key."""
    for name, rows in sets.items():
        keys = rows.select(F.col(key).alias("_flag_key")).where("_flag_key is not null").distinct()
        df = df.join(keys, df[key] == keys["_flag_key"], "left").withColumn(name, F.col("_flag_key").isNotNull()).drop("_flag_key")
    return df


def sorted_parquet(df: DataFrame, path: str, *order: str) -> None:
    """Replaces the table at ``path``: files cover ranges of the order, rows inside are sorted, so statistics prune."""
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges.write.mode("overwrite").option("compression", "zstd").option("parquet.block.row.count.limit", ROW_GROUP).parquet(path)


def manifest(spark: SparkSession, path: str, tables: dict[str, str], period: str = "period") -> dict[str, object]:
    """Writes and returns ``{"files": {name: rows}, "max_period": latest}`` of exported Parquet tables, null where none has a period."""
    files, latest = {}, []
    for name, where in sorted(tables.items()):
        df = spark.read.parquet(where)
        newest = F.max(period) if period in df.columns else F.lit(None)
        files[name], last = df.agg(F.count("*"), newest).first()
        latest += [last] if last is not None else []
    found = {"files": files, "max_period": max(latest, default=None)}
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(json.dumps(found, ensure_ascii=False).encode()))
    out.close()
    return found


def spreadsheet_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, whose first name follows a byte order mark in every file; quotes are doubled."""
    marked = df.toDF("﻿" + df.columns[0], *df.columns[1:])
    marked.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def json_documents(df: DataFrame, path: str, keys: list[str], name: str = "rows") -> None:
    """One compact JSON document a line for each key, with its rows nested under ``name``; nulls are kept.

    For exports of groups that are small by definition (a product's series, a region's cards).
    """
    rest = [c for c in df.columns if c not in keys]
    nested = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*rest))).alias(name))
    nested.write.mode("overwrite").option("ignoreNullFields", False).json(path)

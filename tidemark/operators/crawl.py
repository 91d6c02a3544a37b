"""What a crawl leaves behind: records by key, of which the last version wins, whatever the order of batches and re-runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks.staging import staged

#: Folder column: the part of the table that a key's record is in.
PART = "_part"


def last_wins(rows: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """One row a key: that of the greatest version, of equal versions that whose other columns sort last.

    Versions compare column by column, nulls first. Keys may be null, which is a key like any other. The aggregate
    combines before it shuffles, so a key with very many versions sends one row a task.
    """
    rest = [c for c in rows.columns if c not in keys and c not in version]
    order = F.struct(*version, *rest)
    kept = rows.groupBy(*keys).agg(F.max_by(order, order).alias("_row"))
    return kept.select(*(c if c in keys else F.col(f"_row.`{c}`").alias(c) for c in rows.columns))


class Store:
    """A table of records by key at ``path``, in ``parts`` folders by the key's hash.

    ``put`` is idempotent and does not depend on order: a batch that is repeated, or comes late, leaves the same table.
    One writer at a time. The number of parts is fixed when the store is made: give more for more records.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], version: list[str], parts: int = 64) -> None:
        self.spark, self.path, self.schema, self.keys, self.version, self.parts = spark, path, schema, keys, version, parts

    def _stored(self) -> DataFrame:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return self.spark.createDataFrame([], f"{self.schema}, {PART} int")
        return self.spark.read.schema(f"{self.schema}, {PART} int").option("basePath", self.path).parquet(self.path)

    def rows(self) -> DataFrame:
        return self._stored().drop(PART)

    def put(self, batch: DataFrame) -> None:
        """Merges a batch: only the parts that its keys fall into are read and written again.

        The merged rows are written beside first, so an executor that is lost, or a job that is run again, finds the parts whole.
        """
        columns = self.rows().columns
        fresh = batch.select(*columns).withColumn(PART, F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int"))
        touched = [r[0] for r in fresh.select(PART).distinct().collect()]  # at most ``parts`` numbers
        if not touched:
            return
        held = self._stored().where(F.col(PART).isin(touched))
        merged = staged(last_wins(held.unionByName(fresh), [*self.keys, PART], self.version), "store")
        out = merged.repartition(PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        out.partitionBy(PART).parquet(self.path)

    def pending(self, wanted: DataFrame) -> DataFrame:
        """The rows wanted whose keys the store does not hold yet; null keys are compared like others."""
        met = [wanted[k].eqNullSafe(F.col(f"_held.{k}")) for k in self.keys]
        return wanted.join(self.rows().select(*self.keys).alias("_held"), met, "left_anti")


def shortfall(listing: DataFrame, by: list[str], claimed: str, key: str) -> DataFrame:
    """Listings that claim more records than were retrieved: ``claimed``, ``retrieved`` and how many are missing."""
    found = listing.groupBy(*by).agg(F.max(claimed).cast("long").alias("claimed"), F.count_distinct(key).alias("retrieved"))
    return found.where("claimed > retrieved").withColumn("missing", F.col("claimed") - F.col("retrieved"))

"""The warehouse as tables: facts keyed and ranked once, bucketed by series, and every dimension and view made from them.

All tables that hold a series are hashed by its key into the same number of buckets, so that series, facts and quality
flags meet without an exchange. A series is one bucket's part however long it is; it is sorted there and spills to disk.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.labels import joined_key
from tidemark.operators import warehouse as W
from tidemark.sinks.exports import manifest, sorted_parquet
from tidemark.sinks.staging import folder, staged

#: Exported columns of a fact.
FACT = ("series_key", "release_key", "product_key", "period", "period_type", "value", "weight_pct", "table_name")

#: What a build writes, by default all of it.
TABLES = ("reading", "dim_series", "dim_release", "dim_product")
#: Columns of a fact that tell its series and reading, and those of its release.
_SAID = ("category_id", "pub_id", "table", "row_en", "row_ar", "col_en", "col_ar", "kind", "index_base", "period", "period_type", "value", "weight_pct")
_RELEASED = ("release_title", "source_file", "source_sha256", "product", "domain", "subdomain")


def _stated(name: str) -> Column:
    return F.coalesce(F.max(F.nullif(F.col(name), F.lit(""))), F.lit("")).alias(name)


def _release_key() -> Column:
    return joined_key(F.col("category_id"), F.col("pub_id"))


def _series(based: DataFrame) -> DataFrame:
    """A label that some release leaves out does not blank the name that others carry."""
    by = based.groupBy("series_key", F.md5("category_id").alias("product_key"), "category_id", F.coalesce("kind", F.lit("")).alias("kind"), F.col("base_norm").alias("index_base"))
    return by.agg(*map(_stated, ("row_en", "row_ar", "col_en", "col_ar")), F.min("period_type").alias("period_type"), F.min("table_name").alias("table_name"))


class Warehouse:
    """A database of the tables ``reading``, ``dim_series``, ``dim_release`` and ``dim_product``, and the views over them."""

    def __init__(self, spark: SparkSession, database: str) -> None:
        self.spark, self.database = spark, database

    @classmethod
    def build(cls, facts: DataFrame, files: DataFrame | None = None, database: str | None = None, order: tuple[str, ...] = ("pub_id",), tolerance: float = 0.001, buckets: int | None = None, tables: tuple[str, ...] = TABLES) -> Warehouse:
        """Writes the ``tables``, replacing those of an earlier build; ``facts`` is read once.

        ``facts`` has the columns of a facts file, nulls allowed but in ``category_id`` and ``pub_id``; rows that admission
        refuses leave no trace. ``files`` gives links by ``category_id`` and ``sha256``, the least of several is taken.
        ``order`` tells the readings of a series and period apart, latest last: it must be total for a defined result.
        ``buckets`` is the number of buckets, by default that of shuffle partitions; give more for more data.
        Facts may be empty: the tables are then empty, too. Views of tables that were left out can't be asked for;
        ``dim_product`` is made of ``dim_release``.

        Keys are long and don't compress, so but for that of the measure they are made where they are needed and not staged;
        a reading is exchanged once, without what its series or its release says.
        """
        spark = facts.sparkSession
        name = database or f"tidemark_{uuid.uuid4().hex}"
        spark.sql(f"create database if not exists {name}")
        house, n = cls(spark, name), buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        known, by_series = W.admitted(facts), {"reading", "dim_series"} & {*tables}
        if by_series:
            wanted = [c for c in facts.columns if c in {*_SAID, *order} or ("dim_release" in tables and c in _RELEASED)]
            known = staged(W.keyed(known.select(*wanted)).drop("series_key"), "keyed")
            based = W.with_base(known, staged(W.base_merge(known.where("kind = 'index'"), tolerance), "bases")).withColumn("series_key", joined_key(F.col("measure_key"), F.col("base_norm"))).withColumnRenamed("table", "table_name")
        if "dim_series" in tables:
            house._write(_series(based), "dim_series", n)
        if "reading" in tables:
            carried = {"series_key", "period", "period_type", "value", "weight_pct", "table_name", "category_id", "pub_id", *order}
            ranked = W.ranked(based.select(*(c for c in based.columns if c in carried)).repartition(n, "series_key"), order).withColumn("superseded", F.col("rn") > 1)
            house._write(ranked.withColumn("release_key", _release_key()).withColumn("product_key", F.md5("category_id")).select(*FACT, "rn", "superseded"), "reading", n, "superseded")
        if "dim_release" in tables:
            release = known.groupBy("category_id", "pub_id").agg(
                F.min("release_title").alias("title"), F.min("source_file").alias("source_file"), F.min("source_sha256").alias("source_sha256"), F.max("period").alias("max_period"),
                *(F.min(c).alias(c) for c in ("product", "domain", "subdomain")),
            )
            release = release.select(_release_key().alias("release_key"), "*")
            links = (spark.createDataFrame([], "category_id string, sha256 string, url string") if files is None else files).where("sha256 is not null and url is not null")
            links = links.groupBy("category_id", F.col("sha256").alias("source_sha256")).agg(F.min("url").alias("source_url"))
            house._save(release.join(links, ["category_id", "source_sha256"], "left").write, "dim_release")
        if "dim_product" in tables:
            by_product = house.table("dim_release").groupBy(F.md5("category_id").alias("product_key"), "category_id")
            house._save(by_product.agg(*(F.min(c).alias(c) for c in ("product", "domain", "subdomain")), F.count("*").alias("n_releases")).write, "dim_product")
        return house

    def _write(self, df: DataFrame, name: str, buckets: int, *parts: str) -> None:
        by = ["series_key", "period"] if "period" in df.columns else ["series_key"]
        rows = df.write.bucketBy(buckets, "series_key").sortBy(*by)
        self._save(rows.partitionBy(*parts) if parts else rows, name)

    def _save(self, rows: DataFrameWriter, name: str) -> None:
        """By its path, so that a build of the same name in another session replaces the files, too."""
        where = f"{folder(self.spark)}/{self.database}/{name}"
        rows.mode("overwrite").option("compression", "zstd").option("path", where).saveAsTable(f"{self.database}.{name}")

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")

    def observations(self) -> DataFrame:
        """One row for each series and period: the reading of the latest release."""
        return self.table("reading").where("not superseded").select(*FACT)

    def revisions(self) -> DataFrame:
        return self.table("reading").where("superseded").select("series_key", "release_key", "period", "value", F.col("rn").cast("long").alias("revision_age"))

    def releases(self) -> DataFrame:
        return self.table("dim_release").drop("product", "domain", "subdomain")

    def products(self) -> DataFrame:
        return self.table("dim_product")

    def star(self) -> DataFrame:
        """Observations with all that their series, product and release say."""
        series = self.table("dim_series").drop("product_key", "category_id", "period_type", "table_name")
        release = self.table("dim_release").select("release_key", "pub_id", F.col("title").alias("release_title"), "source_file")
        return self.observations().join(series, "series_key").join(self.products().drop("n_releases"), "product_key").join(release, "release_key").drop("product_key", "release_key")

    def quality(self, low: float = 10.0, high: float = 50.0, least: int = 3) -> DataFrame:
        """A row for each series: span, range, and whether it is suspect (mixed magnitudes), ambiguous or fit for a chart.

        One pass: a period's values are counted before superseded ones go, then periods are brought together by series.
        """
        cells = self.table("reading").groupBy("series_key", "period").agg(F.count_distinct(F.round("value", 3)).alias("n"), F.max(F.when(~F.col("superseded"), F.col("value"))).alias("value"))
        found = cells.groupBy("series_key").agg(
            F.count("*").alias("n_points"), F.min("period").alias("first_period"), F.max("period").alias("last_period"), F.min("value").alias("min_value"), F.max("value").alias("max_value"),
            F.max("n").alias("max_distinct"), F.count_if(F.col("n") > 1).alias("n_periods_ambiguous"),
        )
        suspect = (F.col("min_value") < low) & (F.col("max_value") > high) & (F.col("n_points") >= least)
        flagged = self.table("dim_series").join(found, "series_key").withColumn("suspect", suspect).withColumn("ambiguous", F.col("max_distinct") > 1)
        fit = (F.col("n_points") >= least) & (F.col("kind") != "weight") & ~F.col("suspect") & ~F.col("ambiguous") & (F.col("min_value") != F.col("max_value"))
        return flagged.withColumn("chartable", fit)

    def coverage(self) -> DataFrame:
        """Products with series, observations and span, summed over series instead of counted distinct over facts."""
        by = self.quality().groupBy("product_key").agg(F.count("*").alias("n_series"), F.sum("n_points").alias("n_observations"), F.min("first_period").alias("first_period"), F.max("last_period").alias("last_period"))
        return self.products().join(by, "product_key").drop("product_key")

    def export(self, path: str) -> dict[str, str]:
        """The set that readers fetch, as sorted Parquet with a manifest beside; returns paths by table."""
        flags = self.quality().select(*self.table("dim_series").columns, "ambiguous", "suspect")
        sets = {"fact_observation": (self.observations(), "series_key", "period"), "dim_series": (flags, "category_id", "series_key"), "dim_product": (self.products(), "category_id"), "dim_release": (self.releases(), "category_id", "pub_id")}
        for name, (rows, *order) in sets.items():
            sorted_parquet(rows, f"{path}/{name}.parquet", *order)
        paths = {name: f"{path}/{name}.parquet" for name in sets}
        manifest(self.spark, f"{path}/manifest.json", paths)
        return paths

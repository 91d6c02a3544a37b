"""Sources: Parquet tables, typed CSV facts, and the adapter from trade tables to statistical facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of a facts file; labels are read as strings, absent ones become empty.
FACTS = "category_id string, product string, domain string, subdomain string, pub_id string, release_title string, `table` string, recipe string, row_en string, row_ar string, col_en string, col_ar string, kind string, period string, period_type string, value double, weight_pct double, index_base string, source_sha256 string, source_file string"
_LABELS = ("row_en", "row_ar", "col_en", "col_ar", "kind", "index_base")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def facts_csv(spark: SparkSession, path: str) -> DataFrame:
    """Facts from CSV with an explicit schema: no inference pass over the data."""
    df = spark.read.schema(FACTS).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return df.fillna("", subset=list(_LABELS))


def strings_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def json_file(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Whole JSON documents, one or an array of them a file, by an explicit schema; absent fields are null."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def registered(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Temporary views by the tables' names, for SQL of the user's own."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def optional(spark: SparkSession, path: str, schema: str, reader: str = "parquet") -> DataFrame:
    """A table, or an empty one of the schema where the path does not exist."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.read.schema(schema).format(reader).load(path)
    return spark.createDataFrame([], schema)


def trade_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as readings: region is the category, part type and brand the labels, order the release, ship month the period."""
    line, order, part, supplier, nation, region = (table(spark, sf_dir, n) for n in ("lineitem", "orders", "part", "supplier", "nation", "region"))
    place = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)  # 25 and 5 rows by definition
    joined = line.join(order, line.l_orderkey == order.o_orderkey).join(part, line.l_partkey == part.p_partkey).join(supplier.join(F.broadcast(place), supplier.s_nationkey == place.n_nationkey), line.l_suppkey == supplier.s_suppkey)
    return joined.select(
        F.col("r_regionkey").cast("string").alias("category_id"), F.col("r_name").alias("product"), F.col("n_name").alias("place"),
        F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("pub_id"), F.col("p_type").alias("row_en"), F.col("p_brand").alias("col_en"),
        F.when(F.col("l_returnflag") == "A", "index").when(F.col("l_returnflag") == "R", "change").otherwise("value").alias("kind"),
        F.when((F.col("l_returnflag") == "A") & (F.year("o_orderdate") < 1998), "2018").otherwise("").alias("index_base"),
        F.date_format("l_shipdate", "yyyy-MM").alias("period"), F.col("l_quantity").alias("value"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
    )

"""Order lines as published facts with all columns, and with what drifts between releases: footnotes, languages, bases, debris."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import table

#: Orders the facts of one release; the last one of a series and period is the current reading.
RELEASE_ORDER = ("pub_id", "l_linenumber", "l_partkey", "l_suppkey", "value", "l_extendedprice")


def trade_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of one release an order; every fifth names its rows in Arabic only, odd orders state the base of their indices."""
    line, order, part, supplier, nation, region = (table(spark, sf_dir, n) for n in ("lineitem", "orders", "part", "supplier", "nation", "region"))
    place = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_regionkey", "r_name")  # 25 and 5 rows by definition
    home = supplier.join(F.broadcast(place), supplier.s_nationkey == place.n_nationkey).select("s_suppkey", "n_name", "r_regionkey", "r_name")
    lines = line.join(order, line.l_orderkey == order.o_orderkey).join(part, line.l_partkey == part.p_partkey).join(home, line.l_suppkey == home.s_suppkey)
    key, brand = F.col("o_orderkey"), F.col("p_brand")
    kind = F.when(F.col("l_returnflag") == "A", "index").when(F.col("l_returnflag") == "R", "change").when(F.col("l_linenumber") == 7, "weight").otherwise("value")
    footnote = F.when(key % 3 == 1, " ( 1 )").when(key % 3 == 2, "  *").otherwise("")
    arabic_only = key % 5 == 4
    steady = (kind == "index") & brand.rlike("[02468]$")  # such indices depend on their month alone, so bases agree
    rebased = brand.endswith("3") & (key % 10 == 1)
    source = F.concat(F.lit("order-"), (key % 100).cast("string"), F.lit(".xlsx"))
    return lines.select(
        F.col("r_regionkey").cast("string").alias("category_id"), F.col("r_name").alias("product"), F.lit("Trade").alias("domain"), F.lower("r_name").alias("subdomain"), F.col("n_name").alias("place"),
        F.lpad(key.cast("string"), 10, "0").alias("pub_id"), F.concat(F.col("o_orderpriority"), F.lit(" orders")).alias("release_title"),
        F.when(key % 2 == 0, "Table A").otherwise("TABLE  A").alias("table"),
        F.when(arabic_only, "").otherwise(F.concat("p_type", footnote)).alias("row_en"),
        F.when(arabic_only | (key % 2 == 0), F.concat(F.lit("نوع "), "p_type")).otherwise("").alias("row_ar"), brand.alias("col_en"), F.lit("").alias("col_ar"), kind.alias("kind"),
        F.when((F.col("l_linenumber") == 6) & (key % 11 == 0), "1900-01").otherwise(F.date_format("l_shipdate", "yyyy-MM")).alias("period"), F.lit("monthly").alias("period_type"),
        F.when((F.col("l_linenumber") == 5) & (key % 13 == 0), F.lit(None)).when(steady, 90.0 + F.month("l_shipdate")).otherwise(F.col("l_quantity")).alias("value"), F.col("l_tax").alias("weight_pct"),
        F.when(key % 2 == 0, "").when(rebased, "2023").otherwise("2018").alias("index_base"), F.sha2(source, 256).alias("source_sha256"), source.alias("source_file"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
    )


def trade_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links by category and digest, of which several may name the same file."""
    name = F.concat(F.lit("order-"), (F.col("page_id") % 100).cast("string"), F.lit(".xlsx"))
    return table(spark, sf_dir, "pages").select((F.col("page_id") % 5).cast("string").alias("category_id"), F.sha2(name, 256).alias("sha256"), "url")

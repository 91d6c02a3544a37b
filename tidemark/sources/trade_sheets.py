"""Sheets as statistics offices publish them, written from the trade tables: one for each supplier.

By the supplier's number modulo 3: a matrix of brands by quarters, a series down the quarters, or a sheet that no reader takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sinks.staging import staged
from tidemark.sources.tables import table

#: Quarter names in Arabic; the first year of the trade tables and the number of their quarters.
QUARTERS = ("الربع الأول", "الربع الثاني", "الربع الثالث", "الربع الرابع")
START, COUNT = 1995, 28


def _cell(r: Column | int, c: Column | int, value: Column | str) -> Column:
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(as_column(r).cast("int").alias("r"), as_column(c).cast("int").alias("c"), as_column(value).cast("string").alias("value"))


def trade_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long cells ``(sheet, name, r, c, value)``; the lines are read once for each form, all cells are made of their sums."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    supplier = table(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("sheet"), F.col("s_suppkey").alias("k"))
    line = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), "l_partkey", "l_returnflag", "l_quantity", ((F.year("l_shipdate") - START) * 4 + F.quarter("l_shipdate") - 1).alias("q"))
    matrix, series = line.where("k % 3 = 0"), line.where("k % 3 = 1")
    brands = part.select("p_brand").distinct()  # a few dozen by definition
    order = brands.agg(F.sort_array(F.collect_list("p_brand")).alias("all")).select(F.posexplode("all").alias("i", "p_brand"))
    at = F.col("i") + 6 + 2 * F.floor(F.col("i") / 10)
    sums = staged(matrix.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("k", "p_brand", "q").agg(F.sum("l_quantity").alias("v")), "sums")
    inner = sums.join(F.broadcast(order), "p_brand").select("k", F.array(_cell(at, F.col("q") + 2, F.col("v"))).alias("cells"))
    total = sums.groupBy("k", "q").agg(F.sum("v").alias("v")).select("k", F.array(_cell(5, F.col("q") + 2, F.col("v"))).alias("cells"))
    by_brand = sums.groupBy("k", "p_brand").agg(F.sum("v").alias("v"))
    suppliers = supplier.where("k % 3 = 0").select("k")
    every = suppliers.withColumn("all", F.lit(1)).join(F.broadcast(order.withColumn("all", F.lit(1))), "all").drop("all").join(by_brand, ["k", "p_brand"], "left")
    digits = F.substring("p_brand", 7, 5)
    labels = every.select("k", F.array(_cell(at, 0, F.concat("p_brand", F.lit(" علامة "), digits)), _cell(at, 1, F.concat(F.col("i") + 1, F.lit("-"))), _cell(at, COUNT + 2, F.coalesce("v", F.lit(0.0)))).alias("cells"))
    heads = [_cell(0, 0, F.concat(F.lit("Table 3.2: Quantity index of supplier "), "k", F.lit(" by brand (2018=100)"))), _cell(2, 2, "Index Numbers الأرقام القياسية"), _cell(4, COUNT + 2, "Total"), _cell(5, 0, "All brands كل العلامات")]
    heads += [_cell(3, 2 + 4 * y, str(START + y)) for y in range(COUNT // 4)]
    heads += [_cell(4, 2 + i, f"Q{i % 4 + 1}" if i // 4 % 2 == 0 else QUARTERS[i % 4]) for i in range(COUNT)]
    foot = F.col("_last") + 5
    ends = F.broadcast(order.agg((F.max(at)).alias("_last")))
    framed = suppliers.withColumn("all", F.lit(1)).join(ends.withColumn("all", F.lit(1)), "all").select("k", F.array(*heads, _cell(foot, 0, "Source: trade tables"), _cell(foot, 2, "1"), _cell(foot, 3, "2")).alias("cells"))
    flags = staged(series.groupBy("k", "q", "l_returnflag").agg(F.sum("l_quantity").alias("v")), "flags")
    column = F.when(F.col("l_returnflag") == "R", 2).when(F.col("l_returnflag") == "N", 3).otherwise(4)
    down = flags.select("k", F.array(_cell(F.col("q") + 2, column, F.col("v"))).alias("cells"))
    year = F.floor(F.col("q") / 4) + START
    times = flags.select("k", "q").distinct().select("k", F.array(_cell(F.col("q") + 2, 0, F.concat(year, F.when(year == 2001, "*").otherwise(""))), _cell(F.col("q") + 2, 1, F.concat(F.lit("Q"), F.col("q") % 4 + 1))).alias("cells"))
    names = ("Year", "Quarter", "Returned quantity المرتجع", "Change in open quantity", "Accepted index")
    topped = supplier.where("k % 3 = 1").select("k", F.array(_cell(0, 0, "Quarterly quantities by state, at constant prices"), *(_cell(1, c, n) for c, n in enumerate(names))).alias("cells"))
    notes = supplier.where("k % 6 = 2").select("k", F.array(_cell(0, 0, "Notes"), _cell(2, 0, F.concat(F.lit("Supplier "), "k")), _cell(3, 1, "1")).alias("cells"))
    codes = supplier.where("k % 6 = 5").select("k", F.array(_cell(0, 0, "h"), *(_cell(r, c, "only" if c == 0 else str(r + c)) for r in (1, 2, 3) for c in range(3))).alias("cells"))
    parts = [inner, total, labels, framed, down, times, topped, notes, codes]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.union(p)
    name = F.concat(F.lit("S"), F.col("k"))
    return whole.select(name.alias("sheet"), name.alias("name"), F.inline("cells"))


def level_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long cells of one indicator table a supplier: level, label in two columns, weight, two index months and their change.

    Every fifth supplier's sheet has no index heading, every seventh's no level column.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    line = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_suppkey").alias("k"), "p_brand", "l_quantity", F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    month = lambda m: F.sum(F.when(F.col("month") == m, F.col("l_quantity")).otherwise(0.0))
    sums = line.groupBy("k", "p_brand").agg(F.sum("l_quantity").alias("w"), month("2000-01").alias("a"), month("2000-02").alias("b"))
    rows = sums.withColumn("i", F.row_number().over(Window.partitionBy("k").orderBy("p_brand")))  # a few dozen rows a supplier
    at, digits = F.col("i") + 6 + 2 * F.floor(F.col("i") / 10), F.substring("p_brand", 7, 5)
    body = rows.select("k", F.array(_cell(at, 0, F.col("i") % 3 + 1), _cell(at, 1, F.concat(F.lit("Brand "), digits)), _cell(at, 2, F.concat(F.lit("علامة "), digits)), _cell(at, 3, F.col("w")), _cell(at, 4, F.col("a")), _cell(at, 5, F.col("b")), _cell(at, 6, F.col("b") - F.col("a"))).alias("cells"))
    suppliers = sums.groupBy("k").agg(F.sum("w").alias("w"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    level = F.when(F.col("k") % 7 == 0, "Code").otherwise("Level الدرجة")
    group = F.when(F.col("k") % 5 == 0, "Percent change").otherwise("Index numbers الأرقام القياسية")
    heads = [_cell(0, 0, "Monthly index of quantities, all suppliers and brands"), _cell(2, 4, group), _cell(2, 6, "Percent change"), _cell(3, 3, "Relative weight"), _cell(3, 4, "2000"), _cell(4, 0, level), _cell(4, 1, "Name"), _cell(4, 4, "January"), _cell(4, 5, "فبراير"), _cell(4, 6, "February")]
    total = [_cell(5, 0, "0"), _cell(5, 1, "All brands"), _cell(5, 2, "كل العلامات"), _cell(5, 3, F.col("w")), _cell(5, 4, F.col("a")), _cell(5, 5, F.col("b")), _cell(5, 6, F.col("b") - F.col("a"))]
    framed = suppliers.select("k", F.array(*heads, *total).alias("cells"))
    name = F.concat(F.lit("S"), F.col("k"))
    return body.union(framed).select(name.alias("sheet"), name.alias("name"), F.inline("cells"))

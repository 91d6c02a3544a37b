"""Facts to a star schema with revisions, and the quality rules over its series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.labels import fold, ident, joined_key

#: A total order of the readings of one series and period: the latest release, then the last row in it.
LATEST_FIRST = ("pub_id", "l_linenumber", "l_partkey", "l_suppkey", "value", "l_extendedprice")


def admitted(facts: DataFrame, first: int = 1960, last: int = 2035) -> DataFrame:
    """Facts with a period of a plausible year, a value and a label in either language."""
    plausible = F.col("period").rlike("^[0-9]{4}") & F.substring("period", 1, 4).between(f"{first:04d}", f"{last:04d}")
    named = (F.coalesce("row_en", F.lit("")) != "") | (_optional(facts, "row_ar") != "")
    return facts.where(F.col("value").isNotNull() & named & plausible)


def _optional(facts: DataFrame, name: str) -> Column:
    """A column, empty for null, or where the facts have none of that name."""
    return F.coalesce(F.col(name), F.lit("")) if name in facts.columns else F.lit("")


def keyed(facts: DataFrame) -> DataFrame:
    """Adds ``measure_key`` (what is measured) and ``series_key`` (on which base).

    Labels are folded first, so that a footnote, a star or capitals don't cut a series in pieces; Arabic ones count only
    where English ones are empty. ``row_ar``, ``col_ar`` and ``table`` may be absent.
    """
    row, col = (ident(_optional(facts, f"{side}_en"), _optional(facts, f"{side}_ar")) for side in ("row", "col"))
    parts = [F.col("category_id"), row, col, _optional(facts, "kind")]
    if "table" in facts.columns:
        parts.append(F.coalesce(fold(F.col("table")), F.lit("")))
    return facts.withColumn("measure_key", joined_key(*parts)).withColumn("series_key", joined_key(F.col("measure_key"), _optional(facts, "index_base")))


def ranked(readings: DataFrame, order: tuple[str, ...] = LATEST_FIRST) -> DataFrame:
    """Adds ``rn``: 1 for the current reading of a series and period, then superseded ones, newest first."""
    window = Window.partitionBy("series_key", "period").orderBy(*(F.desc(c) for c in order))
    return readings.withColumn("rn", F.row_number().over(window))


def latest(readings: DataFrame) -> DataFrame:
    return ranked(readings).where("rn = 1").drop("rn")


def revisions(readings: DataFrame) -> DataFrame:
    return ranked(readings).where("rn > 1").withColumnRenamed("rn", "revision_age")


def base_merge(readings: DataFrame, tolerance: float = 0.001, least: int = 2) -> DataFrame:
    """``(measure_key, base)``: measures whose points without a base agree with those of their only declared base.

    One pass over the readings: both sides of a period are brought together by one aggregate, then periods by measure.
    """
    blank = F.coalesce("index_base", F.lit("")) == ""
    sides = readings.groupBy("measure_key", "period").agg(
        F.max(F.when(blank, F.col("value"))).alias("b"), F.max(F.when(~blank, F.col("value"))).alias("k"),
        F.min(F.when(~blank, F.col("index_base"))).alias("base"), F.max(F.when(~blank, F.col("index_base"))).alias("other"),
    )
    close = F.abs(F.col("b") - F.col("k")) <= tolerance * F.greatest(F.abs("k"), F.lit(1.0))
    both = F.col("b").isNotNull() & F.col("k").isNotNull()
    agreed = sides.groupBy("measure_key").agg(F.min("base").alias("base"), F.max("other").alias("other"), F.count_if(both).alias("shared"), F.count_if(both & close).alias("near"))
    return agreed.where((F.col("base") == F.col("other")) & (F.col("shared") >= least) & (F.col("near") == F.col("shared"))).select("measure_key", "base")


def with_base(readings: DataFrame, merged: DataFrame) -> DataFrame:
    """Adds ``base_norm``: none but for indices, the declared base, or the one that a blank reading was merged into.

    Give ``merged`` as a table of files: Spark then knows that it is small, and readings meet it without an exchange.
    """
    base = F.when(F.col("kind") != "index", "").when(F.col("index_base") != "", F.col("index_base")).otherwise(F.coalesce("base", F.lit("")))
    return readings.join(merged, "measure_key", "left").withColumn("base_norm", base).drop("base")


def span(readings: DataFrame) -> DataFrame:
    return readings.groupBy("series_key").agg(F.count("*").alias("n_points"), F.min("period").alias("first_period"), F.max("period").alias("last_period"))


def coverage(readings: DataFrame) -> DataFrame:
    return readings.groupBy("category_id", "product").agg(F.count_distinct("series_key").alias("n_series"), F.count("*").alias("n_obs"), F.min("period").alias("first_period"), F.max("period").alias("last_period"), F.count_distinct("pub_id").alias("n_releases"))


def suspect(points: DataFrame, keys: list[str], low: float = 10.0, high: float = 50.0, least: int = 3) -> DataFrame:
    """Series that mix magnitudes: a minimum below ``low`` and a maximum above ``high``."""
    return points.groupBy(*keys).agg(F.min("value").alias("min_value"), F.max("value").alias("max_value"), F.count("*").alias("n_points")).where((F.col("min_value") < low) & (F.col("max_value") > high) & (F.col("n_points") >= least))


def ambiguous(readings: DataFrame) -> DataFrame:
    """Series with more than one value for some period, before superseded readings go."""
    cells = readings.groupBy("series_key", "period").agg(F.count_distinct(F.round("value", 3)).alias("n"))
    return cells.groupBy("series_key").agg(F.max("n").alias("max_distinct"), F.count_if(F.col("n") > 1).alias("n_periods_ambiguous")).where("max_distinct > 1")


def chartable(readings: DataFrame, suspects: DataFrame, doubtful: DataFrame, hidden: str = "change", least: int = 3) -> DataFrame:
    """Series of enough points that vary and are neither hidden by kind, suspect nor ambiguous."""
    flags = readings.groupBy("series_key", "kind").agg(F.count("*").alias("n_points"), F.min("value").alias("low"), F.max("value").alias("high"))
    fit = flags.where((F.col("n_points") >= least) & (F.col("kind") != hidden) & (F.col("low") != F.col("high")))
    return fit.join(suspects, "series_key", "left_anti").join(doubtful, "series_key", "left_anti").select("series_key", "kind", "n_points")


def chartable_at_once(readings: DataFrame, low: float, high: float, doubtful: int, order: tuple[str, ...] = LATEST_FIRST, hidden: str = "change", least: int = 3) -> DataFrame:
    """``chartable`` from one pass: periods are brought together with their current value, then series.

    Left out are series that mix magnitudes (see ``suspect``) and those of which more than ``doubtful`` periods have several values.
    """
    rounded = F.round("value", 3)
    cells = readings.groupBy("series_key", "kind", "period").agg(F.max_by("value", F.struct(*order)).alias("value"), (F.min(rounded) != F.max(rounded)).alias("several"))
    found = cells.groupBy("series_key", "kind").agg(F.count("*").alias("n_points"), F.min("value").alias("low"), F.max("value").alias("high"), F.count_if("several").alias("n"))
    enough = F.col("n_points") >= least
    fit = enough & (F.col("kind") != hidden) & (F.col("low") != F.col("high")) & (F.col("n") <= doubtful)
    return found.where(fit & ~((F.col("low") < low) & (F.col("high") > high))).select("series_key", "kind", "n_points")


def place_coverage(facts: DataFrame, least: int = 8) -> DataFrame:
    """Metrics and periods that at least so many places report."""
    return facts.groupBy("row_en", "kind", "period").agg(F.count_distinct("place").alias("n_places")).where(F.col("n_places") >= least)


def top(rows: DataFrame, by: list[str], order: list[Column], n: int, name: str = "rn") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= n)


def guaranteed(rows: DataFrame, by: str, ranks: list[Column], fresh: list[Column], long: list[Column], cap: int = 45) -> DataFrame:
    """The first of a ranking, with the freshest and the longest series sure of a slot."""
    window = Window.partitionBy(by)
    place = rows.select("*", F.row_number().over(window.orderBy(*ranks)).alias("place"), F.row_number().over(window.orderBy(*fresh)).alias("_fresh"), F.row_number().over(window.orderBy(*long)).alias("_long"))
    sure = (F.col("_fresh") == 1) | (F.col("_long") == 1)
    slots = F.row_number().over(window.orderBy(F.when(sure, 0).otherwise(1), "place"))
    return place.withColumn("_sure", sure).withColumn("_slot", slots).where(F.col("_slot") <= cap).select(*rows.columns, "place", F.col("_sure").alias("guaranteed"))

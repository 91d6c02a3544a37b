"""Sheets with a level column, read by recipes: a sheet's shape is its fingerprint, the first recipe that claims it reads it.

Recipes are rows of a rule table; what none claims, or a recipe can't honestly read, is a reject with its reason.  The
value column of an indicator table is the index column whose own heading names the wanted period, never one by place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import cells as C
from tidemark.functions.labels import normalized
from tidemark.operators.sheets import BLANKS, HEADER, TITLE
from tidemark.sinks.staging import staged

# Words that name the level column, and those of headings, folded.
LEVEL = "level|الدرجة"
WEIGHT, INDEX, CHANGE = "weight|وزن|الاوزان|الاهميه", "index|الارقام القياسيه|الرقم القياسي|القياسيه|القياسي", "change|تغير|معدل|نسبه التغير"
#: Rows looked at for the level column, and for labels; columns that may hold labels; distinct labels of a second language.
TOP, LOOK, LABELS, OTHER = 20, 60, 8, 5


def fingerprints(cells: DataFrame) -> DataFrame:
    """``(sheet, has_level, header_start, first, label_col, n_numeric, shape)`` of each sheet of ``typed`` cells; parts that a sheet lacks are null."""
    lines = cells.groupBy("sheet", "r").agg(
        F.lower(F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("c") < 4, F.struct("c", "t")))), lambda x: x["t"]), " ")).alias("joined"),
        F.max(F.when(F.col("c") == 0, F.col("x"))).alias("level"), F.count("*").alias("filled"), F.max(F.length("t")).alias("longest"), F.count("x").alias("numbers"), F.max("c").alias("widest"),
    )
    whole = Window.partitionBy("sheet")
    lines = lines.withColumn("header_row", F.min(F.when((F.col("r") < TOP) & F.col("joined").rlike(LEVEL), F.col("r"))).over(whole))
    data = (F.col("level") == F.floor("level")) & F.col("level").between(0, 9) & (F.col("r") > F.coalesce("header_row", F.lit(-1)))
    lines = lines.withColumn("first", F.min(F.when(data, F.col("r"))).over(whole))
    above = F.col("r").between(F.col("first") - HEADER, F.col("first") - 1)
    title = F.max(F.when(above & (F.col("filled") == 1) & (F.col("longest") > TITLE), F.col("r"))).over(whole)
    lines = lines.withColumn("_title", title)
    shaped = lines.groupBy("sheet").agg(
        F.max("header_row").isNotNull().alias("has_level"), F.max("first").alias("first"), F.coalesce(F.min(F.when(above & (F.col("r") > F.coalesce("_title", F.lit(-1))), F.col("r"))), F.max("first")).alias("header_start"),
        F.coalesce(F.max(F.when(F.col("r") == F.col("first"), F.col("numbers"))), F.lit(0)).alias("n_numeric"),
    )
    near = cells.join(shaped.select("sheet", "first"), "sheet").where((F.col("r") >= F.col("first")) & (F.col("r") < F.col("first") + LOOK) & F.col("c").between(1, LABELS - 1) & F.col("x").isNull())
    named = near.groupBy("sheet", "c").agg(F.count_distinct("t").alias("n")).groupBy("sheet").agg(F.max(F.struct("n", (-F.col("c")).alias("c"))).alias("best")).where("best.n >= 2").select("sheet", (-F.col("best.c")).alias("label_col"))
    out = shaped.join(named, "sheet", "left")
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    shape = F.concat(F.lit("h"), said("header_start"), F.lit("-"), said("first"), F.lit("/l"), said("label_col"), F.lit("/n"), F.col("n_numeric"), F.lit("/"), F.col("has_level").cast("int"))
    return out.select("sheet", "has_level", "header_start", "first", "label_col", "n_numeric", shape.alias("shape"))


#: Recipes in the order in which they are asked.
RECIPES: list[tuple[str, Column | str]] = [("indicator-table-v1", "has_level and first is not null and label_col is not null and n_numeric >= 2")]


def claimed(shapes: DataFrame, recipes: list[tuple[str, Column | str]] | None = None) -> DataFrame:
    """Adds ``recipe``, the first that claims the fingerprint; null where none does."""
    rules = [(n, F.expr(c) if isinstance(c, str) else c) for n, c in (RECIPES if recipes is None else recipes)]
    return shapes.withColumn("recipe", F.coalesce(*(F.when(c, n) for n, c in rules)) if rules else F.lit(None).cast("string"))


def column_headings(cells: DataFrame, shapes: DataFrame) -> DataFrame:
    """``(sheet, c, label, own, period)`` of each column below a header: all headings it stands under, those it owns, and its period.

    A year counts where it is inherited too, a month only in the column's own cell; a date decides at once.  A period of a year alone is ``YYYY``.
    """
    head = cells.join(shapes.select("sheet", "header_start", "first"), "sheet")
    lines = head.where((F.col("r") >= F.col("header_start")) & (F.col("r") < F.col("first"))).groupBy("sheet", "r").agg(F.sort_array(F.collect_list(F.struct("c", "t"))).alias("line"))
    columns = head.where(F.col("r") == F.col("first")).select("sheet", "c")
    spread = columns.join(lines, "sheet").withColumn("cell", F.try_element_at(F.filter("line", lambda x: x["c"] <= F.col("c")), F.lit(-1))).where("cell is not null")
    folded = normalized(F.col("cell.t"))
    owned = F.col("cell.c") == F.col("c")
    date = F.when(owned, F.nullif(F.regexp_extract("cell.t", r"^(\d{4}-\d{2})-\d{2}\z", 1), F.lit("")))
    begun = F.coalesce(*(F.when(folded.rlike(rf"(?<![\p{{L}}])(?:{'|'.join(names)})"), n) for n, names in enumerate(C.MONTH_NAMES, 1)))
    said = spread.select("sheet", "c", "r", folded.alias("t"), owned.alias("owned"), date.alias("date"), F.regexp_extract(folded, r"(?<!\d)((?:19|20)\d{2})(?!\d)", 1).try_cast("int").alias("y"), F.when(owned, begun).alias("m"))
    stacked = said.groupBy("sheet", "c").agg(F.sort_array(F.collect_list(F.struct("r", "t", "owned", "date", "y", "m"))).alias("h"))
    last = lambda of: F.try_element_at(F.filter(F.transform("h", lambda x: x[of]), lambda v: v.isNotNull()), F.lit(-1))
    first_date = F.try_element_at(F.filter(F.transform("h", lambda x: x["date"]), lambda v: v.isNotNull()), F.lit(1))
    spelt = F.concat(last("y").cast("string"), F.coalesce(F.concat(F.lit("-"), F.lpad(last("m").cast("string"), 2, "0")), F.lit("")))
    texts = lambda rows: F.array_join(F.transform(rows, lambda x: x["t"]), " | ")
    return stacked.select("sheet", "c", texts(F.col("h")).alias("label"), texts(F.filter("h", lambda x: x["owned"])).alias("own"), F.coalesce(first_date, spelt).alias("period"))


def _other_language(cells: DataFrame, shapes: DataFrame) -> DataFrame:
    """``(sheet, alt_col)``: a second column of labels, mostly in the other script."""
    near = cells.join(shapes.select("sheet", "first", "label_col"), "sheet").where((F.col("r") >= F.col("first")) & (F.col("r") < F.col("first") + LOOK))
    arabic = F.col("t").rlike("[؀-ۿ]")
    rows = near.groupBy("sheet").agg(F.count_if((F.col("c") == F.col("label_col")) & arabic).alias("n"), (F.max("r") - F.min("first") + 1).alias("rows"))
    columns = near.where((F.col("c") > 0) & (F.col("c") != F.col("label_col")) & F.col("x").isNull()).groupBy("sheet", "c").agg(F.count_distinct("t").alias("distinct"), F.count_distinct(F.when(arabic, F.col("t"))).alias("arabic"))
    fit = columns.where(F.col("distinct") >= OTHER).join(rows, "sheet").where((2 * F.col("arabic") > F.col("distinct")) != (4 * F.col("n") > F.col("rows")))
    return fit.groupBy("sheet").agg((-F.max(F.struct("distinct", (-F.col("c")).alias("c")))["c"]).alias("alt_col"))


def read_recipes(cells: DataFrame, want: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Observations ``(sheet, level, label_en, label_ar, weight, value, column)`` and rejects ``(sheet, reason)`` of ``typed`` cells.

    ``want(sheet, period)`` names the period to read, ``YYYY-MM`` or ``YYYY``; without it the last index column is read.  Each
    sheet has observations or one reject; an empty table gives neither.
    """
    cells = staged(cells.select("sheet", "r", "c", "t", "x"), "cells")
    shapes = staged(claimed(fingerprints(cells)), "shapes")
    mine = shapes.where("recipe is not null")
    heads = staged(column_headings(cells, mine).join(mine.select("sheet", "label_col"), "sheet"), "headings")
    weight = heads.where((F.col("c") > F.col("label_col")) & F.col("own").rlike(WEIGHT)).groupBy("sheet").agg(F.min("c").alias("weight_col"))
    first = cells.join(mine.select("sheet", "first", "label_col"), "sheet").where((F.col("r") == F.col("first")) & (F.col("c") > F.col("label_col")) & F.col("x").isNotNull())
    numeric = first.select("sheet", "c").join(weight, "sheet", "left").where(~F.col("c").eqNullSafe(F.col("weight_col"))).join(heads.select("sheet", "c", "label", "period"), ["sheet", "c"], "left")
    index = numeric.where(F.coalesce(F.col("label").rlike(INDEX), F.lit(False)) | (F.coalesce("label", F.lit("")) == ""))
    asked = mine.select("sheet").join(want.select("sheet", F.col("period").alias("want")), "sheet", "left") if want is not None else mine.select("sheet", F.lit(None).cast("string").alias("want"))
    held = index.join(asked, "sheet").groupBy("sheet", "want").agg(F.min(F.when(F.col("period") == F.col("want"), F.col("c"))).alias("named"), F.max("c").alias("last"))
    chosen = held.select("sheet", F.when(F.col("want").isNull(), F.col("last")).otherwise(F.col("named")).alias("current")).where("current is not null")
    plan = staged(mine.select("sheet", "first", "label_col").join(chosen, "sheet").join(weight, "sheet", "left").join(_other_language(cells, mine), "sheet", "left"), "plan")
    at = lambda c: F.max(F.when(F.col("c") == F.col(c), F.struct("t", "x")))
    rows = cells.join(plan, "sheet").where(F.col("r") >= F.col("first")).groupBy("sheet", "r").agg(F.max(F.when(F.col("c") == 0, F.col("x"))).alias("level"), at("label_col").alias("a"), at("alt_col").alias("b"), at("weight_col").alias("w"), at("current").alias("v"), F.max("current").alias("column"))
    order = Window.partitionBy("sheet").orderBy("r")
    numbered = rows.where("level is not null").withColumn("_gap", F.coalesce((F.col("r") - F.lag("r").over(order) > BLANKS).cast("int"), F.lit(0))).withColumn("_island", F.sum("_gap").over(order)).where("_island = 0")
    spelt = numbered.withColumns({"a": C.bilingual(F.col("a.t")), "b": C.bilingual(F.col("b.t"))})
    either = lambda of: F.coalesce(F.nullif(F.col(f"a.{of}"), F.lit("")), F.col(f"b.{of}"), F.lit(""))
    out = spelt.where(F.col("level") == F.floor("level")).select("sheet", F.col("level").cast("int").alias("level"), either("en").alias("label_en"), either("ar").alias("label_ar"), F.col("w.x").alias("weight"), F.col("v.x").alias("value"), "column")
    out = staged(out.where("value is not null and (label_en <> '' or label_ar <> '')"), "observations")
    counted = lambda df, name: df.groupBy("sheet").agg(F.count("*").alias(name))
    state = shapes.join(counted(out, "n"), "sheet", "left").where("n is null").join(counted(numeric, "numeric"), "sheet", "left").join(counted(index, "index"), "sheet", "left").join(plan.select("sheet", "current"), "sheet", "left").join(asked, "sheet", "left")
    reason = (
        F.when(F.col("recipe").isNull(), F.concat(F.lit("no recipe claims shape "), "shape")).when(F.col("numeric").isNull(), "no numeric value columns").when(F.col("index").isNull(), "no index columns (all under a percent-change heading)")
        .when(F.col("current").isNull(), F.concat(F.lit("no index column for period "), "want")).otherwise("data block parsed to zero rows")
    )
    return out, state.select("sheet", reason.alias("reason"))

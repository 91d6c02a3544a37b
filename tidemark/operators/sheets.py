"""Irregular sheets to facts, over long cells ``(sheet, name, r, c, value)``.

A sheet is a matrix (labels down, measures across, periods in the headings or of the release) or a row-series (the
period runs down the first columns).  Everything is grouping, windows and joins by sheet: a block of data is an island of
rows with numbers, tolerant of gaps; headings are filled along their row and folded down their column; a sheet that
neither form can take is a reject with its reason.  So each sheet gives facts or exactly one reject.

Work is spread by sheet and, for cells, by sheet and row; what is gathered for one sheet are its headings and the
distinct labels of a column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import cells as C
from tidemark.functions.labels import normalized
from tidemark.sinks.staging import staged

#: Blank rows that end a block; header rows looked at above it; columns that may hold row labels, or the time axis.
BLANKS, HEADER, LABELS, AXIS = 4, 14, 8, 4
#: A lone cell of more characters is a title, not a heading.
TITLE = 30
FACTS = ("sheet", "recipe", "row_en", "row_ar", "col_en", "col_ar", "kind", "period", "value", "weight", "index_base")


def typed(cells: DataFrame) -> DataFrame:
    """``(sheet, name, r, c, t, x, p)``: text and number of each cell that isn't blank, and its ``period_part`` in columns that may be the axis."""
    texts = cells.select("sheet", "name", "r", "c", C.text(F.col("value")).alias("t")).where("t <> ''")
    return texts.select("*", C.number_in(F.col("t")).alias("x"), F.when(F.col("c") < AXIS, C.period_part_in(F.col("t"))).alias("p"))


def bounds(cells: DataFrame) -> DataFrame:
    """``(sheet, header_start, first, last)`` of the data block of each sheet that has one, from ``typed`` cells.

    It begins at the first row with two numbers and a label among its first columns, and ends before ``BLANKS`` rows without a
    number.  The header reaches up at most ``HEADER`` rows, to below a title, without blank rows at its top.
    """
    rows = cells.groupBy("sheet", "r").agg(
        F.count("*").alias("filled"), F.count("x").alias("numbers"), F.max((F.col("c") < 6) & F.col("x").isNull()).alias("labelled"), F.max(F.length("t")).alias("longest"),
    )
    whole, ordered = Window.partitionBy("sheet"), Window.partitionBy("sheet").orderBy("r")
    rows = rows.withColumn("first", F.min(F.when((F.col("numbers") >= 2) & F.col("labelled"), F.col("r"))).over(whole)).where("first is not null")
    in_block = (F.col("numbers") >= 1) & (F.col("r") >= F.col("first"))
    before = F.max(F.when(in_block, F.col("r"))).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    cut = F.when(in_block & (F.col("r") - before > BLANKS), F.col("r"))
    title = (F.col("filled") == 1) & (F.col("longest") > TITLE) & F.col("r").between(F.col("first") - HEADER, F.col("first") - 1)
    rows = rows.withColumn("_cut", cut).withColumn("_title", F.when(title, F.col("r")))
    ends = rows.groupBy("sheet", "first").agg(F.min("_cut").alias("_cut"), F.max("_title").alias("_title"), F.sort_array(F.collect_list(F.when(in_block, F.col("r")))).alias("_rows"), F.sort_array(F.collect_list(F.when(F.col("r") < F.col("first"), F.col("r")))).alias("_above"))
    last = F.array_max(F.filter("_rows", lambda r: F.col("_cut").isNull() | (r < F.col("_cut"))))
    top = F.greatest(F.col("first") - HEADER, F.col("_title") + 1)
    start = F.coalesce(F.array_min(F.filter("_above", lambda r: r >= top)), F.col("first"))
    return ends.select("sheet", start.alias("header_start"), "first", last.alias("last"))


def blocks(cells: DataFrame) -> DataFrame:
    """``bounds`` with ``label_col``, ``alt_col`` and ``value_cols``; null or empty where the sheet has none.

    Row labels are the column whose distinct texts read most as names; a second column of labels is one in the other
    script, or else beside it.  Value columns have numbers in a fifth of the rows.
    """
    found = bounds(cells)
    body = cells.join(found, "sheet").where(F.col("r").between(F.col("first"), F.col("last")))
    words = F.when(F.col("x").isNull(), F.col("t"))
    whole_year = F.when((F.col("x") == F.floor("x")) & F.col("x").between(1960, 2035), 1)
    stats = body.groupBy("sheet", "header_start", "first", "last", "c").agg(
        F.collect_set(words).alias("texts"), F.count(words).alias("n_texts"), F.count(F.when(words.rlike(C.ARABIC.replace("ﭐ-﻿", "")), 1)).alias("n_arabic"),
        F.count("x").alias("numbers"), F.count(whole_year).alias("years"), F.count("p").alias("periods"),
    )
    name = lambda v: v.rlike(C.LETTER) & (v.contains(" ") | (F.length(F.regexp_replace(v, r"^[ .)(\-:،]+|[ .)(\-:،]+\z", "")) > 3))
    one = stats.select(
        "sheet", "header_start", "first", "last",
        F.struct(
            "c", F.size("texts").alias("distinct"), F.size(F.filter("texts", name)).alias("named"), F.size(F.filter("texts", lambda v: v.rlike(C.LETTER))).alias("lettered"),
            (2 * F.col("n_arabic") > F.col("n_texts")).alias("arabic"), "numbers", "years", "periods",
        ).alias("column"),
    )
    sheets = one.groupBy("sheet", "header_start", "first", "last").agg(F.sort_array(F.collect_list("column")).alias("columns"))
    first_of = lambda columns, key: F.try_element_at(F.array_sort(F.transform(columns, lambda x: F.struct(*key(x), x["c"].alias("c"), x.alias("x")))), F.lit(1))["x"]
    able = F.filter("columns", lambda x: (x["c"] < LABELS) & ((x["named"] > 0) | (x["distinct"] > 0)))
    labelled = sheets.withColumn("_label", first_of(able, lambda x: ((-x["named"]).alias("a"), (-x["distinct"]).alias("b"))))
    labelled = labelled.withColumn("_label", F.when(F.col("_label.distinct") >= 2, F.col("_label")))
    enough = lambda x: (x["c"] != F.col("_label.c")) & (x["distinct"] >= F.greatest(F.lit(3), F.floor(F.col("_label.distinct") / 3)))
    most = lambda columns: first_of(columns, lambda x: ((-x["distinct"]).alias("a"),))
    other = most(F.filter("columns", lambda x: enough(x) & (x["arabic"] != F.col("_label.arabic"))))
    beside = most(F.filter("columns", lambda x: enough(x) & (x["arabic"] == F.col("_label.arabic")) & (F.abs(x["c"] - F.col("_label.c")) <= 2) & (x["lettered"] >= 2)))
    rows = F.col("last") - F.col("first") + 1
    placed = labelled.withColumn("label_col", F.col("_label.c")).withColumn("alt_col", F.coalesce(other["c"], beside["c"]))
    value = lambda x: (x["c"] != F.col("label_col")) & ~x["c"].eqNullSafe(F.col("alt_col")) & (x["numbers"] >= F.greatest(F.lit(2), F.floor(rows / 5)))
    axis = F.transform(F.filter("columns", lambda x: (x["c"] < AXIS) & (x["periods"] >= F.greatest(F.lit(3.0), 0.6 * rows))), lambda x: x["c"])
    held = placed.withColumn("_values", F.filter("columns", value)).withColumn("axis", axis)
    yearly = lambda x: (x["numbers"] >= 3) & (x["years"] >= 0.9 * x["numbers"])
    return held.select(
        "sheet", "header_start", "first", "last", "label_col", "alt_col", "axis",
        F.transform(F.filter("_values", lambda x: ~(yearly(x) & (x["c"] < 3))), lambda x: x["c"]).alias("value_cols"),
        F.transform(F.filter("_values", yearly), lambda x: x["c"]).alias("year_cols"),
    )


def _said(cells: DataFrame) -> DataFrame:
    """What each different text of headings says: sheets repeat them, so each is read once."""
    folded = normalized(F.col("t"))
    found = cells.select("t").distinct().select("t", C.is_caption(F.col("t")).alias("caption"), C.bilingual(F.col("t")).alias("w"), C.year(folded).alias("y"), C.month(folded).alias("m"), C.quarter(folded).alias("q"), C.period(F.col("t")).alias("own"))
    return staged(found, "said")


def headings(cells: DataFrame, found: DataFrame) -> DataFrame:
    """``(sheet, c, en, ar, period, text)`` of each value column: its headings stacked down, and the period that they state.

    A cell that spans columns stands in the first of them, so each row is filled from the left.  A year may be inherited, a
    month or quarter only together with a year; a bare year is a column's period only if nothing below says more.
    """
    rows = cells.join(found.select("sheet", "header_start", "first"), "sheet").where((F.col("r") >= F.col("header_start")) & (F.col("r") < F.col("first")))
    rows = staged(rows.select("sheet", "r", "c", "t"), "header")
    read = ("t", "caption", "w", "y", "m", "q", "own")
    lines = rows.join(_said(rows), "t").groupBy("sheet", "r").agg(F.sort_array(F.collect_list(F.struct("c", *read))).alias("line"))
    columns = found.select("sheet", F.explode("value_cols").alias("c"))
    spread = columns.join(lines, "sheet").withColumn("cell", F.try_element_at(F.filter("line", lambda x: x["c"] <= F.col("c")), F.lit(-1))).where("cell is not null")
    spread = spread.select("sheet", "c", "r", *(F.col(f"cell.{x}").alias(x) for x in read), (F.col("cell.c") == F.col("c")).alias("owned"))
    dated = F.col("owned") | F.col("y").isNotNull()
    said = spread.select("sheet", "c", "r", "t", "caption", "w", "y", F.when(dated, F.col("m")).alias("m"), F.when(dated, F.col("q")).alias("q"), F.when(F.col("owned"), F.col("own")).alias("own"))
    stacked = said.groupBy("sheet", "c").agg(F.sort_array(F.collect_list(F.struct("r", "t", "caption", "w", "y", "m", "q", "own"))).alias("h"))
    kept = F.filter("h", lambda x: ~x["caption"])
    parts = lambda of: F.array_distinct(F.filter(F.transform(kept, lambda x: x["w"][of]), lambda p: p != ""))
    label = lambda of: C.without_caption(F.array_join(C.not_restated(parts(of)), " "))
    owns = F.filter(F.transform("h", lambda x: x["own"]), lambda p: p.isNotNull())
    exact, annual = F.try_element_at(F.filter(owns, lambda p: F.length(p) > 4), F.lit(1)), F.try_element_at(owns, F.lit(1))
    none = F.lit(None).cast("int")
    start = F.struct(none.alias("y"), none.alias("m"), none.alias("q"))

    def step(s: Column, x: Column) -> Column:
        y = F.coalesce(x["y"], s["y"])
        return F.when(s["q"].isNotNull(), s).otherwise(F.struct(y.alias("y"), F.coalesce(x["m"], s["m"]).alias("m"), x["q"].alias("q")))

    read = F.aggregate("h", start, step)
    joined = F.when(read["q"].isNotNull(), F.coalesce(F.concat(read["y"].cast("string"), F.lit("-Q"), read["q"].cast("string")), annual)).when(
        read["y"].isNotNull(), F.concat(read["y"].cast("string"), F.coalesce(F.concat(F.lit("-"), F.lpad(read["m"].cast("string"), 2, "0")), F.lit("")))
    ).otherwise(annual)
    return stacked.select("sheet", "c", label("en").alias("en"), label("ar").alias("ar"), F.coalesce(exact, joined).alias("period"), normalized(F.array_join(F.transform("h", lambda x: x["t"]), " ")).alias("text"))


def read_sheets(cells: DataFrame, fallback: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Facts (``FACTS``) and rejects ``(sheet, reason)`` of long cells; each sheet has facts or one reject.

    ``cells`` are ``(sheet, name, r, c, value)`` with 0-based places; null values, blank cells and absent rows are the same.
    ``fallback(sheet, period)`` dates matrix columns whose headings don't.  An empty table gives neither; a null sheet id is no sheet; other
    columns are not read.
    """
    sheets = cells.where("sheet is not null").groupBy("sheet").agg(F.first("name").alias("name"))
    some = staged(typed(cells.where("sheet is not null")), "cells")
    base = some.where("r < 16").select("sheet", "r", "c", C.index_base(F.col("t")).alias("b")).where("b is not null").groupBy("sheet").agg(F.min_by("b", F.struct("r", "c")).alias("index_base"))
    found = staged(blocks(some), "blocks")
    over = headings(some, found)
    # a year column further right is an axis only if its heading says so
    yearly = found.select("sheet", F.explode("year_cols").alias("c")).withColumn("_year", F.lit(True))
    named = over.join(yearly, ["sheet", "c"], "left").where(F.col("_year").isNull() | ~F.col("text").rlike("year|سنه|العام"))
    body = some.select("sheet", "r", "c", "t", "x", "p").join(found, "sheet").where(F.col("r").between(F.col("first"), F.col("last")))
    # periods down the rows
    spans = body.where((F.size("axis") > 0) & F.col("c").between(F.array_min("axis"), F.array_max("axis"))).where("p is not null")
    sub = F.when(F.col("p.kind") != "year", F.col("p"))
    down = spans.groupBy("sheet", "r").agg(F.min_by("p.year", F.when(F.col("p.year").isNotNull(), F.col("c"))).alias("y"), F.min_by(sub, F.when(sub.isNotNull(), F.col("c"))).alias("s"))
    down = down.select("sheet", "r", C.joined_period(F.col("y"), F.coalesce("s", F.struct(F.lit("year").alias("kind"), F.col("y").alias("year"), F.lit(None).cast("int").alias("sub")))).alias("down")).where("down is not null")
    down = staged(down, "periods")
    hits = down.groupBy("sheet").agg(F.count("*").alias("hits"))
    forms = found.join(hits, "sheet", "left").select("sheet", "axis", (F.coalesce("hits", F.lit(0)) >= F.greatest(F.lit(3.0), 0.6 * (F.col("last") - F.col("first") + 1))).alias("series"))
    # labels of columns, without what the sheet's columns share
    named = staged(named, "headings")
    columns = named.join(forms, "sheet").where(~(F.col("series") & F.coalesce(F.col("c").between(F.array_min("axis"), F.array_max("axis")), F.lit(False))))
    plain = lambda c: F.when(F.col("series"), F.col(c)).otherwise(C.stable(F.col(c)))
    columns = columns.withColumns({"s_en": plain("en"), "s_ar": plain("ar")})
    gathered = columns.groupBy("sheet").agg(F.collect_list(F.struct("c", "en", "ar", "s_en", "s_ar", "period", "series")).alias("k"), F.collect_list("s_en").alias("all_en"), F.collect_list("s_ar").alias("all_ar"))
    cut = gathered.join(sheets, "sheet").select("sheet", "name", F.explode("k").alias("k"), "all_en", "all_ar").select("sheet", "name", "k.*", C.without_common(F.col("all_en"), F.col("k.s_en")).alias("col_en"), C.without_common(F.col("all_ar"), F.col("k.s_ar")).alias("col_ar"))
    spelt = F.when(F.col("series"), F.concat_ws(" ", "col_en", "col_ar")).otherwise(F.concat_ws(" ", "en", "ar"))
    cut = cut.withColumn("kind", C.kind(spelt, F.col("name"))).withColumn("is_weight", ~F.col("series") & (C.kind(F.concat_ws(" ", "col_en", "col_ar")) == "weight"))
    cut = staged(cut, "columns")
    weight_col = cut.where("is_weight").groupBy("sheet").agg(F.min("c").alias("weight_col"))
    # labels of rows
    marked = body.join(weight_col, "sheet", "left")
    at = lambda c, v: F.max(F.when(F.col("c") == F.col(c), F.col(v)))
    value_number = F.when(F.array_contains("value_cols", F.col("c")), F.col("x"))
    rows = marked.groupBy("sheet", "r").agg(
        C.bilingual(at("label_col", "t")).alias("a"), C.bilingual(at("alt_col", "t")).alias("b"), at("weight_col", "x").alias("weight"), F.max("weight_col").alias("weight_col"),
        F.count(value_number).alias("n"), F.count(F.when((value_number == F.floor(value_number)) & value_number.between(1960, 2035), 1)).alias("years"),
    )
    pick = lambda of: C.without_caption(F.when(F.col(f"a.{of}").rlike(C.LETTER) | (F.col(f"b.{of}") == ""), F.col(f"a.{of}")).otherwise(F.col(f"b.{of}")))
    rows = rows.select("sheet", "r", pick("en").alias("row_en"), pick("ar").alias("row_ar"), "weight", "weight_col", ((F.col("n") >= 2) & (F.col("years") == F.col("n"))).alias("header"))
    values = body.where("x is not null").select("sheet", "r", "c", "x").join(cut, ["sheet", "c"])
    none, empty = F.lit(None).cast("double"), F.lit("")
    series = values.where("series").join(down, ["sheet", "r"]).where("col_en <> '' or col_ar <> ''")
    series = series.select("sheet", F.lit("row-series-v1").alias("recipe"), F.col("col_en").alias("row_en"), F.col("col_ar").alias("row_ar"), empty.alias("col_en"), empty.alias("col_ar"), "kind", F.col("down").alias("period"), F.col("x").alias("value"), none.alias("weight"))
    matrix = values.where("not series").join(rows, ["sheet", "r"]).where("(row_en <> '' or row_ar <> '') and not header").where(~F.col("c").eqNullSafe(F.col("weight_col")))
    if fallback is not None:
        matrix = matrix.join(fallback.select("sheet", F.col("period").alias("_release")), "sheet", "left")
    else:
        matrix = matrix.withColumn("_release", F.lit(None).cast("string"))
    matrix = matrix.select("sheet", F.lit("matrix-v1").alias("recipe"), "row_en", "row_ar", "col_en", "col_ar", "kind", F.coalesce("period", "_release").alias("period"), F.col("x").alias("value"), "weight")
    facts = staged(series.union(matrix).join(base, "sheet", "left").select(*FACTS[:-1], F.coalesce("index_base", F.lit("")).alias("index_base")), "facts")
    return facts, _rejects(sheets, found, named, forms, columns, facts)


def _rejects(sheets: DataFrame, found: DataFrame, named: DataFrame, forms: DataFrame, columns: DataFrame, facts: DataFrame) -> DataFrame:
    """The first reason that holds for each sheet without facts."""
    counted = lambda df, name: df.groupBy("sheet").agg(F.count("*").alias(name))
    state = sheets.join(found.select("sheet", "first", "label_col"), "sheet", "left").join(counted(named, "n_values"), "sheet", "left").join(forms.select("sheet", "series"), "sheet", "left")
    state = state.join(counted(columns, "n_columns"), "sheet", "left").join(counted(facts, "n_facts"), "sheet", "left").where("n_facts is null")
    reason = (
        F.when(F.col("first").isNull(), "no data block found").when(F.col("label_col").isNull(), "no row-label column").when(F.col("n_values").isNull(), "no value columns")
        .when(F.col("series") & F.col("n_columns").isNull(), "row-series matched but every column is part of the time axis").when(F.col("series"), "row-series matched but produced no values").otherwise("matrix matched but produced no values")
    )
    return state.select("sheet", reason.alias("reason"))

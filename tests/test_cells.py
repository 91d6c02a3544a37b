"""Cell functions on stated cases."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import cells as C
from tidemark.operators import sheets as S
from tidemark.sinks.staging import staged


def _all(spark, f, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string").select("i", f(F.col("x")).alias("y")).orderBy("i").collect()
    return [tuple(r.y) if hasattr(r.y, "asDict") else r.y for r in rows]


CASES = {
    "number": (C.number, {"1,234.5": 1234.5, " 7 ": 7.0, "1e3": 1000.0, "": None, None: None, "1-": None, "12 a": None, "-.5": -0.5}),
    "period": (C.period, {"2017 Q1": "2017-Q1", "Q1 of 2024": "2024-Q1", "الربع الثاني 2024": "2024-Q2", "Jan-26": None, "January 2019": "2019-01", "يناير 2019": "2019-01", "أغسطس 2020": "2020-08", "2024-01-01": "2024-01", "2024": "2024", "2024*": "2024", "Population of the year 2024 by age": None, "Males 2020": "2020", None: None, "1949": None}),
    "part": (C.period_part, {"2026*": ("year", 2026, None), "2021.0": ("year", 2021, None), "Q3": ("quarter", None, 3), "Second Quarter 2020": ("quarter", 2020, 2), "الربع الأول": ("quarter", None, 1), "March": ("month", None, 3), "2020-05-01": ("month", 2020, 5), "Total": None, None: None}),
    "kind": (C.kind, {"Annual change of index": "index", "Inflation change": "change", "Relative weight": "weight", "الوزن": "weight", "نسبة التغير": "change", "الأرقـام القياسية": "index", "Males": "value", None: "value"}),
    "caption": (C.without_caption, {"Table 2.1 Prices": "Prices", "جدول (3-1) الاسعار": "الاسعار", "جدول [٣-١]: الاسعار": "الاسعار", "Table 4": "Table 4", "Prices": "Prices", None: ""}),
    "bilingual": (C.bilingual, {"الأرقام القياسية Index Numbers الرياض Riyadh": ("Index Numbers Riyadh", "الأرقام القياسية الرياض"), "Males | ذكور": ("Males", "ذكور"), "15 - 24 Years": ("15 - 24 Years", ""), "ذكور 15 Males 16": ("Males 16", "ذكور 15"), "GDPالناتج": ("GDP", "الناتج"), "Total:\nالإجمالي": ("Total", "الإجمالي"), "": ("", ""), None: ("", "")}),
    "stable": (C.stable, {"Index Numbers Q2_2026": "Index Numbers", "January": "", "2026*": "", "Number of the Establishments": "Number of the Establishments", "Index (2023=100)": "Index", "Change from Q1 2024 to Q1 2025 %": "Change %", "يناير 2024 ذكور": "ذكور", "": "", None: ""}),
    "base": (C.index_base, {"Index (2018=100)": "2018", "2023 = 100": "2023", "1999=100": None, None: None}),
}


@pytest.mark.parametrize("name", CASES)
def test_stated_cases(spark, name):
    f, cases = CASES[name]
    assert dict(zip(cases, _all(spark, f, list(cases)), strict=True)) == cases


def test_headings_that_restate_and_words_that_all_share(spark):
    rows = spark.createDataFrame([(["Agricultural", "Total Agricultural"],), (["Saudi", "Total"],), (["Male", "Males"],), ([],), (["A", "A b", "c A b"],)], "p array<string>")
    assert [r[0] for r in rows.select(C.not_restated(F.col("p"))).collect()] == [["Total Agricultural"], ["Saudi", "Total"], ["Male", "Males"], [], ["c A b"]]
    both = spark.createDataFrame([(["Labor Ratios Male", "Labor Ratios Female"],), (["Same", "Same"],), (["Only one"],)], "p array<string>")
    assert [r[0] for r in both.select(F.transform("p", lambda x: C.without_common(F.col("p"), x))).collect()] == [["Male", "Female"], ["Same", "Same"], ["Only one"]]


def test_release_periods(spark):
    cases = [("2024", "March", "Prices", "2024-03"), ("2024", None, "GDP Q4", "2024-Q4"), ("2025", "", "Inflation Sept. report q1", "2025-09"), ("2022", "x", "Yearbook", "2022"), ("n/a", "May", "", None), (None, "May", "", None)]
    rows = spark.createDataFrame(cases, "y string, m string, t string, p string")
    assert [r[0] for r in rows.select(C.release_period(F.col("y"), F.col("m"), F.col("t"))).collect()] == [c[3] for c in cases]


def test_a_cell_is_folded_once_for_its_period(spark):
    for reads in (C.period, C.period_part):
        assert str(reads(F.col("t"))).count("translate(") == 1
    rows = spark.createDataFrame([("20 24",), ("1850-01-02",), ("12024",), ("Q9",)], "t string")
    assert [r.p and tuple(r.p) for r in rows.select(C.period_part(F.col("t")).alias("p")).collect()] == [("year", 2024, None), ("month", None, 1), None, None]


def test_a_heading_that_sheets_share_is_read_once(spark, monkeypatch):
    made = {}
    monkeypatch.setattr(S, "staged", lambda df, name: made.setdefault(name, staged(df, name)))
    grid = [["Group", "Year 2020", "Year 2021"], ["Food and drink", 1, 2], ["Clothing", 3, 4]]
    cells = S.typed(spark.createDataFrame([(f"s{n}", "n", r, c, str(v)) for n in range(5) for r, line in enumerate(grid) for c, v in enumerate(line)], "sheet string, name string, r int, c int, value string"))
    heads = S.headings(cells, S.blocks(cells)).collect()
    assert sorted((h.sheet, h.c, h.period) for h in heads) == sorted((f"s{n}", c, p) for n in range(5) for c, p in ((1, "2020"), (2, "2021")))
    assert made["header"].count() == 15 and sorted(r.t for r in made["said"].collect()) == ["Group", "Year 2020", "Year 2021"]

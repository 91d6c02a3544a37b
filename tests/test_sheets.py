"""Sheets of every form against what a reader would say of them."""

from tidemark.operators import sheets as S

MATRIX = [
    ["Table 2.1: Consumer price index by main group (2018=100), all regions"],
    [],
    ["Group", "المجموعة", "Weight", "Index Numbers الأرقام القياسية", None, None, "Change"],
    [None, None, None, "2023", None, "2024", "2024"],
    [None, None, None, "Q3", "Q4", "Q1", "Q1"],
    ["Food and drink", "الأغذية", 20.5, 101.5, "1,102.0", 103, 0.5],
    ["Clothing", "الملابس", 10, 99, 98, 97, -1],
    [],
    [],
    ["Housing rent", "السكن", 30, 100, 104, 105, 2.5],
    ["2021", None, 2021, 2021, 2022, 2023, 2024],
    ["Transport", "النقل", 12, 90, None, 92, 1],
    [],
    [],
    [],
    [],
    ["Source: survey", None, 1, 2, 3],
]
SERIES = [
    ["Quarterly output by kind of activity, at constant prices of the base year"],
    ["Year", "Quarter", "Oil Activities", "Non-Oil Activities", "Growth rate"],
    *[[y, f"Q{q}", 100.5 + y + q, 200.25 + q, 1.5] for y in (2022, 2023) for q in (1, 2, 3, 4)],
    ["2024*", "Q1", 7.5, 8.5, 0.5],
]
NUMBERED = [["No", "Item", "Males", "Females"], ["1-", "Oil wells", 1, 2], ["2-", "Gas wells", 3, 4], ["3-", "Water", 5, 6]]
NOTES = [["Notes"], ["Nothing to see"], ["x", 1]]
CODES = [["h", "a", "b"], ["only", 1, 2], ["only", 3, 4]]
SPARSE = [["h", *"abcdefghijkl"], ["label", 1, 2], *[[f"label {i}", *[7 if i % 12 == c else None for c in range(12)]] for i in range(20)]]


def _cells(spark, **grids):
    rows = [(s, s, r, c, None if v is None else str(v)) for s, g in grids.items() for r, line in enumerate(g) for c, v in enumerate(line)]
    return spark.createDataFrame(rows, "sheet string, name string, r int, c int, value string")


def _read(spark, cells, fallback=None):
    facts, rejects = S.read_sheets(cells, fallback)
    return facts.toPandas(), dict(map(tuple, rejects.collect()))


def test_blocks(spark):
    found = {r.sheet: r for r in S.blocks(S.typed(_cells(spark, matrix=MATRIX, series=SERIES, numbered=NUMBERED))).collect()}
    m, s, n = found["matrix"], found["series"], found["numbered"]
    assert (m.header_start, m.first, m.last, m.label_col, m.alt_col, m.value_cols) == (2, 5, 11, 0, 1, [2, 3, 4, 5, 6])
    assert (s.header_start, s.first, s.last, s.axis) == (1, 2, 10, [0, 1])
    assert (n.first, n.label_col, n.alt_col) == (1, 1, None)


def test_matrix(spark):
    facts, rejects = _read(spark, _cells(spark, matrix=MATRIX))
    assert not rejects and set(facts.recipe) == {"matrix-v1"} and set(facts.index_base) == {"2018"}
    food = facts[facts.row_en == "Food and drink"]
    assert sorted(zip(food.col_en, food.kind, food.period, food.value, strict=True)) == [("Change", "change", "2024-Q1", 0.5), ("Index Numbers", "index", "2023-Q3", 101.5), ("Index Numbers", "index", "2023-Q4", 1102.0), ("Index Numbers", "index", "2024-Q1", 103.0)]
    assert set(food.row_ar) == {"الأغذية"} and set(food.weight) == {20.5}
    assert sorted(set(facts.row_en)) == ["Clothing", "Food and drink", "Housing rent", "Transport"] and len(facts) == 15


def test_row_series(spark):
    facts, rejects = _read(spark, _cells(spark, series=SERIES))
    assert not rejects and set(facts.recipe) == {"row-series-v1"} and len(facts) == 27
    assert sorted(set(facts.period)) == [f"{y}-Q{q}" for y in (2022, 2023) for q in (1, 2, 3, 4)] + ["2024-Q1"]
    assert {(r.row_en, r.kind) for r in facts.itertuples()} == {("Oil Activities", "value"), ("Non-Oil Activities", "value"), ("Growth rate", "change")}


def test_serial_numbers_are_no_labels_and_releases_date_columns(spark):
    release = spark.createDataFrame([("numbered", "2020")], "sheet string, period string")
    facts, _ = _read(spark, _cells(spark, numbered=NUMBERED), release)
    assert sorted(zip(facts.row_en, facts.col_en, facts.period, facts.value, strict=True)) == sorted((n, c, "2020", v) for n, a, b in (("Oil wells", 1, 2), ("Gas wells", 3, 4), ("Water", 5, 6)) for c, v in (("Males", a), ("Females", b)))


def test_each_sheet_has_facts_or_one_reject(spark):
    cells = _cells(spark, matrix=MATRIX, series=SERIES, notes=NOTES, codes=CODES, sparse=SPARSE, empty=[[None]])
    facts, rejects = _read(spark, cells)
    assert rejects == {"notes": "no data block found", "codes": "no row-label column", "sparse": "no value columns", "empty": "no data block found"}
    assert {*facts.sheet} == {"matrix", "series"}
    facts, rejects = _read(spark, cells.limit(0))
    assert not len(facts) and not rejects


def test_sheets_are_written_once_from_the_trade_tables(spark):
    from tidemark.plans import sheets

    for query in (sheets.sheet_headings, sheets.sheet_rejects):
        assert "lineitem.parquet" not in query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()

"""Stores of records, rings and places, on small cases."""

import itertools
import json

from pyspark.sql import functions as F

from tidemark.functions import places as P
from tidemark.operators import crawl, shapes

SCHEMA = "id string, version int, body string"


def put_all(spark, path, batches):
    store = crawl.Store(spark, path, SCHEMA, ["id"], ["version"], parts=4)
    for batch in batches:
        store.put(spark.createDataFrame(batch, SCHEMA))
    return store


def test_order_and_repeats_of_batches_change_nothing(spark, tmp_path):
    batches = [[("a", 1, "old"), ("b", 2, "x"), (None, 1, "n")], [("a", 3, "new"), ("a", 2, "mid")], [("b", 2, "y"), ("c", None, "z"), (None, None, None)]]
    expected = {("a", 3, "new"), ("b", 2, "y"), ("c", None, "z"), (None, 1, "n")}
    for n, order in enumerate(itertools.permutations(batches)):
        store = put_all(spark, f"{tmp_path}/{n}", [*order, order[0], order[2]])
        rows = [tuple(r) for r in store.rows().collect()]
        assert len(rows) == 4 and set(rows) == expected
    wanted = spark.createDataFrame([("a",), ("d",), (None,)], "id string")
    assert [r.id for r in store.pending(wanted).collect()] == ["d"]


def test_empty_store_and_batch(spark, tmp_path):
    store = put_all(spark, f"{tmp_path}/none", [[]])
    assert store.rows().count() == 0 and store.rows().columns == ["id", "version", "body"]
    assert store.pending(spark.createDataFrame([("a",)], "id string")).count() == 1


def test_only_touched_parts_are_written(spark, tmp_path):
    store = put_all(spark, f"{tmp_path}/s", [[(str(i), 1, "x") for i in range(40)]])
    before = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}
    store.put(spark.createDataFrame([("7", 2, "y"), ("7", 3, "z")], SCHEMA))
    now = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}
    folders = {f.parent for f in before.keys() ^ now.keys()}
    assert len(folders) == 1 and len({f.parent for f in now}) == 4
    assert store.rows().count() == 40 and store.rows().where("id = '7'").first().body == "z"


def test_columns_of_a_store_may_have_any_name(spark):
    rows = spark.createDataFrame([("a", 1, 5, 6), ("a", 2, 7, 8)], "`k.x` string, version int, _row int, `odd name` int").withColumnRenamed("k.x", "k")
    assert [tuple(r) for r in crawl.last_wins(rows, ["k"], ["version"]).collect()] == [("a", 2, 7, 8)]


def test_shortfall(spark):
    rows = spark.createDataFrame([("p", 3, "1"), ("p", 3, "2"), ("p", 3, "2"), ("q", 1, "1"), ("r", None, "1")], "listing string, total int, id string")
    assert [tuple(r) for r in crawl.shortfall(rows, ["listing"], "total", "id").collect()] == [("p", 3, 2, 1)]


# Arcs that meet: 0 from (0,0) to (2,2), 1 from (2,2) to (0,0), 2 from (0,0) to (2,2) by another way, 3 a ring of its own.
ARCS = [[[0, 0], [2, 0], [0, 2]], [[2, 2], [-2, 0], [0, -2]], [[0, 0], [0, 2], [2, 0]], [[5, 5], [1, 0], [0, 1], [-1, -1]]]


def stitched(indices, scale, shift):
    absolute = []
    for arc in ARCS:
        xs, ys = itertools.accumulate(d[0] for d in arc), itertools.accumulate(d[1] for d in arc)
        absolute.append([(x * scale[0] + shift[0], y * scale[1] + shift[1]) for x, y in zip(xs, ys)])
    line = []
    for i in indices:
        arc = absolute[i] if i >= 0 else absolute[~i][::-1]
        line += arc[1:] if line else arc
    return line


def test_rings_of_polygons(spark, tmp_path):
    geometries = [
        ("A", "One", "Polygon", [[[0, 1], [3]]]), ("B", "Two", "MultiPolygon", [[[0, ~2]], [[3], [~3]]]), ("C", "Back", "Polygon", [[[~1, ~0, 2]]]),
        ("-99", "Left out", "Polygon", [[[0]]]), ("D", None, "Polygon", [[[0]]]), (None, "No id", "Polygon", [[[0]]]), ("E", "Line", "LineString", [[[0]]]), ("F", "Empty", "Polygon", []), ("G", "Unknown arc", "Polygon", [[[9, 3]]]),
    ]
    table = spark.createDataFrame(geometries, shapes.GEOMETRIES)
    deltas = spark.createDataFrame([(a, i, *d) for a, arc in enumerate(ARCS) for i, d in enumerate(arc)], "arc long, i int, dx long, dy long")
    scale, shift = (0.5, 2.0), (30.0, 10.0)
    found = {}
    for r in shapes.ring_points(table, shapes.decoded(deltas, scale, shift)).orderBy("seq").collect():
        found.setdefault((r.id, r.polygon, r.ring), []).append((r.seq, (r.x, r.y)))
    expected = {("A", 0, 0): [0, 1], ("A", 0, 1): [3], ("B", 0, 0): [0, ~2], ("B", 1, 0): [3], ("B", 1, 1): [~3], ("C", 0, 0): [~1, ~0, 2], ("G", 0, 0): [3]}
    assert found == {k: list(enumerate(stitched(v, scale, shift))) for k, v in expected.items()}
    assert json.loads(json.dumps(found["A", 0, 0]))[0] == [0, [30.0, 10.0]]
    box = {r.id: tuple(r)[2:] for r in shapes.bounds(shapes.ring_points(table, shapes.decoded(deltas))).collect()}
    assert box["B"] == (2, 3, 13, 0.0, 6.0, 0.0, 6.0)


def test_stated_spellings_of_places(spark):
    known = P.gazetteer(spark.createDataFrame([("Al Bahah", "SA.BA", "region", 1), ("Baha", "SA.BA", "city", 2), ("Ha'il", "SA.HA", "region", 1), ("Al Madinah", "SA.MD", "region", 1), ("Al Madinah Al Munawwarah", "SA.MD", "region", 1), ("Eastern Region", "SA.SH", "region", 1), ("Riyadh", "SA.RI", "city", 1), ("Riyadh Dry Port", "SA.RI", "gateway", 1), ("`Asir", "SA.AS", "region", 1), ("city", "none", "region", 1)], "label string, region string, kind string, rank int"))
    cases = {
        "Al-Baha": ("SA.BA", "city"), "Al Bahah": ("SA.BA", "region"), "AL - Baha": ("SA.BA", "city"), "Ḥāʼil": None, "Hail Region": ("SA.HA", "region"), "Hā’il": ("SA.HA", "region"), "Easte. Prov.": None, "The Eastern Province": ("SA.SH", "region"),
        "Trade by Riyadh Dry Port, total": ("SA.RI", "gateway"), "Riyadh and Hail": ("SA.RI", "city"), "ASIR": ("SA.AS", "region"), "Thailand": None, "Harari": None, "": None, None: None, "City": None, "---": None,
    }
    rows = spark.createDataFrame([(c,) for c in cases] + [("ASIR",)], "label string")
    found = P.resolved(rows, known).collect()
    assert {r.label: (r.region, r.kind) for r in found} == {c: x for c, x in cases.items() if x}
    assert sum(r.label == "ASIR" for r in found) == 2


def test_no_places(spark):
    none = spark.createDataFrame([], "label string, region string, kind string, rank int")
    assert P.resolved(spark.createDataFrame([("Riyadh",)], "label string"), P.gazetteer(none)).count() == 0
    assert spark.createDataFrame([(None,)], "label string").select(P.place(F.col("label"))).first()[0] == ""

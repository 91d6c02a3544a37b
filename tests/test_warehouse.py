"""The warehouse: keys by folded labels, bases, plans without exchanges, and the gate."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import warehouse as W
from tidemark.operators.gate import Check, gate, watched
from tidemark.operators.star import Warehouse
from tidemark.sinks.staging import staged
from tidemark.sources.tables import FACTS
from tidemark.sources.trade_releases import RELEASE_ORDER, trade_files, trade_releases

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def house(spark):
    return Warehouse.build(trade_releases(spark, DATA), trade_files(spark, DATA), order=RELEASE_ORDER)


def fact(**told):
    blank = {"category_id": "1", "product": "Prices", "domain": "D", "subdomain": "S", "pub_id": "10", "release_title": "T", "table": "1.1", "recipe": "m", "row_en": "Food", "row_ar": "", "col_en": "Index", "col_ar": "", "kind": "index", "period": "2020", "period_type": "annual", "value": 100.0, "weight_pct": None, "index_base": "", "source_sha256": "a", "source_file": "f.xlsx"}
    return tuple((blank | told).values())


def build(spark, *facts, **kw):
    return Warehouse.build(spark.createDataFrame(list(facts), FACTS), **kw)


def test_cosmetic_drift_keeps_one_series(spark):
    same = [{"row_en": "Food"}, {"row_en": "FOOD (1)"}, {"row_en": " food ( 12 ) *"}, {"row_en": "Food", "row_ar": "غذاء"}, {"col_en": "index •", "table": " 1.1 "}]
    other = [{"row_en": "Foods"}, {"row_en": "", "row_ar": "غذاء"}, {"kind": "change"}, {"table": "1.2"}, {"category_id": "2"}]
    rows = spark.createDataFrame([fact(**x) for x in same + other], FACTS)
    keys = [r.measure_key for r in W.keyed(rows).collect()]
    assert len(set(keys[: len(same)])) == 1 and len(set(keys)) == 1 + len(other)


def test_null_labels_and_columns_have_a_key(spark):
    rows = spark.createDataFrame([fact(row_en=None, row_ar="غذاء", col_en=None, col_ar=None, kind=None, table=None, index_base=None)], FACTS)
    assert W.keyed(rows).where("series_key is null or measure_key is null").count() == 0


def test_bases_merge_by_default_only_where_they_agree(spark):
    agree = [fact(period=p, value=v, index_base=b, pub_id=b or "1") for p, v in (("2020", 100.0), ("2021", 101.0)) for b in ("", "2018")] + [fact(period="2022", index_base="", value=102.0)]
    apart = [fact(row_en="Fuel", period=p, value=v + (b == "2018"), index_base=b) for p, v in (("2020", 100.0), ("2021", 101.0)) for b in ("", "2018")]
    once = [fact(row_en="Rent", period="2020", index_base=b) for b in ("", "2018")]
    rebased = [fact(row_en="Cars", period=p, index_base=b) for p in ("2020", "2021") for b in ("", "2018", "2023")]
    change = [fact(row_en="Rice", kind="change", index_base=b, pub_id=b or "1") for b in ("", "2018")]
    series = build(spark, *agree, *apart, *once, *rebased, *change).quality().collect()
    assert sorted((r.row_en, r.index_base, r.n_points) for r in series) == [
        ("Cars", "", 2), ("Cars", "2018", 2), ("Cars", "2023", 2), ("Food", "2018", 3), ("Fuel", "", 2), ("Fuel", "2018", 2), ("Rent", "", 1), ("Rent", "2018", 1), ("Rice", "", 1)]


def test_admission_and_names(spark):
    house = build(spark, fact(row_en="Food", row_ar=""), fact(row_en="FOOD *", row_ar="غذاء", pub_id="11", value=7.0), fact(period="1900"), fact(period="2036"), fact(period=""), fact(period=None), fact(value=None), fact(row_en=""), fact(row_en=None))
    (row,) = house.star().collect()
    assert (row.value, row.row_ar, row.pub_id, row.release_title) == (7.0, "غذاء", "11", "T")
    assert [(r.value, r.revision_age) for r in house.revisions().collect()] == [(100.0, 2)]


def test_no_facts(spark):
    house = build(spark)
    assert [x.count() for x in (house.star(), house.revisions(), house.quality(), house.coverage(), house.releases())] == [0] * 5


def test_a_second_build_replaces_the_first(spark):
    for n in (1, 2):
        house = build(spark, *(fact(period=str(2000 + i)) for i in range(n)), database="tidemark_twice")
        assert house.observations().count() == n


def test_a_build_makes_only_what_is_asked_for(spark):
    house = build(spark, fact(), fact(pub_id="11"), tables=("dim_release",))
    assert house.releases().count() == 2
    assert [t.name for t in spark.catalog.listTables(house.database)] == ["dim_release"]


def test_readings_are_exchanged_by_series_alone_and_staged_without_long_keys(spark, monkeypatch):
    from tidemark.operators import star

    made = {}
    monkeypatch.setattr(star, "staged", lambda df, name: made.setdefault(name, staged(df, name)))
    monkeypatch.setattr(Warehouse, "_write", lambda self, df, name, *_: made.setdefault(name, df))
    build(spark, fact(), fact(kind="value"), tables=("reading", "dim_series"))
    assert {"measure_key", "value"} <= {*made["keyed"].columns} and not {"series_key", "release_key", "product_key", "product", "source_sha256"} & {*made["keyed"].columns}
    assert plan(made["reading"]).count("Exchange ") == plan(made["reading"]).count("BroadcastExchange ") + 1


def test_chartable_at_once_equals_the_rules_one_by_one(spark):
    from tidemark.sources.tables import trade_facts

    readings = W.keyed(trade_facts(spark, DATA)).withColumn("series_key", F.concat("category_id", "kind"))
    now = W.latest(readings)
    apart = W.chartable(now, W.suspect(now, ["series_key"], 2, 49), W.ambiguous(readings).where("n_periods_ambiguous > 82"))
    once = W.chartable_at_once(readings, 2, 49, 82)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, apart.collect())) and 0 < once.count() < readings.select("series_key").distinct().count()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_are_read_once_and_series_meet_without_exchange(spark, house):
    facts = plan(trade_releases(spark, DATA))
    assert facts.count("l_orderkey") and facts.count("lineitem.parquet") == 1
    quality = plan(house.quality())
    assert "Exchange hashpartitioning" not in quality and "Bucketed: true" in quality
    on_series = [x for x in plan(house.star()).splitlines() if "Exchange hashpartitioning(series_key" in x]
    assert on_series == []
    assert "superseded" in plan(house.observations()).split("PartitionFilters")[1].split("]")[0]


def test_quality_flags(spark):
    mixed = [fact(row_en="Mixed", period=str(2000 + i), value=v) for i, v in enumerate((1.0, 60.0, 2.0))]
    doubt = [fact(row_en="Doubt", period=str(2000 + i), value=20.0 + i, pub_id="1") for i in range(3)] + [fact(row_en="Doubt", period="2001", value=40.0, pub_id="2")]
    still = [fact(row_en="Still", period=str(2000 + i)) for i in range(4)]
    good = [fact(row_en="Good", period=str(2000 + i), value=20.0 + i) for i in range(3)]
    short = [fact(row_en="Short", period=str(2000 + i), value=20.0 + i) for i in range(2)]
    weight = [fact(row_en="Weight", kind="weight", period=str(2000 + i), value=20.0 + i) for i in range(3)]
    found = {r.row_en: (r.suspect, r.ambiguous, r.chartable) for r in build(spark, *mixed, *doubt, *still, *good, *short, *weight).quality().collect()}
    none = (False, False, False)
    assert found == {"Mixed": (True, False, False), "Doubt": (False, True, False), "Still": none, "Good": (False, False, True), "Short": none, "Weight": none}


def test_gate_and_its_observed_form_agree(spark):
    rows = spark.createDataFrame([(1.0,), (5.0,), (None,)], "v double")
    checks = [Check.near("sum", 6, 0.1, F.sum("v")), Check("least", 2, 9, F.min("v")), Check("none", 0, 1, F.max(F.when(F.col("v") > 9, F.col("v")))), Check("rows", 3, 3, F.count(F.lit(1)))]
    expected = [("sum", 6.0, "ok"), ("least", 1.0, "FAIL"), ("none", None, "FAIL"), ("rows", 3.0, "ok")]
    assert [(r.check, r.found, r.verdict) for r in gate(rows, checks).collect()] == expected
    kept, verdicts = watched(rows, checks)
    kept.write.format("noop").mode("overwrite").save()
    assert [(r.check, r.found, r.verdict) for r in verdicts().collect()] == expected


def test_a_label_is_folded_once_and_only_indices_are_looked_through_for_bases(spark, monkeypatch):
    from tidemark.functions import labels as L
    from tidemark.operators import star

    assert str(L.fold(F.col("x"))).count("translate(") == 1 and str(L.fold(F.col("x"))).count("lower(") == 1
    odd = [("Food ( 1 )\t *", "food"), ("A\x0b", "a"), (" a \n b\r-", "a b"), ("( x 1)", "( x 1)"), ("*٭ –", None), ("É (2)(3)", "é"), (None, None)]
    assert [r[0] for r in spark.createDataFrame(odd, "x string, y string").coalesce(1).select(L.fold(F.col("x"))).collect()] == [y for _, y in odd]
    seen = []
    merge = W.base_merge
    monkeypatch.setattr(star.W, "base_merge", lambda readings, tolerance: seen.append({r.kind for r in readings.select("kind").distinct().collect()}) or merge(readings, tolerance))
    build(spark, fact(), fact(kind="value"), fact(kind=None), tables=("reading",))
    assert seen == [{"index"}]

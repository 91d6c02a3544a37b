import glob
import json

import pyarrow.parquet as pq

from tidemark.sinks import exports
from tidemark.sources import tables

ROWS = [("b", "2024-02", 2.0), ("a", "2024-01", 1.0), (None, "2023", None), ("a", "2024-01", 1.0)]
SCHEMA = "series_key string, period string, value double"


def test_flags(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    found = exports.flagged(rows, "series_key", ambiguous=rows.where("series_key = 'a' or series_key is null"), suspect=rows.limit(0))
    assert sorted((str(r.series_key), r.ambiguous, r.suspect) for r in found.collect()) == [("None", False, False), ("a", True, False), ("a", True, False), ("b", False, False)]
    assert found.columns == ["series_key", "period", "value", "ambiguous", "suspect"]


def test_sorted_parquet_and_manifest(spark, tmp_path):
    rows = spark.range(100_000).selectExpr("cast(id % 7 as string) as series_key", "cast(2000 + id % 20 as string) as period", "id")
    path = f"{tmp_path}/obs"
    for _ in range(2):  # the second replaces the first
        exports.sorted_parquet(rows.coalesce(1), path, "series_key", "period")
    files = sorted(glob.glob(path + "/*.parquet"))
    groups = [pq.ParquetFile(f).metadata.row_group(i) for f in files for i in range(pq.ParquetFile(f).metadata.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 100_000 and max(g.num_rows for g in groups) <= exports.ROW_GROUP
    assert {g.column(0).compression for g in groups} == {"ZSTD"}
    keys = [k for f in files for k in zip(*pq.read_table(f, columns=["series_key", "period"]).to_pydict().values())]
    assert keys == sorted(keys)
    exports.sorted_parquet(spark.createDataFrame([], "name string"), f"{tmp_path}/none", "name")
    found = exports.manifest(spark, f"{tmp_path}/manifest.json", {"obs": path, "none": f"{tmp_path}/none"})
    assert found == json.load(open(f"{tmp_path}/manifest.json")) == {"files": {"none": 0, "obs": 100_000}, "max_period": "2019"}


def test_csv_and_json(spark, tmp_path):
    rows = spark.createDataFrame([("س, \"x\"", "2024", 1.5), ("b", None, None)], SCHEMA)
    exports.spreadsheet_csv(rows.coalesce(1), f"{tmp_path}/csv")
    (part,) = glob.glob(f"{tmp_path}/csv/*.csv")
    assert open(part, encoding="utf-8").read().startswith("﻿series_key,period,value\n")
    assert [r.series_key for r in tables.strings_csv(spark, part).collect()] == ["س, \"x\"", "b"]
    exports.json_documents(spark.createDataFrame(ROWS, SCHEMA), f"{tmp_path}/json", ["series_key"])
    read = spark.read.schema("series_key string, rows array<struct<period: string, value: double>>").json(f"{tmp_path}/json")
    assert {r.series_key: [tuple(x) for x in r["rows"]] for r in read.collect()} == {"a": [("2024-01", 1.0)] * 2, "b": [("2024-02", 2.0)], None: [("2023", None)]}


def test_json_source_and_views(spark, tmp_path):
    (tmp_path / "scope.json").write_text(json.dumps([{"id": 1, "labels": {"en": "Prices", "ar": "الاسعار"}}, {"id": 2}], indent=1), encoding="utf-8")
    found = tables.json_file(spark, f"{tmp_path}/scope.json", "id long, labels struct<en: string, ar: string>").collect()
    assert [(r.id, r.labels and r.labels.ar) for r in found] == [(1, "الاسعار"), (2, None)]
    tables.registered(spark, "/root/testdata/sf0.001", "nation", "region")
    assert spark.sql("select count(*) from nation join region on n_regionkey = r_regionkey").first()[0] == 25

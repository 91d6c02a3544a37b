"""The registered queries and the stages of the pipeline over the smallest tables."""

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import queries as Q

DATA = "/root/testdata/sf0.001"
ROWS = {"op3_warc": "pages", "op8_html": "pages"}
KEYS = {"op3_warc": "page_id", "op8_html": "page_id"}


@pytest.mark.parametrize("name", [n for n in Q.queries() if n not in ("op1_packing", "op6_neighbours", "op11_hard_negatives", "op12_conversations")])
def test_a_row_for_each_row(spark, name):
    table, key = ROWS.get(name, "documents"), KEYS.get(name, "doc_id")
    found = Q.queries()[name](spark, DATA).toPandas()
    assert sorted(found[key]) == sorted(spark.read.parquet(f"{DATA}/{table}.parquet").toPandas()[key])
    if sql := Q.oracle_sql().get(name):
        con = duckdb.connect()
        con.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
        expected = con.execute(sql).df()
        rows = lambda f: sorted(map(repr, f[sorted(f.columns)].astype(object).where(f.notna(), None).astype(str).itertuples(index=False)))
        assert rows(found) == rows(expected)


@pytest.mark.parametrize("name, table", [("op11_hard_negatives", "embeddings"), ("op12_conversations", "conversations")])
def test_rows_equal_sql(spark, name, table):
    found, con = Q.queries()[name](spark, DATA).toPandas(), duckdb.connect()
    con.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    expected = con.execute(Q.oracle_sql()[name]).df()
    assert len(found) and sorted(map(repr, found[sorted(found.columns)].astype(str).itertuples(index=False))) == sorted(map(repr, expected[sorted(expected.columns)].astype(str).itertuples(index=False)))


def test_neighbours_are_found(spark):
    found = Q.op6_neighbours(spark, DATA).toPandas()
    table = spark.read.parquet(f"{DATA}/embeddings.parquet").toPandas()
    vectors, ids, hits, total = np.stack(table.embedding.to_numpy()).astype(float), table.vec_id.to_numpy(), 0, 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = vectors @ vectors[q]
        score[q] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]]
        hits += len({*best} & {*found.vec_id[found.query_id == ids[q]]})
        total += len(best)
    assert hits >= 0.9 * total


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = corpus_pipeline.quality(spark, docs, DATA).toPandas()
    judged = Q.op2_quality(spark, DATA).toPandas()
    assert sorted(kept.doc_id) == sorted(judged.doc_id[judged.kept]) and not (judged.kept & judged.base_failed).any()
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    seen = {}
    for x in texts.values():
        for i in range(len(x) - 199):
            seen[x[i : i + 200]] = seen.get(x[i : i + 200], 0) + 1
    for r in corpus_pipeline.repeated_strings(spark, docs, DATA).collect():
        x = texts[r.doc_id]
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - 199):
            if seen[x[i : i + 200]] > 1:
                gone[i : i + 200] = True
        left = bytes(b for b, g in zip(x, gone, strict=True) if not g).decode("utf-8", "ignore")
        assert (r.text or "") == left and (r.n_chars == len(left) or not gone.any())
    packed = corpus_pipeline.run(spark, DATA).toPandas()
    assert set(packed.doc_id) <= set(kept.doc_id)
    for _, s in packed.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert list(s.offset) == [0, *s.length.cumsum()[:-1]] and s.length.sum() <= 4096

"""Each query against its SQL on the smallest tables."""

import duckdb
import pytest

from tidemark.operators import warehouse as W
from tidemark.plans import house, records, sheets  # noqa: F401  these add their queries
from tidemark.plans.catalogue import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages conversations".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def _rows(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted(repr([float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x for x in r]) for r in df.where(df.notna(), None).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, oracle, name):
    found, expected = QUERIES[name](spark, DATA).toPandas(), oracle.execute(ORACLES[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert _rows(found) == _rows(expected)


def test_every_reading_is_current_or_superseded(spark):
    from tidemark.sources.tables import trade_facts

    facts = W.keyed(trade_facts(spark, DATA))
    now, old = W.latest(facts), W.revisions(facts)
    assert now.count() + old.count() == facts.count()
    assert now.select("series_key", "period").distinct().count() == now.count()

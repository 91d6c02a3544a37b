"""Queries of the sheet readers, over sheets that Spark writes from the trade tables; the SQL says what was written there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import recipes as R
from tidemark.operators import sheets as S
from tidemark.plans.catalogue import query
from tidemark.sinks.staging import staged
from tidemark.sources.trade_sheets import level_sheets, trade_sheets

#: Values by supplier, brand and quarter; brands with their row; columns with numbers in a fifth of the block's rows.
_WRITTEN = """w as (
 select l_suppkey as k, p_brand, l_returnflag as flag, (year(l_shipdate) - 1995) * 4 + quarter(l_shipdate) - 1 as q, l_quantity as v
 from lineitem join part on p_partkey = l_partkey),
brands as (select p_brand, row_number() over (order by p_brand) - 1 as i from (select distinct p_brand from part)),
ends as (select max(i) + 6 + 2 * cast(floor(max(i) / 10) as int) as last from brands),
m as (select k, p_brand, q, sum(v) as v from w where k % 3 = 0 group by all),
full_columns as (select k, q from (select k, q, count(*) + 1 as n from m group by all) cross join ends where n >= greatest(2, floor((last - 4) / 5)))
"""
_PERIOD = "(1995 + q // 4) || '-Q' || (q % 4 + 1)"


@query(f"""with {_WRITTEN}
select 'S' || s_suppkey as sheet, 2 as header_start, 5 as first, last, 0 as label_col, (select count(*) from full_columns f where f.k = s_suppkey) + 1 as n_values, 0 as n_axis from supplier cross join ends where s_suppkey % 3 = 0
union all
select 'S' || s_suppkey, 1, min(q) + 2, max(q) + 2, 1, 3, 2 from supplier join w on k = s_suppkey where s_suppkey % 3 = 1 group by s_suppkey
union all
select 'S' || s_suppkey, 0, 1, 3, null, null, 0 from supplier where s_suppkey % 6 = 5""")
def sheet_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = S.blocks(S.typed(trade_sheets(spark, sf_dir)))
    several = F.when(F.col("label_col").isNotNull(), F.size("value_cols"))
    return found.select("sheet", "header_start", "first", "last", "label_col", several.alias("n_values"), F.size("axis").alias("n_axis"))


@query(f"""with {_WRITTEN}
select 'S' || k as sheet, q + 2 as c, case when q // 4 % 2 = 0 then 'Index Numbers ' || (1995 + q // 4) || ' Q' || (q % 4 + 1) else 'Index Numbers ' || (1995 + q // 4) end as en,
 case when q // 4 % 2 = 0 then 'الأرقام القياسية' else 'الأرقام القياسية ' || ['الربع الأول', 'الربع الثاني', 'الربع الثالث', 'الربع الرابع'][q % 4 + 1] end as ar, {_PERIOD} as period from full_columns
union all
select 'S' || s_suppkey, 30, 'Index Numbers 2001 Total', 'الأرقام القياسية', '2001' from supplier where s_suppkey % 3 = 0
union all
select 'S' || s_suppkey, c, en, ar, null from supplier, (values (2, 'Returned quantity', 'المرتجع'), (3, 'Change in open quantity', ''), (4, 'Accepted index', '')) n(c, en, ar) where s_suppkey % 3 = 1""")
def sheet_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = staged(S.typed(trade_sheets(spark, sf_dir)), "cells")
    return S.headings(cells, staged(S.blocks(cells), "blocks")).select("sheet", "c", "en", "ar", "period")


@query(f"""with {_WRITTEN},
t as (select k, p_brand as row_en, 'علامة ' || substr(p_brand, 7) as row_ar, q, v from m
 union all select k, 'All brands', 'كل العلامات', q, sum(v) from m group by k, q),
tt as (select s_suppkey as k, b.p_brand as row_en, 'علامة ' || substr(b.p_brand, 7) as row_ar, coalesce(sum(m.v), 0) as v from supplier cross join brands b left join m on m.k = s_suppkey and m.p_brand = b.p_brand where s_suppkey % 3 = 0 group by all)
select 'S' || t.k as sheet, 'matrix-v1' as recipe, row_en, row_ar, 'Index Numbers' as col_en, 'الأرقام القياسية' as col_ar, 'index' as kind, (1995 + t.q // 4) || '-Q' || (t.q % 4 + 1) as period, v as value, '2018' as index_base from t join full_columns f on f.k = t.k and f.q = t.q
union all
select 'S' || k, 'matrix-v1', row_en, row_ar, 'Total', 'الأرقام القياسية', 'index', '2001', v, '2018' from tt
union all
select 'S' || k, 'row-series-v1', case flag when 'R' then 'Returned quantity' when 'N' then 'Change in open quantity' else 'Accepted index' end, case flag when 'R' then 'المرتجع' else '' end, '', '',
 case flag when 'R' then 'value' when 'N' then 'change' else 'index' end, {_PERIOD}, sum(v), '' from w where k % 3 = 1 group by k, flag, q""")
def sheet_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, _ = S.read_sheets(staged(trade_sheets(spark, sf_dir), "sheets"))
    return facts.drop("weight")


@query("select 'S' || s_suppkey as sheet, case when s_suppkey % 6 = 2 then 'no data block found' else 'no row-label column' end as reason from supplier where s_suppkey % 3 = 2")
def sheet_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.read_sheets(staged(trade_sheets(spark, sf_dir), "sheets"))[1]


#: Suppliers with sums by brand, and what their sheets are wanted for: January of even suppliers, February of odd ones, a month that none has of each thirteenth.
_LEVELS = """s as (
 select l_suppkey as k, p_brand, sum(l_quantity) as w, coalesce(sum(l_quantity) filter (strftime(l_shipdate, '%Y-%m') = '2000-01'), 0) as a, coalesce(sum(l_quantity) filter (strftime(l_shipdate, '%Y-%m') = '2000-02'), 0) as b
 from lineitem join part on p_partkey = l_partkey group by all),
n as (select *, row_number() over (partition by k order by p_brand) as i from s)
"""


def _levels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    cells = S.typed(level_sheets(spark, sf_dir))
    k = F.substring("sheet", 2, 20).cast("long")
    want = cells.select("sheet").distinct().select("sheet", F.when(k % 13 == 12, "1999-12").when(k % 2 == 0, "2000-01").otherwise("2000-02").alias("period"))
    return R.read_recipes(cells, want)


@query(f"""with {_LEVELS}
select 'S' || k as sheet, (i % 3 + 1)::int as level, 'Brand ' || substr(p_brand, 7) as label_en, 'علامة ' || substr(p_brand, 7) as label_ar, w as weight, case when k % 2 = 0 then a else b end as value, (4 + k % 2)::int as "column" from n where k % 5 <> 0 and k % 7 <> 0 and k % 13 <> 12
union all
select 'S' || k, 0, 'All brands', 'كل العلامات', sum(w), case when k % 2 = 0 then sum(a) else sum(b) end, (4 + k % 2)::int from n where k % 5 <> 0 and k % 7 <> 0 and k % 13 <> 12 group by k""")
def indicator_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _levels(spark, sf_dir)[0]


@query("""select 'S' || l_suppkey as sheet, case when l_suppkey % 7 = 0 then 'no recipe claims shape h2-5/l1/n5/0' when l_suppkey % 5 = 0 then 'no index columns (all under a percent-change heading)' else 'no index column for period 1999-12' end as reason
from (select distinct l_suppkey from lineitem) where l_suppkey % 5 = 0 or l_suppkey % 7 = 0 or l_suppkey % 13 = 12""")
def indicator_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _levels(spark, sf_dir)[1]

"""All queries of the statistics engine by name, each with SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import cells as C
from tidemark.functions import labels as L
from tidemark.operators import shapes
from tidemark.operators import warehouse as W
from tidemark.sinks.staging import staged
from tidemark.sources.tables import table, trade_facts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

def _folded(x: str) -> str:
    """SQL of a label folded for a key, empty where nothing is left."""
    bare = f"regexp_replace({x}, '\\([ \\t\\r\\n\\f]*[0-9]+[ \\t\\r\\n\\f]*\\)', '', 'g')"
    return f"lower(trim(regexp_replace(regexp_replace({bare}, '[*٭∗·•:\\-–\\s]+$', ''), '[ \\t\\r\\n\\f]+', ' ', 'g')))"


FACTS = f"""facts as (
 select cast(r.r_regionkey as varchar) as category_id, r.r_name as product, n.n_name as place,
        lpad(cast(o.o_orderkey as varchar), 10, '0') as pub_id, p.p_type as row_en, p.p_brand as col_en,
        case l.l_returnflag when 'A' then 'index' when 'R' then 'change' else 'value' end as kind,
        case when l.l_returnflag = 'A' and year(o.o_orderdate) < 1998 then '2018' else '' end as index_base,
        strftime(l.l_shipdate, '%Y-%m') as period,
        l.l_quantity as value, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice
 from lineitem l join orders o on o.o_orderkey = l.l_orderkey join part p on p.p_partkey = l.l_partkey
 join supplier s on s.s_suppkey = l.l_suppkey join nation n on n.n_nationkey = s.s_nationkey
 join region r on r.r_regionkey = n.n_regionkey),
keyed as (select *, md5(mk || '|' || index_base) as series_key, mk as measure_key from (select *, md5(category_id || '|' || {_folded('row_en')} || '|' || {_folded('col_en')} || '|' || kind) as mk from facts)),
ranked as (select *, row_number() over (partition by series_key, period order by pub_id desc, l_linenumber desc, l_partkey desc, l_suppkey desc, value desc, l_extendedprice desc) as rn from keyed),
latest as (select * from ranked where rn = 1)
"""


def query(sql: str | None = None, facts: bool = False) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = f"with {FACTS} {sql}" if facts else sql
        return f

    return add


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.keyed(trade_facts(spark, sf_dir))


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.latest(_keyed(spark, sf_dir))


@query("select category_id, pub_id, row_en, col_en, kind, period, value from facts where cast(substr(period, 1, 4) as int) between 1996 and 2000", facts=True)
def facts_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.admitted(trade_facts(spark, sf_dir), 1996, 2000).select("category_id", "pub_id", "row_en", "col_en", "kind", "period", "value")


@query("""with l as (select upper(p_name) || '  ( 1 ) *' as label, p_brand as other from part union all select '(2)', source from documents),
f as (select label, nullif(""" + _folded("label") + """, '') as folded, lower(other) as other from l)
select distinct label, folded, coalesce(folded, other, '') as ident, md5(coalesce(folded, other, '')) as ident_key from f""")
def series_fold_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.concat(F.upper("p_name"), F.lit("  ( 1 ) *")).alias("label"), F.col("p_brand").alias("other"))
    rows = part.union(table(spark, sf_dir, "documents").select(F.lit("(2)"), "source"))
    return rows.select("label", L.fold(F.col("label")).alias("folded"), L.ident(F.col("label"), F.col("other")).alias("ident")).distinct().withColumn("ident_key", F.md5("ident"))


@query("select category_id, pub_id, max(period) as max_period, count(*) as n_facts from facts group by all", facts=True)
def release_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trade_facts(spark, sf_dir).groupBy("category_id", "pub_id").agg(F.max("period").alias("max_period"), F.count("*").alias("n_facts"))


@query("select md5(category_id) as product_key, category_id, min(product) as product, count(distinct pub_id) as n_releases from facts group by category_id", facts=True)
def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trade_facts(spark, sf_dir).groupBy("category_id").agg(F.min("product").alias("product"), F.count_distinct("pub_id").alias("n_releases")).select(F.md5("category_id").alias("product_key"), "*")


@query("select series_key, category_id, kind, index_base, coalesce(max(nullif(row_en, '')), '') as row_en, coalesce(max(nullif(col_en, '')), '') as col_en from keyed group by series_key, category_id, kind, index_base", facts=True)
def series_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = lambda c: F.coalesce(F.max(F.nullif(F.col(c), F.lit(""))), F.lit("")).alias(c)
    return _keyed(spark, sf_dir).groupBy("series_key", "category_id", "kind", "index_base").agg(label("row_en"), label("col_en"))


@query("select series_key, pub_id, category_id, period, value from latest", facts=True)
def latest_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest(spark, sf_dir).select("series_key", "pub_id", "category_id", "period", "value")


@query("select series_key, pub_id, period, value, rn as revision_age from ranked where rn > 1", facts=True)
def revision_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.revisions(_keyed(spark, sf_dir)).select("series_key", "pub_id", "period", "value", F.col("revision_age").cast("long").alias("revision_age"))


@query("""select l.series_key, l.period, l.value, p.product, p.n_releases, r.max_period from latest l
join (select category_id, min(product) as product, count(distinct pub_id) as n_releases from facts group by 1) p using (category_id)
join (select category_id, pub_id, max(period) as max_period from facts group by 1, 2) r on r.category_id = l.category_id and r.pub_id = l.pub_id""", facts=True)
def star_observation(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = staged(trade_facts(spark, sf_dir).drop("place"), "facts")
    fact = W.latest(W.keyed(facts)).select("series_key", "category_id", "pub_id", "period", "value")
    named = staged(facts.groupBy("category_id", "pub_id").agg(F.max("period").alias("max_period"), F.min("product").alias("product")), "releases")
    product = named.groupBy("category_id").agg(F.min("product").alias("product"), F.count("*").alias("n_releases"))
    release = named.drop("product")
    return fact.join(product, "category_id").join(release, ["category_id", "pub_id"]).select("series_key", "period", "value", "product", "n_releases", "max_period")


@query("select series_key, count(*) as n_points, min(period) as first_period, max(period) as last_period from latest group by 1", facts=True)
def series_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.span(_latest(spark, sf_dir))


@query("select category_id, product, count(distinct series_key) as n_series, count(*) as n_obs, min(period) as first_period, max(period) as last_period, count(distinct pub_id) as n_releases from latest group by 1, 2", facts=True)
def product_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.coverage(_latest(spark, sf_dir))


@query("select user_id, event_type, min(value) as min_value, max(value) as max_value, count(*) as n_points from events group by 1, 2 having min(value) < 10 and max(value) > 50 and count(*) >= 3")
def suspect_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.suspect(table(spark, sf_dir, "events"), ["user_id", "event_type"])


AMBIGUOUS = "(select series_key, max(n) as max_distinct, count(*) filter (where n > 1) as n_periods_ambiguous from (select series_key, period, count(distinct round(value, 3)) as n from keyed group by 1, 2) group by 1 having max(n) > 1)"


@query(f"select * from {AMBIGUOUS}", facts=True)
def ambiguous_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.ambiguous(_keyed(spark, sf_dir))


@query(f"""select series_key, kind, count(*) as n_points from latest where kind <> 'change'
and series_key not in (select series_key from latest group by 1 having min(value) < 10 and max(value) > 49 and count(*) >= 3)
and series_key not in (select series_key from {AMBIGUOUS} where n_periods_ambiguous > 4)
group by 1, 2 having count(*) >= 3 and min(value) <> max(value)""", facts=True)
def chartable_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.chartable_at_once(_keyed(spark, sf_dir), 10, 49, 4)


MERGED = """(select measure_key, base from
 (select measure_key, min(index_base) as base from keyed where index_base <> '' group by 1 having count(distinct index_base) = 1)
 join (select measure_key from (select measure_key, period, max(value) as b from keyed where index_base = '' group by 1, 2)
       join (select measure_key, period, max(value) as k from keyed where index_base <> '' group by 1, 2) using (measure_key, period)
       group by 1 having count(*) >= 2 and count(*) filter (where abs(b - k) <= 0.9 * greatest(abs(k), 1.0)) = count(*)) using (measure_key))"""


@query(f"select * from {MERGED}", facts=True)
def base_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.base_merge(_keyed(spark, sf_dir), 0.9)


@query(f"""select measure_key, case when kind <> 'index' then '' when index_base <> '' then index_base else coalesce(base, '') end as base_norm, count(*) as n_obs, sum(value) as total
from keyed left join {MERGED} using (measure_key) group by 1, 2""", facts=True)
def base_norm_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _keyed(spark, sf_dir).groupBy("measure_key", "kind", "index_base", "period").agg(F.max("value").alias("value"), F.count("*").alias("n"), F.sum("value").alias("s"))
    points = staged(points, "points")
    return W.with_base(points, staged(W.base_merge(points, 0.9), "bases")).groupBy("measure_key", "base_norm").agg(F.sum("n").alias("n_obs"), F.sum("s").alias("total"))


@query("""select row_en, col_en, kind, max(case when y = '1995-02' then n end) as n_first, max(case when y = '2001-10' then n end) as n_last
from (select row_en, col_en, kind, period as y, count(*) as n from facts group by all) group by 1, 2, 3
having (max(case when y = '1995-02' then n end) is null) <> (max(case when y = '2001-10' then n end) is null)""", facts=True)
def classification_break_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = trade_facts(spark, sf_dir)
    wide = counts.groupBy("row_en", "col_en", "kind").agg(*(F.nullif(F.count_if(F.col("period") == p), F.lit(0).cast("long")).alias(n) for n, p in (("n_first", "1995-02"), ("n_last", "2001-10"))))
    return wide.where(F.col("n_first").isNull() != F.col("n_last").isNull())


@query("select o_orderkey, cast(floor(100 * sum(l_extendedprice) / o_totalprice) as bigint) as share from orders join lineitem on l_orderkey = o_orderkey group by o_orderkey, o_totalprice having not floor(100 * sum(l_extendedprice) / o_totalprice) between 95 and 105")
def weight_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("s"))
    share = F.floor(100 * F.col("s") / F.col("o_totalprice")).cast("long")
    return table(spark, sf_dir, "orders").join(lines, "o_orderkey").select("o_orderkey", share.alias("share")).where(~F.col("share").between(95, 105))


@query("select 'order' as what, o_orderkey as key from orders where o_orderkey not in (select l_orderkey from lineitem) union all select 'line', l_orderkey from lineitem where l_orderkey not in (select o_orderkey from orders) union all select 'customer', c_custkey from customer where c_custkey not in (select o_custkey from orders)")
def orphan_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines, customers = (table(spark, sf_dir, n) for n in ("orders", "lineitem", "customer"))
    found = [("order", orders, "o_orderkey", lines, "l_orderkey"), ("line", lines, "l_orderkey", orders, "o_orderkey"), ("customer", customers, "c_custkey", orders, "o_custkey")]
    parts = [a.join(b, a[x] == b[y], "left_anti").select(F.lit(w).alias("what"), F.col(x).alias("key")) for w, a, x, b, y in found]
    return parts[0].union(parts[1]).union(parts[2])


@query("select row_en, kind, period, count(distinct place) as n_places from facts group by 1, 2, 3 having count(distinct place) >= 8", facts=True)
def map_metric_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.place_coverage(trade_facts(spark, sf_dir))


@query("""with c as (select *, case when c_custkey % 2 = 0 then n_name else c_mktsegment end as row_l, case when c_custkey % 3 = 0 then n_name else c_mktsegment end as col_l from customer join nation on c_nationkey = n_nationkey)
select g.r_name as region, coalesce(a.n_name, b.n_name) as place, case when a.n_name is null then row_l else col_l end as metric, count(*) as n, max(c_acctbal) as max_value
from c left join nation a on a.n_name = row_l left join nation b on b.n_name = col_l join nation p on p.n_name = coalesce(a.n_name, b.n_name) join region g on g.r_regionkey = p.n_regionkey group by all""")
def regional_place_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    gazetteer = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(F.col("n_name").alias("label"), F.col("r_name").alias("region"))
    home = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    label = lambda n: F.when(F.col("c_custkey") % n == 0, F.col("n_name")).otherwise(F.col("c_mktsegment"))
    rows = table(spark, sf_dir, "customer").join(F.broadcast(home), "c_nationkey").select(label(2).alias("row_l"), label(3).alias("col_l"), "c_acctbal")
    on_row, on_col = (F.broadcast(gazetteer.select(F.col("label").alias(c))) for c in ("a", "b"))  # 25 rows by definition
    placed = rows.join(on_row, F.col("a") == F.col("row_l"), "left").join(on_col, F.col("b") == F.col("col_l"), "left").withColumn("place", F.coalesce("a", "b"))
    found = placed.join(F.broadcast(gazetteer), F.col("label") == F.col("place"))
    metric = F.when(F.col("a").isNull(), F.col("row_l")).otherwise(F.col("col_l"))
    return found.groupBy("region", "place", metric.alias("metric")).agg(F.count("*").alias("n"), F.max("c_acctbal").alias("max_value"))


@query("""select * from (select *, row_number() over (partition by category_id order by reach desc, n_periods desc, metric) as rn from
(select category_id, row_en || ' ' || col_en as metric, count(distinct place) as reach, count(distinct period) as n_periods from facts group by 1, 2)) where rn <= 8""", facts=True)
def top_metrics_per_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = trade_facts(spark, sf_dir).groupBy("category_id", F.concat_ws(" ", "row_en", "col_en").alias("metric")).agg(F.count_distinct("place").alias("reach"), F.count_distinct("period").alias("n_periods"))
    return W.top(metrics, ["category_id"], [F.desc("reach"), F.desc("n_periods"), F.col("metric")], 8).withColumn("rn", F.col("rn").cast("long"))


@query("select event_type, day, n, cast(age as bigint) as age from (select *, dense_rank() over (partition by event_type order by day desc) as age from (select event_type, strftime(ts, '%Y-%m-%d') as day, count(*) as n from events group by 1, 2)) where age <= 16")
def last_periods_dense_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))
    return days.withColumn("age", F.dense_rank().over(Window.partitionBy("event_type").orderBy(F.desc("day"))).cast("long")).where("age <= 16")


@query("""with e as (select *, strftime(ts, '%Y-%m-%d') as day from events), spec as (select distinct user_id, event_type from e),
m as (select user_id, event_type, max(day) as day from e join spec using (user_id, event_type) group by 1, 2)
select user_id, event_type, day, max(value) as value from e join m using (user_id, event_type, day) group by 1, 2, 3 having count(distinct round(value, 6)) = 1""")
def headline_single_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), "value")
    now = events.withColumn("_last", F.max("day").over(Window.partitionBy("user_id", "event_type"))).where("day = _last")
    found = now.groupBy("user_id", "event_type", "day").agg(F.max("value").alias("value"), F.count_distinct(F.round("value", 6)).alias("n"))
    return found.where("n = 1").drop("n")


@query("""select category_id, period, series_key, value, rn from (select category_id, period, series_key, value, row_number() over (partition by category_id order by abs(value) desc, series_key) as rn
from (select *, max(period) over (partition by category_id) as p from latest) where period = p) where rn <= 20""", facts=True)
def breakdown_top_abs(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = staged(_latest(spark, sf_dir).select("category_id", "period", "series_key", "value"), "latest")
    now = readings.join(readings.groupBy("category_id").agg(F.max("period").alias("period")), ["category_id", "period"])  # one row a category, in place of a window over all its readings
    return W.top(now, ["category_id"], [F.desc(F.abs("value")), F.col("series_key")], 20).withColumn("rn", F.col("rn").cast("long"))


@query("select category_id, pub_id, max_period, age from (select *, row_number() over (partition by category_id order by max_period desc, pub_id desc) as age from (select category_id, pub_id, max(period) as max_period from facts group by 1, 2)) where age <= 12", facts=True)
def recent_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.top(release_dim(spark, sf_dir).drop("n_facts"), ["category_id"], [F.desc("max_period"), F.desc("pub_id")], 12, "age").withColumn("age", F.col("age").cast("long"))


@query("select product, kind, count(distinct row_en) as n_products, count(*) as n_obs, count(distinct series_key) as n_series from latest group by 1, 2", facts=True)
def domain_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest(spark, sf_dir).groupBy("product", "kind").agg(F.count_distinct("row_en").alias("n_products"), F.count("*").alias("n_obs"), F.count_distinct("series_key").alias("n_series"))


@query("select (select count(*) from latest) as observations, (select count(*) from ranked where rn > 1) as revisions, (select count(distinct series_key) from keyed) as series, (select count(distinct category_id || pub_id) from facts) as releases", facts=True)
def warehouse_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = W.ranked(_keyed(spark, sf_dir))
    return readings.agg(F.count_if(F.col("rn") == 1).alias("observations"), F.count_if(F.col("rn") > 1).alias("revisions"), F.count_distinct("series_key").alias("series"), F.count_distinct(F.concat("category_id", "pub_id")).alias("releases"))


SERIES = """s as (select category_id, series_key, case kind when 'index' then 0 when 'value' then 1 else 2 end as tier, count(*) as n_points, max(period) as last_period from latest group by 1, 2, 3),
b as (select *, cast(substr(max(last_period) over (partition by category_id), 1, 4) as int) - cast(substr(last_period, 1, 4) as int) as behind from s)"""


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier = F.when(F.col("kind") == "index", 0).when(F.col("kind") == "value", 1).otherwise(2).alias("tier")
    rows = _latest(spark, sf_dir).groupBy("category_id", "series_key", tier).agg(F.count("*").alias("n_points"), F.max("period").alias("last_period"))
    series = staged(rows, "series")
    newest = series.groupBy("category_id").agg(F.max("last_period").alias("_newest"))
    return series.join(newest, "category_id").withColumn("behind", F.substring("_newest", 1, 4).cast("int") - F.substring("last_period", 1, 4).cast("int")).drop("_newest")


@query(f", {SERIES} select category_id, series_key, tier, n_points, last_period, behind, place from (select *, row_number() over (partition by category_id order by behind, tier, n_points desc, series_key) as place from b) where place <= 45", facts=True)
def ranked_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.top(_series(spark, sf_dir), ["category_id"], [F.col("behind"), F.col("tier"), F.desc("n_points"), F.col("series_key")], 45, "place").withColumn("place", F.col("place").cast("long"))


@query(f""", {SERIES}, p as (select *, row_number() over (partition by category_id order by tier desc, n_points, series_key) as place,
row_number() over (partition by category_id order by last_period desc, series_key) as f, row_number() over (partition by category_id order by n_points desc, series_key) as l from b),
q as (select *, row_number() over (partition by category_id order by case when f = 1 or l = 1 then 0 else 1 end, place) as slot from p)
select category_id, series_key, tier, n_points, last_period, behind, place, (f = 1 or l = 1) as guaranteed from q where slot <= 45""", facts=True)
def guaranteed_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("series_key")
    found = W.guaranteed(_series(spark, sf_dir), "category_id", [F.desc("tier"), F.col("n_points"), key], [F.desc("last_period"), key], [F.desc("n_points"), key])
    return found.withColumn("place", F.col("place").cast("long"))


@query("select user_id, event_id, value, age from (select user_id, event_id, value, row_number() over (partition by user_id order by ts desc, event_id desc) as age from events) where age <= 60")
def tail_history_60(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.top(table(spark, sf_dir, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")], 60, "age").select("user_id", "event_id", "value", F.col("age").cast("long").alias("age"))


@query("select p_name as label from part union select p_type from part")
def distinct_labels_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(F.col("p_name").alias("label")).union(part.select("p_type")).distinct()


#: Fixed order of keywords: the first that a label contains decides.
THEMES = [("ring", "jewels"), ("widget", "tools"), ("bolt", "metal"), ("gear", "metal"), ("red", "colour"), ("economy", "price")]


@query("select theme, count(*) as n, count(distinct p_brand) as brands from (select *, case " + " ".join(f"when contains(lower(p_name || ' ' || p_type), '{w}') then '{t}'" for w, t in THEMES) + " else 'nation' end as theme from part) group by 1")
def label_theme(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy(L.theme(F.concat_ws(" ", "p_name", "p_type"), THEMES, "nation").alias("theme")).agg(F.count("*").alias("n"), F.count_distinct("p_brand").alias("brands"))


#: How orders are dated in their labels; the last has too many words about its year to be a period.
_DATED = """d as (select o_orderkey, year(o_orderdate) as y, month(o_orderdate) as m, quarter(o_orderdate) as q, o_orderkey % 7 as way,
 case o_orderstatus when 'O' then 'Annual change' when 'F' then 'Price Index' else 'Relative weight' end as heading,
 case o_orderstatus when 'O' then 'change' when 'F' then 'index' else 'weight' end as kind from orders),
p as (select *, case when way in (0, 1) then y || '-Q' || q when way in (2, 3, 5) then y || '-' || lpad(cast(m as varchar), 2, '0') when way = 4 then cast(y as varchar) end as period from d)"""
_QUARTERS = ("الربع الأول", "الربع الثاني", "الربع الثالث", "الربع الرابع")
_MONTHS = ("يناير", "فبراير", "مارس", "أبريل", "مايو", "يونيو", "يوليو", "أغسطس", "سبتمبر", "أكتوبر", "نوفمبر", "ديسمبر")


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, way = F.col("o_orderdate"), F.col("o_orderkey") % 7
    year, named = F.year(day).cast("string"), lambda names, n: F.element_at(F.array(*map(F.lit, names)), n)
    label = F.when(way == 0, F.concat(year, F.lit(" Q"), F.quarter(day).cast("string"))).when(way == 1, F.concat_ws(" ", named(_QUARTERS, F.quarter(day)), year)).when(way == 2, F.date_format(day, "MMMM yyyy"))
    label = label.when(way == 3, F.date_format(day, "yyyy-MM-01")).when(way == 4, year).when(way == 5, F.concat_ws(" ", named(_MONTHS, F.month(day)), year)).otherwise(F.concat(F.lit("Orders held over since "), year))
    heading = F.when(F.col("o_orderstatus") == "O", "Annual change").when(F.col("o_orderstatus") == "F", "Price Index").otherwise("Relative weight")
    return table(spark, sf_dir, "orders").groupBy(label.alias("label"), heading.alias("heading")).agg(F.count("*").alias("n"))  # each label is read once


@query(f"with {_DATED} select period, kind, case when way = 6 then heading || ' Orders held over since' else heading end as short, count(*) as n from p group by all")
def label_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.concat_ws(" ", "heading", "label")
    read = _dated(spark, sf_dir).select(C.period(F.col("label")).alias("period"), C.kind(whole).alias("kind"), C.stable(whole).alias("short"), "n")
    return read.groupBy("period", "kind", "short").agg(F.sum("n").alias("n"))


@query(f"with {_DATED} select period, case when way = 6 then null when way in (0, 1) then y * 100 + q * 3 when way = 4 then y * 100 else y * 100 + m end as sort_key, case when way = 6 then null when way in (0, 1) then 'quarterly' when way = 4 then 'annual' else 'monthly' end as period_type, count(*) as n from p group by all")
def period_sort_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _dated(spark, sf_dir).groupBy(C.period(F.col("label")).alias("period")).agg(F.sum("n").alias("n"))
    return found.select("period", L.period_order(F.col("period")).cast("long").alias("sort_key"), L.period_type(F.col("period")).alias("period_type"), "n")


@query("""with n as (select p_partkey, p_size, string_split(p_name, ' ') as w from part), s as (select *, upper(w[1][1]) || w[1][2:] || case when len(w) > 1 then ' ' || upper(w[2][1]) || w[2][2:] else '' end as name from n)
select p_partkey, case p_partkey % 4 when 0 then name || ' (2023=100)' when 1 then name when 2 then array_to_string(w, ' ') || ' (' || (1990 + p_size % 40) || '=100)' else '2023=100' end as tidied from s where len(w) <= 2""")
def tidy_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    way, year = F.col("p_partkey") % 4, (1990 + F.col("p_size") % 40).cast("string")
    label = F.when(way == 0, F.concat(F.lit("2023=100  "), F.upper("p_name"))).when(way == 1, F.concat(F.lit(" "), F.replace(F.upper("p_name"), F.lit(" "), F.lit("  ")))).when(way == 2, F.concat(F.lit("("), year, F.lit(" = 100) - "), F.col("p_name"))).otherwise("2023=100")
    rows = table(spark, sf_dir, "part").where(F.size(F.split("p_name", " ")) <= 2)
    return rows.select("p_partkey", L.tidy(label).alias("tidied"))


@query("select p_partkey, case when p_partkey % 5 = 4 then 'Table ' || p_size else p_name end as short from part")
def strip_caption(spark: SparkSession, sf_dir: str) -> DataFrame:
    way, size = F.col("p_partkey") % 5, F.col("p_size").cast("string")
    arabic = F.translate(size, "0123456789", "٠١٢٣٤٥٦٧٨٩")
    label = F.when(way == 0, F.concat(F.lit("Table "), size, F.lit(".1 "), "p_name")).when(way == 1, F.concat(F.lit("جدول ("), arabic, F.lit("-٣) : "), "p_name")).when(way == 2, F.concat(F.lit("TABLE ["), size, F.lit("] – "), "p_name"))
    label = label.when(way == 3, F.col("p_name")).otherwise(F.concat(F.lit("Table "), size))
    return table(spark, sf_dir, "part").select("p_partkey", C.without_caption(label).alias("short"))


@query("select doc_id, translate(lower(text), 'آأإىةـ', 'ااايه') as folded from documents")
def normalize_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", L.normalized(F.col("text")).alias("folded"))


#: Labels of places: a whole label decides, else the longest run of words, the leftmost of these.
PLACES = [("small ring", "R1", "region"), ("red", "R2", "city"), ("widget", "R3", "gateway"), ("bolt", "R4", "city")]
_PLACES_SQL = "(values " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in PLACES) + ") g(label, region, kind)"


@query(f"""with n as (select distinct p_name, string_split(p_name, ' ') as w from part),
grams as (select p_name, size, pos, array_to_string(w[pos:pos + size - 1], ' ') as gram from n, unnest([3, 2, 1]) s(size), unnest(range(1, 4)) p(pos) where pos + size - 1 <= len(w)),
hits as (select p_name, region, kind, row_number() over (partition by p_name order by size desc, pos) as rn from grams join {_PLACES_SQL} on gram = label)
select p_name as label, region, kind from hits where rn = 1""")
def place_resolve_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("label")).distinct().withColumn("w", F.split("label", " "))

    def runs(n: int) -> F.Column:
        places = F.when(F.size("w") >= n, F.sequence(F.lit(1), F.size("w") - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda p: F.struct(F.lit(-n).alias("size"), p.alias("pos"), F.array_join(F.slice("w", p, n), " ").alias("gram")))

    grams = F.concat(*map(runs, (3, 2, 1)))
    found = names.select("label", F.inline(grams)).join(F.broadcast(spark.createDataFrame(PLACES, "gram string, region string, kind string")), "gram")
    return found.groupBy("label").agg(F.min_by(F.struct("region", "kind"), F.struct("size", "pos")).alias("best")).select("label", "best.region", "best.kind")


@query("select page_id, unnest(regexp_extract_all(html, 'href=\"(/[^\"]*)\"', 1)) as link from pages")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="(/[^"]*)"'), F.lit(1))).alias("link"))


@query("select page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '<[^>]+>', ' ', 'g'), '[ \\t\\r\\n\\f]+', ' ', 'g')) as title, regexp_extract(html, 'lang=\"([a-z]+)\"', 1) as lang from pages")
def page_title_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = L.collapsed(F.regexp_replace(F.regexp_extract("html", "<h1>(.*?)</h1>", 1), "<[^>]+>", " "))
    return table(spark, sf_dir, "pages").select("page_id", title.alias("title"), F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("lang"))


@query("select page_id, regexp_replace(split_part(split_part(split_part(url, '?', 1), '#', 1), '/', 5), '_fixed_[0-9]+$', '') as filename from pages")
def url_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.split_part(F.split_part(F.col("url"), F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1))
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_replace(F.split_part(path, F.lit("/"), F.lit(5)), r"_fixed_[0-9]+\z", "").alias("filename"))


@query("select sha256(text) as digest, min(doc_id) as first_doc, count(*) as n_links from documents group by 1")
def content_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy(F.sha2("text", 256).alias("digest")).agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n_links"))


YEARS = range(1995, 2002)
_GRID = "grid as (select place, " + ", ".join(f"max(case when period like '{y}%' then value end) as y{y}" for y in YEARS) + " from facts group by 1)"


@query(f", {_GRID} select place, substr(name, 2) as period, value from (unpivot grid on " + ", ".join(f"y{y}" for y in YEARS) + " into name name value value)", facts=True)
def sheet_unpivot_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = trade_facts(spark, sf_dir).groupBy("place").agg(*(F.max(F.when(F.startswith("period", F.lit(str(y))), F.col("value"))).alias(f"y{y}") for y in YEARS))
    return grid.unpivot("place", [f"y{y}" for y in YEARS], "name", "value").where("value is not null").select("place", F.substring("name", 2, 4).alias("period"), "value")


@query("select period, kind as label, max(value) as value from facts group by 1, 2", facts=True)
def sheet_row_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = trade_facts(spark, sf_dir).groupBy("period").agg(*(F.max(F.when(F.col("kind") == k, F.col("value"))).alias(k) for k in ("index", "change", "value")))
    return wide.unpivot("period", ["index", "change", "value"], "label", "value").where("value is not null")


@query("select sheet, col, coalesce(head, last_value(head ignore nulls) over (partition by sheet order by col)) as heading, head is not null as owned from (select conv_id as sheet, turn as col, case when turn % 3 = 0 then role || turn end as head from conversations)")
def merged_header_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("sheet"), F.col("turn").alias("col"), F.when(F.col("turn") % 3 == 0, F.concat("role", F.col("turn").cast("string"))).alias("head"))
    fill = F.last("head", ignorenulls=True).over(Window.partitionBy("sheet").orderBy("col"))
    return cells.select("sheet", "col", fill.alias("heading"), F.col("head").isNotNull().alias("owned"))


@query("select count(*) as n, count(*) filter (where l_quantity = floor(l_quantity) and l_quantity between 1 and 20) as bare, cast(round(100000.0 * count(*) filter (where l_quantity = floor(l_quantity) and l_quantity between 1 and 20) / greatest(count(*), 1)) as bigint) as per_100k from lineitem")
def bare_year_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = F.count_if((F.col("l_quantity") == F.floor("l_quantity")) & F.col("l_quantity").between(1, 20))
    counted = table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n"), bare.alias("bare"))
    return counted.withColumn("per_100k", F.round(100000.0 * F.col("bare") / F.greatest("n", F.lit(1))).cast("long"))


@query("select conv_id, turn, role, octet_length(encode(text)) as bytes from conversations")
def catalog_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role", F.octet_length("text").cast("long").alias("bytes"))).alias("turns"))
    return nested.select("conv_id", F.inline("turns"))


@query("select conv_id, max(turn) + 1 as claimed, count(*) as retrieved from conversations group by 1 having max(turn) + 1 > count(*)")
def listing_shortfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "conversations").groupBy("conv_id").agg((F.max("turn") + 1).alias("claimed"), F.count("*").alias("retrieved"))
    return found.where("claimed > retrieved")


@query("select user_id as arc, row_number() over w - 1 as i, sum(event_id % 9 - 4) over w * 2.0 + 10 as x, sum(event_id % 5 - 2) over w * 3.0 + 20 as y from events window w as (partition by user_id order by event_id)")
def topo_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    deltas = table(spark, sf_dir, "events").select(F.col("user_id").alias("arc"), F.col("event_id").alias("i"), (F.col("event_id") % 9 - 4).alias("dx"), (F.col("event_id") % 5 - 2).alias("dy"))
    return shapes.decoded(deltas, (2.0, 3.0), (10.0, 20.0)).select("arc", F.col("i").cast("long").alias("i"), "x", "y")

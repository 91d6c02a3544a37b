"""Queries of crawl records, rings of shapes and places, over data that Spark derives from the trade tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import places as P
from tidemark.operators import crawl, shapes
from tidemark.plans.catalogue import query
from tidemark.sinks.staging import folder
from tidemark.sources.tables import table

_LISTED = "customer long, page long, status string, price double"


def _store(spark: SparkSession, sf_dir: str) -> crawl.Store:
    """Orders as records by customer, in three batches that come out of order and one of them twice."""
    store = crawl.Store(spark, f"{folder(spark)}/tidemark-records-{uuid.uuid4().hex}", _LISTED, ["customer"], ["page"], parts=16)
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("page"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    for batch in (2, 0, 1, 0):
        store.put(orders.where(F.col("page") % 3 == batch).where("page % 7 <> 3"))
    return store


_KEPT = "(select o_custkey as customer, max(o_orderkey) as page, arg_max(o_orderstatus, o_orderkey) as status, arg_max(o_totalprice, o_orderkey) as price from orders where o_orderkey % 7 <> 3 group by 1)"


@query(f"select * from {_KEPT}")
def crawl_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir).rows()


@query(f"select c_custkey as customer, c_mktsegment from customer where c_custkey not in (select customer from {_KEPT})")
def crawl_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer"), "c_mktsegment")
    return _store(spark, sf_dir).pending(wanted)


@query("select o_custkey, claimed, retrieved, claimed - retrieved as missing from (select o_custkey, count(*) as claimed, count(*) filter (where o_orderkey % 7 <> 3) as retrieved from orders group by 1) where retrieved < claimed and retrieved > 0")
def crawl_shortfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of whose orders the listing gave only a part."""
    orders = table(spark, sf_dir, "orders")
    claims = orders.groupBy("o_custkey").agg(F.count("*").alias("claims"))
    return crawl.shortfall(orders.where("o_orderkey % 7 <> 3").join(claims, "o_custkey"), ["o_custkey"], "claims", "o_orderkey")


def _topology(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as arcs, their lines the deltas; customers as shapes with a ring a status and, if multiple, a polygon a priority."""
    deltas = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("arc"), F.col("l_extendedprice").cast("long").alias("i"), (F.col("l_quantity").cast("long") - 25).alias("dx"), (F.col("l_partkey") % 9 - 4).alias("dy"))
    arcs = deltas.groupBy("arc", "i").agg(F.sum("dx").alias("dx"), F.sum("dy").alias("dy"))
    index = F.when(F.col("o_orderkey") % 2 == 1, F.bitwise_not("o_orderkey")).otherwise(F.col("o_orderkey"))
    multiple = F.col("o_custkey") % 3 == 0
    rings = table(spark, sf_dir, "orders").groupBy("o_custkey", F.when(multiple, F.col("o_orderpriority")).otherwise("").alias("p"), "o_orderstatus").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", index.alias("index"))))["index"].alias("ring"))
    polygons = rings.groupBy("o_custkey", "p").agg(F.sort_array(F.collect_list(F.struct("o_orderstatus", "ring")))["ring"].alias("rings"))
    shaped = polygons.groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("p", "rings")))["rings"].alias("arcs"))
    key = F.col("o_custkey")
    geometries = shaped.select(
        F.when(key % 10 == 9, "-99").otherwise(key.cast("string")).alias("id"), F.when(key % 11 != 5, F.concat(F.lit("Shape "), key.cast("string"))).alias("name"),
        F.when(key % 13 == 7, "Point").when(multiple, "MultiPolygon").otherwise("Polygon").alias("type"), "arcs",
    )
    return geometries, shapes.decoded(arcs, (2.0, 3.0), (10.0, 20.0))


_RINGED = """o as (select *, case when o_custkey % 3 = 0 then o_orderpriority else '' end as p from orders where o_custkey % 10 <> 9 and o_custkey % 11 <> 5 and o_custkey % 13 <> 7),
t as (select o_custkey, dense_rank() over (partition by o_custkey order by p) - 1 as polygon, dense_rank() over (partition by o_custkey, p order by o_orderstatus) - 1 as ring, o_orderkey from o),
d as (select l_orderkey, cast(floor(l_extendedprice) as bigint) as i, sum(cast(l_quantity as bigint) - 25) as dx, sum(l_partkey % 9 - 4) as dy from lineitem group by all),
a as (select l_orderkey, row_number() over w as n, count(*) over (partition by l_orderkey) as len, sum(dx) over w * 2.0 + 10 as x, sum(dy) over w * 3.0 + 20 as y from d window w as (partition by l_orderkey order by i)),
m as (select t.*, a.x, a.y, case when o_orderkey % 2 = 1 then len - n else n - 1 end as pos from t join a on l_orderkey = o_orderkey),
f as (select *, min(o_orderkey) over (partition by o_custkey, polygon, ring) as first_arc from m),
points as (select cast(o_custkey as varchar) as id, 'Shape ' || o_custkey as name, polygon, ring, row_number() over (partition by o_custkey, polygon, ring order by o_orderkey, pos) - 1 as seq, x, y from f where pos > 0 or o_orderkey = first_arc)"""


@query(f"with {_RINGED} select * from points")
def map_ring_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.ring_points(*_topology(spark, sf_dir))


@query(f"with {_RINGED} select id, name, max(polygon) + 1 as polygons, count(distinct (polygon, ring)) as rings, count(*) as points, min(x) as min_x, max(x) as max_x, min(y) as min_y, max(y) as max_y from points group by all")
def map_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.bounds(shapes.ring_points(*_topology(spark, sf_dir)))


def _spelt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a label of their nation, spelt in six ways, of which the fifth names no place."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.lower("n_name").alias("n"))
    way = F.col("c_custkey") % 6
    label = F.when(way == 0, F.concat(F.lit("Al-"), F.upper("n"))).when(way == 1, F.concat("n", F.lit(" (Région)"))).when(way == 2, F.concat(F.lit("Trade of the city of "), F.upper("n"), F.lit(", total")))
    label = label.when(way == 3, F.concat(F.lit("EL "), F.translate("n", "aio", "áïö"), F.lit("-Province"))).when(way == 4, F.col("c_mktsegment")).otherwise(F.concat(F.lit("`"), "n", F.lit("’")))
    return table(spark, sf_dir, "customer").join(nation, "c_nationkey").select("c_custkey", label.alias("label"), "c_acctbal")


def _known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as regions, and again as cities where the key is odd: a later entry takes the place of an earlier one."""
    nation = table(spark, sf_dir, "nation")
    rows = nation.select(F.col("n_name").alias("label"), F.col("n_regionkey").cast("string").alias("region"), F.lit("region").alias("kind"), F.lit(1).alias("rank"))
    later = nation.where("n_nationkey % 2 = 1").select(F.concat(F.lit("Al "), F.initcap(F.lower("n_name")), F.lit(" City")), F.col("n_regionkey").cast("string"), F.lit("city"), F.lit(2))
    return P.gazetteer(rows.union(later))


_RESOLVED = """(select c_custkey, c_acctbal, cast(n_regionkey as varchar) as region, case when n_nationkey % 2 = 1 then 'city' else 'region' end as kind,
 case c_custkey % 6 when 0 then 'Al-' || n_name when 1 then lower(n_name) || ' (Région)' when 2 then 'Trade of the city of ' || n_name || ', total'
  when 3 then 'EL ' || translate(lower(n_name), 'aio', 'áïö') || '-Province' else '`' || lower(n_name) || '’' end as label from customer join nation on c_nationkey = n_nationkey where c_custkey % 6 <> 4)"""


@query(f"select c_custkey, label, region, kind from {_RESOLVED}")
def place_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.resolved(_spelt(spark, sf_dir), _known(spark, sf_dir)).select("c_custkey", "label", "region", "kind")


@query(f"select kind, count(*) as n_values, count(distinct region) as n_regions, (select count(*) from customer) as n_all, cast(floor(100 * count(*) / (select count(*) from customer)) as bigint) as percent from {_RESOLVED} group by rollup (kind)")
def place_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of a table its labels place, for each kind of place and for all."""
    rows = _spelt(spark, sf_dir)
    placed = P.resolved(rows, _known(spark, sf_dir)).rollup("kind").agg(F.count("*").alias("n_values"), F.count_distinct("region").alias("n_regions"))
    whole = rows.agg(F.count("*").alias("n_all"))  # one row, so the join is no product
    return placed.join(F.broadcast(whole), F.lit(True)).withColumn("percent", F.floor(100 * F.col("n_values") / F.col("n_all")).cast("long"))

"""Topologies as tables: arcs of deltas decoded and stitched to the rings of polygons, a row for each point."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: ``geometries``: ``id``, ``name``, ``type`` and ``arcs``, polygons of rings of arc indices; a Polygon is one polygon.
GEOMETRIES = "id string, name string, type string, arcs array<array<array<bigint>>>"
KINDS = ("Polygon", "MultiPolygon")


def decoded(deltas: DataFrame, scale: tuple[float, float] = (1.0, 1.0), shift: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """``(arc, i, dx, dy)`` to ``(arc, i, back, x, y)``: sums of the deltas so far, scaled and shifted; ``back`` counts from the arc's end."""
    far = Window.partitionBy("arc").orderBy("i")
    points = deltas.select("arc", "i", F.sum("dx").over(far).alias("px"), F.sum("dy").over(far).alias("py"), F.row_number().over(far).alias("n"), F.count("*").over(Window.partitionBy("arc")).alias("all"))
    return points.select("arc", (F.col("n") - 1).alias("i"), (F.col("all") - F.col("n")).alias("back"), (F.col("px") * scale[0] + shift[0]).alias("x"), (F.col("py") * scale[1] + shift[1]).alias("y"))


def placed(geometries: DataFrame) -> DataFrame:
    """A row for each arc of a ring: ``(id, name, polygon, ring, turn, arc, reverse)``.

    Geometries of other kinds, without a name or an id, and the placeholder ``-99`` are left out. An index below zero is
    the arc ``~index`` taken backwards.
    """
    named = geometries.where((F.coalesce("id", F.lit("")) != "") & (F.col("id") != "-99") & (F.coalesce("name", F.lit("")) != "") & F.col("type").isin(*KINDS))
    polygons = named.select("id", "name", "type", F.posexplode("arcs").alias("polygon", "rings"))
    rings = polygons.select("id", "name", "polygon", F.posexplode("rings").alias("ring", "indices"))
    turns = rings.select("id", "name", "polygon", "ring", F.posexplode("indices").alias("turn", "index"))
    back = F.col("index") < 0
    return turns.select("id", "name", "polygon", "ring", "turn", F.when(back, F.bitwise_not("index")).otherwise(F.col("index")).alias("arc"), back.alias("reverse"))


def ring_points(geometries: DataFrame, points: DataFrame) -> DataFrame:
    """``(id, name, polygon, ring, seq, x, y)``: the points of each ring in order, ``seq`` from 0 without a gap.

    ``points`` is what ``decoded`` gives. Arcs meet in a shared point, which only the arc before it keeps. An arc that
    does not exist adds nothing. Points are numbered from the lengths of the arcs before them, so a long ring is no one
    task's list: only a row an arc is put in order.
    """
    lengths = points.where("back = 0").select("arc", (F.col("i") + 1).alias("length"))
    turns = placed(geometries).join(lengths, "arc")
    before = Window.partitionBy("id", "polygon", "ring").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    begun = turns.withColumn("first", F.count("*").over(before) == 0).withColumn("start", F.coalesce(F.sum(F.col("length") - 1).over(before), F.lit(0)))
    at = F.when(F.col("reverse"), F.col("back")).otherwise(F.col("i"))
    met = begun.join(points, "arc").withColumn("at", at).where(F.col("first") | (F.col("at") > 0))
    return met.select("id", "name", "polygon", "ring", (F.col("start") + F.col("at")).cast("long").alias("seq"), "x", "y")


def bounds(ringed: DataFrame) -> DataFrame:
    """The box of each geometry and how many points, rings and polygons it has."""
    rings = ringed.groupBy("id", "name", "polygon", "ring").agg(F.count("*").alias("n"), *(f(c).alias(f"{w}_{c}") for c in "xy" for f, w in ((F.min, "min"), (F.max, "max"))))
    ends = (f(f"{w}_{c}").alias(f"{w}_{c}") for c in "xy" for f, w in ((F.min, "min"), (F.max, "max")))
    return rings.groupBy("id", "name").agg((F.max("polygon") + 1).cast("long").alias("polygons"), F.count("*").alias("rings"), F.sum("n").alias("points"), *ends)

"""Distances on the sphere, a grid of tiles as an index of points, and nearest neighbours by rings of tiles.

Tiles are rows of equal height, each cut into columns by a scale of its own, so that a circle touches few of them at
any latitude. Points and circles meet by equal tiles only, never all with all. Longitudes are from -180 to 180.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.textkeys import haversine_m as haversine
from ..staging import broadcast_if_small, released, staged

EARTH_M = 6_371_000.0
#: Metres to a degree of latitude on that sphere.
DEGREE_M = EARTH_M * 3.141592653589793 / 180
FAR_M = 2.1e7


def _row(lat: Column, side: Column) -> Column:
    return F.floor(lat * DEGREE_M / side)


def _column(lng: Column, row: Column, side: Column) -> Column:
    edge = F.least(F.lit(89.0), F.greatest(F.abs(row), F.abs(row + 1)) * side / DEGREE_M)
    return F.floor(lng * DEGREE_M * F.cos(F.radians(edge)) / side)


def tile_of(lat: Column, lng: Column, side: Column) -> Column:
    """The tile (row, col) of about ``side`` metres that a point is in."""
    row = _row(lat, side)
    return F.struct(row.alias("row"), _column(lng, row, side).alias("col"))


def tiles_around(lat: Column, lng: Column, radius: Column, side: Column) -> Column:
    """All tiles that a circle touches; one that reaches a pole touches all columns of its rows, and one across the date line goes on at the other end."""
    up = radius * 1.0001 / DEGREE_M
    top = F.abs(lat) + up
    aside = F.when(top >= 89, 180.0).otherwise(up / F.cos(F.radians(F.least(F.lit(89.0), top))))
    low, high = lng - aside, lng + aside
    part = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    whole, none = part(F.lit(-180.0), F.lit(180.0)), part(F.lit(1.0), F.lit(0.0))
    spans = F.array(
        F.when(aside >= 180, whole).otherwise(part(F.greatest(low, F.lit(-180.0)), F.least(high, F.lit(180.0)))),
        F.when((aside < 180) & (low < -180), part(low + 360, F.lit(180.0))).otherwise(none),
        F.when((aside < 180) & (high > 180), part(F.lit(-180.0), high - 360)).otherwise(none),
    )
    row = lambda r: F.flatten(F.transform(F.filter(spans, lambda x: x["a"] <= x["b"]), lambda x: F.transform(F.sequence(_column(x["a"], r, side), _column(x["b"], r, side)), lambda c: F.struct(r.alias("row"), c.alias("col")))))
    return F.array_distinct(F.flatten(F.transform(F.sequence(_row(lat - up, side), _row(lat + up, side)), row)))


def _first_side(places: DataFrame, most: int = 8, levels: int = 12) -> float:
    """The largest tile in which a place has ``most`` others around it on the mean; all levels are counted in one aggregation."""
    level = F.explode(F.sequence(F.lit(0), F.lit(levels)))
    side = F.pow(F.lit(4.0), F.col("level"))
    n = places.select("lat", "lng", level.alias("level")).groupBy("level", tile_of(F.col("lat"), F.col("lng"), side).alias("tile")).agg(F.count("*").cast("double").alias("n"))
    crowd = n.groupBy("level").agg((F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("mean")).where(F.col("mean") <= most)
    return 4.0 ** (crowd.agg(F.max("level")).first()[0] or 0)


def nearest(points: DataFrame, id_col: str = "id", lat: str = "lat", lng: str = "lng") -> DataFrame:
    """(id, nearest, metres) for every point with a place: the nearest other point, the lower id of equally near ones; a point alone in the table has none.

    Points of one place fold to one. Each round looks at the tiles around the places that are still open; one whose
    nearest is within a tile's side is done, for nothing beyond is nearer. Then tiles are four times as wide: the open
    places lie farther apart than the last side, so no tile meets more than a few of them, however many points it has.
    """
    p = points.select(F.col(id_col).alias("id"), F.col(lat).cast("double").alias("lat"), F.col(lng).cast("double").alias("lng")).where("id IS NOT NULL AND lat IS NOT NULL AND lng IS NOT NULL")
    p = staged(p, "points")
    places = staged(p.groupBy("lat", "lng").agg(F.min("id").alias("id"), F.max("id").alias("last")), "places")
    side, parts = _first_side(places), []
    todo = places.select("id", "lat", "lng")
    todo.staged_rows = places.staged_rows
    while todo.staged_rows and side < 4 * FAR_M:
        s = F.lit(side)
        around = todo.select("id", F.col("lat").alias("a"), F.col("lng").alias("b"), F.explode(tiles_around(F.col("lat"), F.col("lng"), s, s)).alias("tile"))
        there = places.select(F.col("id").alias("other"), "lat", "lng", tile_of(F.col("lat"), F.col("lng"), s).alias("tile"))
        met = around.join(there, "tile").where("id <> other").withColumn("metres", haversine(F.col("a"), F.col("b"), F.col("lat"), F.col("lng")))
        found = staged(met.where(F.col("metres") <= s).groupBy("id").agg(F.min(F.struct("metres", "other")).alias("n")), "nearest")
        parts.append(found)
        rest = staged(todo.join(broadcast_if_small(found.select("id")) if found.staged_rows else found.select("id"), "id", "left_anti"), "open-places")
        if len(parts) > 1:
            released(todo)
        todo, side = rest, side * 4
    if len(parts):
        released(todo)
    found = reduce(DataFrame.unionByName, parts) if parts else places.select("id", F.struct(F.lit(0.0).alias("metres"), F.col("id").alias("other")).alias("n")).limit(0)
    alone = places.where("id = last").join(found, "id", "left").select("id", F.col("n.other").alias("nearest"), F.col("n.metres").alias("metres"))
    # Of several points at one place the lowest is nearest to all others, and the next lowest to it.
    shared = p.join(places.where("id < last").select("lat", "lng", F.col("id").alias("first")), ["lat", "lng"])
    second = shared.where("id > first").groupBy("first").agg(F.min("id").alias("second"))
    others = shared.where("id > first").select("id", F.col("first").alias("nearest"))
    return alone.unionByName(others.union(second).select("id", "nearest", F.lit(0.0).alias("metres")))

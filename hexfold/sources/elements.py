"""Layers of staged map elements, as ``layers.parse_osm_elements`` gives them (osm_id, kind, points, tags).

Every layer keeps one row per element; an element that the layer does not want
or cannot read drops out.  Tags that are missing are null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexfold.functions import classify
from hexfold.operators import tables
from hexfold.sources import layers


def _tag(name: str) -> Column:
    return F.col("tags")[name]


def landuse_layer(elements: DataFrame) -> DataFrame:
    """osm_id, points, landuse_type of polygons with a known tag."""
    return elements.filter("kind = 'polygon'").select("osm_id", "points", classify.landuse_tag(F.col("tags")).alias("landuse_type")).filter("landuse_type is not null")


def settlement_layer(elements: DataFrame) -> DataFrame:
    """osm_id, lon, lat, name, place_type, population of places.

    Population that is no whole number is 0; villages of 1 to 499 people go; a
    name falls back to the English one, then to nothing.
    """
    place = F.when(_tag("place").isin("city", "town"), _tag("place")).otherwise("village")
    people = F.coalesce(F.expr("try_cast(trim(tags['population']) as bigint)"), F.lit(0))
    made = elements.filter((F.col("kind") == "point") & _tag("place").isin("city", "town", "village"))
    made = made.select("osm_id", F.col("points")[0]["lon"].alias("lon"), F.col("points")[0]["lat"].alias("lat"), F.coalesce(_tag("name"), _tag("name:en"), F.lit("")).alias("name"), place.alias("place_type"), people.alias("population"))
    return made.filter(~((F.col("place_type") == "village") & F.col("population").between(1, 499)))


def road_layer(elements: DataFrame) -> DataFrame:
    """osm_id, points, road_level of lines with a highway tag."""
    return elements.filter((F.col("kind") == "line") & _tag("highway").isNotNull()).select("osm_id", "points", layers.road_level(_tag("highway")).alias("road_level"))


def rail_layer(elements: DataFrame) -> DataFrame:
    """osm_id, points, rail_level of lines with a railway tag."""
    return elements.filter((F.col("kind") == "line") & _tag("railway").isNotNull()).select("osm_id", "points", layers.rail_level(_tag("railway"), _tag("gauge"), _tag("tracks")).alias("rail_level"))


def waterway_layer(elements: DataFrame, *keep: Column) -> DataFrame:
    """osm_id, points, waterway_type, name and ``keep`` of named rivers and canals."""
    named = F.coalesce(_tag("name"), F.lit("")) != ""
    return elements.filter((F.col("kind") == "line") & _tag("waterway").isin("river", "canal") & named).select("osm_id", "points", _tag("waterway").alias("waterway_type"), _tag("name").alias("name"), *keep)


def bridge_layer(elements: DataFrame) -> DataFrame:
    """osm_id, lon, lat, name: the centres of bridges of roads and rails."""
    wanted = (F.col("kind") == "point") & (_tag("bridge") == "yes") & (_tag("highway").isNotNull() | _tag("railway").isNotNull()) & ~F.col("osm_id").startswith("node/")
    return elements.filter(wanted).select("osm_id", F.col("points")[0]["lon"].alias("lon"), F.col("points")[0]["lat"].alias("lat"), F.coalesce(_tag("name"), F.lit("")).alias("name"))


def city_layer(places: DataFrame) -> DataFrame:
    """lon, lat, name, population of a table of populated places (NAME, POP_MAX)."""
    return places.select("lon", "lat", F.col("NAME").alias("name"), F.col("POP_MAX").cast("long").alias("population"))


def line_points(layer: DataFrame, *keep: str) -> DataFrame:
    """osm_id, ``keep``, seq, lon, lat of the points of lines."""
    return layer.select("osm_id", *keep, F.posexplode("points").alias("seq", "p")).select("osm_id", *keep, "seq", "p.lon", "p.lat")


def line_segments(layer: DataFrame, *keep: str) -> DataFrame:
    """osm_id, ``keep``, lon1, lat1, lon2, lat2 of consecutive points of lines; a line's row has all of them, so no row is moved."""
    pairs = F.arrays_zip(F.slice("points", F.lit(1), F.size("points") - 1).alias("a"), F.slice("points", F.lit(2), F.size("points") - 1).alias("b"))
    e = layer.filter("size(points) > 1").select("osm_id", *keep, F.explode(pairs).alias("e"))
    return e.select("osm_id", *keep, *[F.col(f"e.{p}.{c}").alias(f"{c}{n}") for n, p in ((1, "a"), (2, "b")) for c in ("lon", "lat")])


def ring_segments(layer: DataFrame) -> DataFrame:
    """fid (the osm_id), x1, y1, x2, y2 of closed rings."""
    pairs = F.arrays_zip(F.slice("points", F.lit(1), F.size("points") - 1).alias("a"), F.slice("points", F.lit(2), F.size("points") - 1).alias("b"))
    e = layer.select(F.col("osm_id").alias("fid"), F.explode(pairs).alias("e"))
    return e.select("fid", F.col("e.a.lon").alias("x1"), F.col("e.a.lat").alias("y1"), F.col("e.b.lon").alias("x2"), F.col("e.b.lat").alias("y2"))


def ring_areas(segments: DataFrame) -> DataFrame:
    """fid, area in square degrees, from the segments of one ring in order round it."""
    twice = F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1"))
    return segments.groupBy("fid").agg((F.abs(twice) / 2).alias("area"))


def ring_area(points: Column) -> Column:
    """Area in square degrees of one closed ring of points."""
    n = F.size(points) - 1
    pairs = F.zip_with(F.slice(points, F.lit(1), n), F.slice(points, F.lit(2), n), lambda a, b: a["lon"] * b["lat"] - b["lon"] * a["lat"])
    return F.abs(F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)) / 2


RELATION = "type string, id long, tags map<string, string>, members array<struct<type: string, ref: long, role: string, geometry: array<struct<lon: double, lat: double>>>>"


def relation_segments(staged: DataFrame, text: str = "element") -> DataFrame:
    """fid (the osm_id), role, x1, y1, x2, y2 of the member ways of staged multipolygon and boundary relations.

    Ways need no order and no direction, outer and inner ones no assembly: the
    bag of their segments has the relation's parity if all its rings close.
    ``parse_osm_elements`` leaves relations out; this is how they are asked for.
    """
    e = layers.read_json(staged, text, RELATION).filter("type = 'relation'")
    e = e.filter(F.col("tags")["type"].isin("multipolygon", "boundary"))
    way = e.select(F.concat_ws("/", "type", F.col("id").cast("string")).alias("fid"), F.explode("members").alias("m")).filter("m.type = 'way' and size(m.geometry) >= 2")
    points = F.col("m.geometry")
    pairs = F.arrays_zip(F.slice(points, F.lit(1), F.size(points) - 1).alias("a"), F.slice(points, F.lit(2), F.size(points) - 1).alias("b"))
    each = way.select("fid", F.coalesce("m.role", F.lit("")).alias("role"), F.explode(pairs).alias("p"))
    return each.select("fid", "role", F.col("p.a.lon").alias("x1"), F.col("p.a.lat").alias("y1"), F.col("p.b.lon").alias("x2"), F.col("p.b.lat").alias("y2"))


def closed(segments: DataFrame, strict: bool = False) -> DataFrame:
    """The segments of features whose rings all close; with ``strict`` any other is an error, so that no territory is lost unseen."""
    open_ = tables.open_ends(segments).select("fid").distinct()
    if strict:
        lost = [r[0] for r in open_.orderBy("fid").limit(5).collect()]
        if lost:
            raise ValueError(f"rings that do not close, such as those of {lost}")
    return segments.join(open_, "fid", "left_anti")

"""Map layers as tables: staged element parsing, slices, and layers over the driver's tables.

The ``*_SQL`` texts are integer arithmetic over the given tables and run alike
in Spark SQL and in other SQL engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SETTLEMENTS_SQL = """SELECT c_custkey AS k, c_name AS name,
 4.0e0 + ((c_custkey * 7919) % 10000) / 1e4 AS lon, 50.5e0 + ((c_custkey * 10427) % 5000) / 1e4 AS lat,
 CASE WHEN c_custkey % 23 = 0 THEN 'city' WHEN c_custkey % 4 = 0 THEN 'town' ELSE 'village' END AS place_type,
 CAST(CASE WHEN c_custkey % 5 = 0 THEN 0 WHEN c_custkey % 97 = 1 THEN 300001 + (c_custkey * 31) % 900000
  WHEN c_custkey % 11 = 2 THEN 50000 + (c_custkey * 37) % 250000 WHEN c_custkey % 3 = 1 THEN 2000 + (c_custkey * 41) % 48000
  ELSE 500 + (c_custkey * 43) % 1500 END AS BIGINT) AS population FROM customer"""

LANDUSE_SQL = """SELECT p_partkey AS fid, CASE WHEN p_partkey % 2 = 0 THEN 'rect' ELSE 'diamond' END AS shape,
 4.0e0 + ((p_partkey * 6151) % 10000) / 1e4 AS cx, 50.5e0 + ((p_partkey * 8581) % 5000) / 1e4 AS cy,
 4e-3 + p_size * 6e-4 AS hw, 3e-3 + p_size * 4e-4 AS hh,
 CASE WHEN p_type LIKE 'MEDIUM%' THEN 'farmland' WHEN p_type LIKE 'STANDARD%' THEN 'forest' WHEN p_type LIKE 'LARGE%' THEN 'residential'
  WHEN p_type LIKE 'PROMO%' THEN 'industrial' WHEN p_type LIKE 'SMALL%' THEN 'wetland' WHEN p_partkey % 4 = 0 THEN 'sand'
  WHEN p_partkey % 4 = 1 THEN 'beach' WHEN p_partkey % 4 = 2 THEN 'heath' ELSE 'quarry' END AS landuse_type FROM part"""

COUNTRIES_SQL = """SELECT concat('C', CASE WHEN n_nationkey < 10 THEN '0' ELSE '' END, CAST(n_nationkey AS STRING)) AS code,
 4.0e0 + (n_nationkey % 5) * 0.2e0 + 0.02e0 AS x0, 50.5e0 + CAST(floor(n_nationkey / 5e0) AS INT) * 0.1e0 + 0.01e0 AS y0,
 4.0e0 + (n_nationkey % 5) * 0.2e0 + 0.18e0 AS x1, 50.5e0 + CAST(floor(n_nationkey / 5e0) AS INT) * 0.1e0 + 0.09e0 AS y1
 FROM nation"""

TERRAIN_SQL = """SELECT p_partkey AS k, CAST((p_partkey * 37) % 3300 - 50 AS DOUBLE) AS elev, CAST((p_partkey * 13) % 260 AS DOUBLE) / 10e0 AS slope,
 CAST(25 + (p_partkey * 7) % 48 AS DOUBLE) AS lat, CAST((p_partkey * 11) % 50 - 10 AS DOUBLE) AS lon,
 p_partkey % 9 = 0 AS water, p_partkey % 13 = 0 AS lake, p_partkey % 6 = 0 AS coastal,
 CASE p_partkey % 14 WHEN 0 THEN 'glacier' WHEN 1 THEN 'beach' WHEN 2 THEN 'industrial' WHEN 3 THEN 'wetland' WHEN 4 THEN 'forest'
  WHEN 5 THEN 'sand' WHEN 6 THEN 'heath' WHEN 7 THEN 'farmland' WHEN 8 THEN 'grass' WHEN 9 THEN 'residential' WHEN 10 THEN 'quarry' WHEN 11 THEN 'military' END AS landuse,
 CASE WHEN p_partkey % 31 = 0 THEN 'city' WHEN p_partkey % 29 = 0 THEN 'town' END AS place,
 CAST((p_partkey * 4421) % 400000 AS BIGINT) AS population FROM part"""

WAYS_SQL = """SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 2 THEN 'rail' WHEN 3 THEN 'river' WHEN 4 THEN 'canal' ELSE 'road' END AS kind,
 concat('W', CAST(o_custkey % 40 AS STRING)) AS name, CAST(o_orderkey % 12 AS INT) AS scalerank,
 CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'motorway' WHEN '2' THEN 'trunk' WHEN '3' THEN 'primary' WHEN '4' THEN 'secondary' ELSE 'track' END AS highway,
 CASE WHEN o_orderkey % 7 = 0 THEN 'narrow_gauge' ELSE 'rail' END AS railway, CAST(1 + o_orderkey % 3 AS INT) AS tracks,
 CASE WHEN o_orderkey % 13 = 0 THEN 760 ELSE 1435 END AS gauge FROM orders"""

WAY_POINTS_SQL = """SELECT l_orderkey AS k, row_number() OVER w AS seq,
 4.0e0 + ((l_orderkey * 3571) % 10000) / 1e4 + CAST(sum(CAST(l_quantity AS BIGINT) - 25) OVER w AS BIGINT) * 4e-4 AS lon,
 50.5e0 + ((l_orderkey * 4561) % 5000) / 1e4 + CAST(sum(CAST(l_partkey % 51 AS BIGINT) - 25) OVER w AS BIGINT) * 3e-4 AS lat
 FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice ROWS UNBOUNDED PRECEDING)"""


def layer(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A layer from its SQL over one of the given tables."""
    name = sql.rsplit(" FROM ", 1)[1].split()[0] if " FROM " in sql else ""
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(sql.replace(f"FROM {name}", "FROM {given}"), given=table)


def rings(shapes: DataFrame) -> DataFrame:
    """Segment bag (fid, x1, y1, x2, y2) of rectangles and diamonds given by centre and half sizes."""
    cx, cy, hw, hh = (F.col(c) for c in ("cx", "cy", "hw", "hh"))
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    rect = F.array(point(cx - hw, cy - hh), point(cx + hw, cy - hh), point(cx + hw, cy + hh), point(cx - hw, cy + hh))
    diamond = F.array(point(cx - hw, cy), point(cx, cy - hh), point(cx + hw, cy), point(cx, cy + hh))
    ring = F.when(F.col("shape") == "rect", rect).otherwise(diamond)
    each = shapes.select("fid", ring.alias("ring")).select("fid", "ring", F.posexplode("ring").alias("i", "a"))
    return each.select("fid", F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("ring")[F.pmod(F.col("i") + 1, F.lit(4))]["x"].alias("x2"), F.col("ring")[F.pmod(F.col("i") + 1, F.lit(4))]["y"].alias("y2"))


def road_level(highway: Column) -> Column:
    """The tags of highways and of paved roads."""
    return F.when(highway.isin("motorway", "trunk", "motorway_link", "trunk_link"), "highway").when(highway.isin("primary", "secondary", "primary_link", "secondary_link"), "paved").otherwise("none")


def rail_level(railway: Column, gauge: Column, tracks: Column) -> Column:
    width, lines = F.try_to_number(gauge.cast("string"), F.lit("999999")), tracks.cast("int")
    return F.when((railway == "narrow_gauge") | (width < 1000), "narrow").when(lines >= 2, "double").otherwise("standard")


def clip_to_box(layer: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """Features whose envelope (min_x ... max_y) meets the box; nothing is cut."""
    return layer.filter((F.col("min_x") <= x1) & (F.col("max_x") >= x0) & (F.col("min_y") <= y1) & (F.col("max_y") >= y0))


def layer_slice(parts: DataFrame, x0: float, y0: float, x1: float, y1: float, margin: float = 0.2, key: str = "osm_id") -> DataFrame:
    """Features of a box and its margin, once each."""
    return clip_to_box(parts, x0 - margin, y0 - margin, x1 + margin, y1 + margin).dropDuplicates([key])


OSM_ELEMENT = "type string, id long, lon double, lat double, center struct<lon: double, lat: double>, geometry array<struct<lon: double, lat: double>>, tags map<string, string>"


def read_json(staged: DataFrame, text: str, schema: str, *keep: str) -> DataFrame:
    """The fields of JSON texts and ``keep``; a generator, so that later filters do not read the text again for each field."""
    return staged.select(F.inline(F.array(F.from_json(text, schema))), *keep)


def parse_osm_elements(staged: DataFrame, text: str = "element", *keep: str) -> DataFrame:
    """osm_id, kind (point, line, polygon), points, tags and ``keep`` of staged JSON elements; others drop out."""
    got = read_json(staged, text, OSM_ELEMENT, *keep)
    ring, n = F.col("geometry"), F.size("geometry")
    closed = (n >= 4) & (F.element_at(ring, 1) == F.element_at(ring, -1))
    one = lambda lon, lat: F.array(F.struct(F.col(lon).alias("lon"), F.col(lat).alias("lat")))
    kind = F.when((F.col("type") == "node") & F.col("lon").isNotNull(), "point").when((F.col("type") == "way") & (n >= 2), F.when(closed, "polygon").otherwise("line")).when(F.col("center.lon").isNotNull(), "point")
    points = F.when(kind == "point", F.when(F.col("type") == "node", one("lon", "lat")).otherwise(one("center.lon", "center.lat"))).otherwise(ring)
    return got.select(F.concat_ws("/", "type", F.col("id").cast("string")).alias("osm_id"), kind.alias("kind"), points.alias("points"), "tags", *keep).filter("kind is not null")

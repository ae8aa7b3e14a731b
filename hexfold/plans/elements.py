"""Queries over staged map elements and boundary files that Spark writes from the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexfold.operators import spatial
from hexfold.operators.scratch import new_folder
from hexfold.plans import queries as maps
from hexfold.sources import boundaries, elements, layers

LANDUSE_TAGS = {"farmland": ("landuse", "farmyard"), "forest": ("natural", "wood"), "residential": ("landuse", "retail"), "industrial": ("landuse", "industrial"), "wetland": ("natural", "wetland"), "sand": ("natural", "bare_rock"), "beach": ("natural", "beach"), "heath": ("natural", "heath"), "quarry": ("landuse", "cemetery")}


def _tags(*pairs) -> F.Column:
    """A map of tags without those that are null."""
    return F.map_filter(F.create_map(*[x for k, v in pairs for x in (F.lit(k), v.cast("string"))]), lambda k, v: v.isNotNull())


def _points(*pairs) -> F.Column:
    return F.array(*[F.struct(x.alias("lon"), y.alias("lat")) for x, y in pairs])


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place nodes; some have no population, one that is no number, or an English name only."""
    s = layers.layer(spark, sf_dir, layers.SETTLEMENTS_SQL).repartition("k")
    k = F.col("k")
    people = F.when(k % 9 == 0, F.lit("many")).when(k % 9 > 1, F.when(k % 10 == 7, k % 700).otherwise(F.col("population")).cast("string"))
    tags = _tags(("place", F.when(k % 40 == 3, "hamlet").otherwise(F.col("place_type"))), ("population", people), (("name"), F.when(k % 6 > 0, F.col("name"))), ("name:en", F.when(k % 12 > 0, F.concat(F.lit("En "), F.col("name")))))
    return s.select(F.to_json(F.struct(F.lit("node").alias("type"), k.alias("id"), "lon", "lat", tags.alias("tags"))).alias("element"))


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed ways of land use, one in ten as an open one."""
    s = layers.layer(spark, sf_dir, layers.LANDUSE_SQL).repartition("fid")  # a small file is one task
    cx, cy, hw, hh = (F.col(c) for c in ("cx", "cy", "hw", "hh"))
    rect = _points((cx - hw, cy - hh), (cx + hw, cy - hh), (cx + hw, cy + hh), (cx - hw, cy + hh), (cx - hw, cy - hh))
    diamond = _points((cx - hw, cy), (cx, cy - hh), (cx + hw, cy), (cx, cy + hh), (cx - hw, cy))
    ring = F.when(F.col("shape") == "rect", rect).otherwise(diamond)
    ring = F.when(F.col("fid") % 10 == 9, F.slice(ring, 1, 4)).otherwise(ring)
    tag = lambda key: F.create_map(*[F.lit(x) for kind, (k, v) in LANDUSE_TAGS.items() if k == key for x in (kind, v)])[F.col("landuse_type")]
    tags = _tags(("natural", tag("natural")), ("landuse", tag("landuse")))
    return s.select(F.to_json(F.struct(F.lit("way").alias("type"), F.col("fid").alias("id"), ring.alias("geometry"), tags.alias("tags"))).alias("element"))


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roads, rails, rivers and canals with their points; one name in nine is missing."""
    w = layers.layer(spark, sf_dir, layers.WAYS_SQL)
    at = layers.layer(spark, sf_dir, layers.WAY_POINTS_SQL).groupBy("k").agg(F.sort_array(F.collect_list(F.struct("seq", "lon", "lat"))).alias("p"))
    line = F.transform("p", lambda e: F.struct(e["lon"].alias("lon"), e["lat"].alias("lat")))
    kind = F.col("kind")
    tags = _tags(("highway", F.when(kind == "road", F.col("highway"))), ("railway", F.when(kind == "rail", F.col("railway"))), ("gauge", F.when(kind == "rail", F.col("gauge"))), ("tracks", F.when(kind == "rail", F.col("tracks"))), ("waterway", F.when(kind.isin("river", "canal"), kind)), ("name", F.when(F.col("k") % 9 > 0, F.col("name"))), ("scalerank", F.col("scalerank")))
    return w.join(at, "k").select(F.to_json(F.struct(F.lit("way").alias("type"), F.col("k").alias("id"), line.alias("geometry"), tags.alias("tags"))).alias("element"))


def crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bridges as ways with a centre only; some carry no road."""
    k = F.col("s_suppkey").cast("long")
    centre = F.struct((4.0 + ((k * 5791) % 10000) / 1e4).alias("lon"), (50.5 + ((k * 7103) % 5000) / 1e4).alias("lat"))
    tags = _tags(("bridge", F.when(k % 5 > 0, "yes")), ("highway", F.when(k % 4 == 0, "primary")), ("railway", F.when(k % 4 == 1, "rail")), ("name", F.when(k % 3 > 0, F.col("s_name"))))
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.to_json(F.struct(F.lit("way").alias("type"), k.alias("id"), centre.alias("center"), tags.alias("tags"))).alias("element"))


def settlement_elements(spark, sf_dir):
    return elements.settlement_layer(layers.parse_osm_elements(places(spark, sf_dir)))


def landuse_elements(spark, sf_dir):
    """Land use of closed ways with their areas."""
    made = elements.landuse_layer(layers.parse_osm_elements(areas(spark, sf_dir)))
    return made.select("osm_id", "landuse_type", F.round(elements.ring_area(F.col("points")), 9).alias("area"))


def way_elements(spark, sf_dir):
    """Roads, rails and waterways by level, with their points."""
    parsed = layers.parse_osm_elements(ways(spark, sf_dir))
    pick = lambda df, layer, level: df.select("osm_id", F.lit(layer).alias("layer"), F.col(level).alias("level"), F.size("points").alias("points"))
    return pick(elements.road_layer(parsed), "road", "road_level").union(pick(elements.rail_layer(parsed), "rail", "rail_level")).union(pick(elements.waterway_layer(parsed), "waterway", "waterway_type"))


def bridge_elements(spark, sf_dir):
    return elements.bridge_layer(layers.parse_osm_elements(crossings(spark, sf_dir)))


def city_places(spark, sf_dir):
    s = layers.layer(spark, sf_dir, layers.SETTLEMENTS_SQL).select("lon", "lat", F.col("name").alias("NAME"), F.col("population").alias("POP_MAX"))
    return elements.city_layer(s)


def boundary_files(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Folders of feature collections of countries, one file a nation, and of province metadata."""
    folder = new_folder(spark, "boundaries")
    c = layers.layer(spark, sf_dir, layers.COUNTRIES_SQL)
    x0, y0, x1, y1 = (F.col(x) for x in ("x0", "y0", "x1", "y1"))
    pair = lambda x, y: F.array(x, y)
    ring = F.array(pair(x0, y0), pair(x1, y0), pair(x1, y1), pair(x0, y1), pair(x0, y0))
    even = F.substring("code", -1, 1).cast("int") % 2 == 0
    shape = F.when(even, F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))).otherwise(F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.array(F.array(ring)).alias("coordinates"))))
    text = F.concat(F.lit('{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"country_code": "'), "code", F.lit('"}, "geometry": '), shape, F.lit("}]}"))
    c.select("code", text.alias("value")).repartition("code").write.partitionBy("code").text(f"{folder}/countries")
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey").cast("string").alias("id"), "n_name")
    city = lambda name, *more: F.struct(name.alias("city_name"), F.array(*more).cast("array<string>").alias("match_names"))
    subs = F.when(F.col("id").cast("int") % 3 > 0, F.array(city(F.concat(F.lit("Sub "), "n_name")), city(F.concat(F.lit("Other "), "n_name"), F.lit("Also"))))
    one = F.struct(F.concat(F.lit("N"), "id", F.lit("_P")).alias("province_id"), F.when(F.col("id").cast("int") % 2 > 0, F.concat(F.lit("N"), "id")).alias("country"), city(F.col("n_name"), F.initcap("n_name")).alias("capital"), subs.alias("sub_capitals"))
    n.select("id", F.to_json(F.struct(F.array(one).alias("provinces"))).alias("value")).repartition("id").write.partitionBy("id").text(f"{folder}/provinces")
    return f"{folder}/countries", f"{folder}/provinces"


def boundary_countries(spark, sf_dir):
    """Settlements by country, from outlines read back from files."""
    read = boundaries.read_geojson(spark, boundary_files(spark, sf_dir)[0], "country_code string")
    rings = boundaries.outlines(read, "country_code")
    over = spatial.covered_counts(maps.points(spark, sf_dir), rings)
    return over.select(F.col("fid").alias("code"), "n")


def province_metadata(spark, sf_dir):
    """Ranked cities of provinces with their names."""
    read = boundaries.read_province_metadata(spark, boundary_files(spark, sf_dir)[1])
    return read.select("province", "country", F.col("rank").cast("int").alias("rank"), "city_name", F.array_join("names", "|").alias("names"))


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes of land use as relations: an outer ring of two ways, one of them backwards, and a hole; one in ten lacks a way."""
    s = layers.layer(spark, sf_dir, layers.LANDUSE_SQL).repartition("fid")
    cx, cy, hw, hh = (F.col(c) for c in ("cx", "cy", "hw", "hh"))

    def ring(share: float) -> list[F.Column]:
        w, h = hw * share, hh * share
        rect, diamond = [(cx - w, cy - h), (cx + w, cy - h), (cx + w, cy + h), (cx - w, cy + h)], [(cx - w, cy), (cx, cy - h), (cx + w, cy), (cx, cy + h)]
        at = lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat"))
        return [F.when(F.col("shape") == "rect", at(a)).otherwise(at(b)) for a, b in zip(rect, diamond, strict=True)]

    outer, inner = ring(1.0), ring(0.5)
    way = lambda role, points: F.struct(F.lit("way").alias("type"), F.col("fid").alias("ref"), F.lit(role).alias("role"), F.array(*points).alias("geometry"))
    ways = F.array(way("inner", [*inner, inner[0]]), way("outer", outer[:3]), way("outer", [outer[0], outer[3], outer[2]]))
    ways = F.when(F.col("fid") % 10 == 9, F.slice(ways, 1, 2)).otherwise(ways)
    tags = F.create_map(F.lit("type"), F.when(F.col("fid") % 10 == 8, "route").otherwise("multipolygon"))
    return s.select(F.to_json(F.struct(F.lit("relation").alias("type"), F.col("fid").alias("id"), ways.alias("members"), tags.alias("tags"))).alias("element"))


def relation_covers(spark, sf_dir):
    """Settlements inside each multipolygon relation and outside its hole; those that do not close are left out."""
    rings = elements.closed(elements.relation_segments(relations(spark, sf_dir)))
    return spatial.covered_counts(maps.points(spark, sf_dir), rings).select(F.col("fid").alias("osm_id"), "n")


QUERIES = [relation_covers, settlement_elements, landuse_elements, way_elements, bridge_elements, city_places, boundary_countries, province_metadata]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    roads = maps.oracle_sql()["roads"]
    return {
        "relation_covers": f"""WITH p AS (SELECT lon + 3.7e-5 AS x, lat + 2.3e-5 AS y FROM ({layers.SETTLEMENTS_SQL})), d AS (SELECT fid, CASE shape WHEN 'rect' THEN greatest(abs(x - cx) / hw, abs(y - cy) / hh) ELSE abs(x - cx) / hw + abs(y - cy) / hh END AS d FROM p, ({layers.LANDUSE_SQL}) WHERE fid % 10 < 8)
 SELECT concat('relation/', fid) AS osm_id, count(*) AS n FROM d WHERE d < 1 AND d >= 0.5 GROUP BY fid""",
        "settlement_elements": f"""WITH s AS ({layers.SETTLEMENTS_SQL}), t AS (SELECT *, CASE WHEN k % 9 IN (0, 1) THEN 0 WHEN k % 10 = 7 THEN k % 700 ELSE population END AS people FROM s WHERE k % 40 <> 3)
 SELECT concat('node/', k) AS osm_id, lon, lat, CASE WHEN k % 6 > 0 THEN name WHEN k % 12 > 0 THEN concat('En ', name) ELSE '' END AS name, place_type, people AS population FROM t WHERE NOT (place_type = 'village' AND people BETWEEN 1 AND 499)""",
        "landuse_elements": f"SELECT concat('way/', fid) AS osm_id, landuse_type, round(CASE shape WHEN 'rect' THEN 4 ELSE 2 END * hw * hh, 9) AS area FROM ({layers.LANDUSE_SQL}) WHERE fid % 10 <> 9 AND landuse_type <> 'quarry'",
        "way_elements": f"""WITH l AS ({roads}), n AS (SELECT l_orderkey AS k, count(*) AS n, min(lon) = max(lon) AS one FROM (SELECT k AS l_orderkey, lon FROM ({layers.WAY_POINTS_SQL})) GROUP BY 1), w AS (SELECT * FROM ({layers.WAYS_SQL})),
 e AS (SELECT k, arg_min((lon, lat), seq) = arg_max((lon, lat), seq) AS closed FROM ({layers.WAY_POINTS_SQL}) GROUP BY k)
 SELECT concat('way/', k) AS osm_id, CASE kind WHEN 'road' THEN 'road' WHEN 'rail' THEN 'rail' ELSE 'waterway' END AS layer, CASE WHEN kind IN ('road', 'rail') THEN level ELSE kind END AS level, CAST(n AS INT) AS points
 FROM w JOIN l USING (k) JOIN n USING (k) JOIN e USING (k) WHERE n >= 2 AND NOT (n >= 4 AND closed) AND (kind IN ('road', 'rail') OR k % 9 > 0)""",
        "bridge_elements": """SELECT concat('way/', s_suppkey) AS osm_id, 4.0e0 + ((s_suppkey * 5791) % 10000) / 1e4 AS lon, 50.5e0 + ((s_suppkey * 7103) % 5000) / 1e4 AS lat, CASE WHEN s_suppkey % 3 > 0 THEN s_name ELSE '' END AS name
 FROM supplier WHERE s_suppkey % 5 > 0 AND s_suppkey % 4 < 2""",
        "city_places": f"SELECT lon, lat, name, population FROM ({layers.SETTLEMENTS_SQL})",
        "boundary_countries": f"WITH p AS (SELECT lon + 3.7e-5 AS x, lat + 2.3e-5 AS y FROM ({layers.SETTLEMENTS_SQL})) SELECT code, count(*) AS n FROM p JOIN ({layers.COUNTRIES_SQL}) ON x > x0 AND x < x1 AND y > y0 AND y < y1 GROUP BY code",
        "province_metadata": """WITH n AS (SELECT n_nationkey AS i, n_name AS m FROM nation), r AS (SELECT i, 0 AS rank, m AS city_name, CASE WHEN m = concat(m[1], lower(m[2:])) THEN m ELSE concat(m, '|', array_to_string(list_transform(string_split(m, ' '), lambda w: concat(upper(w[1]), lower(w[2:]))), ' ')) END AS names FROM n
 UNION ALL SELECT i, 1, concat('Sub ', m), concat('Sub ', m) FROM n WHERE i % 3 > 0 UNION ALL SELECT i, 2, concat('Other ', m), concat('Other ', m, '|Also') FROM n WHERE i % 3 > 0)
 SELECT concat('N', i, '_P') AS province, concat('N', i) AS country, CAST(rank AS INT) AS rank, city_name, names FROM r""",
    }

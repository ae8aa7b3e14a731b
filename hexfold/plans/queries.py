"""Registered queries over layers of the given tables, and their SQL."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexfold.functions import classify, geo
from hexfold.operators import hexes, spatial, tables
from hexfold.sources import layers

SIZE = 2000.0
MERIDIAN = 3.0


def settlements(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = layers.layer(spark, sf_dir, layers.SETTLEMENTS_SQL)
    return s.withColumn("kind", classify.settlement_type(F.col("place_type"), F.col("population")))


def in_hexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hexes.with_hex(settlements(spark, sf_dir), SIZE, MERIDIAN)


def settlements_per_hex(spark, sf_dir):
    tier = F.when(F.col("kind") == "metropolis", 3).when(F.col("kind") == "city", 2).when((F.col("kind") == "town") & (F.col("population") >= 20_000), 1)
    ranked = in_hexes(spark, sf_dir).withColumn("tier", tier).filter("tier is not null")
    best = ranked.groupBy("q", "r").agg(F.max(F.struct("tier", "population", (-F.col("k")).alias("first"), "name", "kind")).alias("m"))
    return best.select("q", "r", "m.name", "m.kind", "m.population")


def settlement_classes(spark, sf_dir):
    return settlements(spark, sf_dir).select("k", "kind", classify.population_class(F.col("kind")).alias("class"), classify.sprawl_radius_km(F.col("kind"), F.col("population")).alias("radius_km"))


def terrain(spark, sf_dir):
    t = layers.layer(spark, sf_dir, layers.TERRAIN_SQL)
    c = F.col
    t = t.withColumn("biome", classify.biome(c("water"), c("lake"), c("coastal"), c("landuse"), c("elev"), c("slope"), c("lat"), c("lon"), c("place")))
    return t.withColumn("kind", F.when(c("place").isNotNull(), classify.settlement_type(c("place"), c("population"))).otherwise("none"))


def terrain_classes(spark, sf_dir):
    c = F.col
    return terrain(spark, sf_dir).select("k", "biome", classify.elevation_tier(c("elev"), c("slope")).alias("tier"), classify.anthrome(c("biome"), c("landuse"), c("kind")).alias("anthrome"), classify.is_impassable(c("biome")).alias("impassable"))


def terrain_costs(spark, sf_dir):
    c = terrain(spark, sf_dir).withColumn("block", classify.class_block(F.col("biome")))
    return c.select("k", classify.base_cost(F.col("biome")).alias("cost"), classify.base_defense(F.col("biome")).alias("defense"), F.col("block.terrain").alias("terrain"), F.col("block.cost").alias("class_cost"), F.col("block.blocks_los").alias("blocks_los"))


def vegetation_moisture(spark, sf_dir):
    c = F.col
    return terrain(spark, sf_dir).select("k", classify.vegetation(c("landuse"), c("biome")).alias("vegetation"), classify.moisture(c("biome"), c("landuse"), c("elev"), c("lat"), c("lon")).alias("moisture"))


def biome_distribution(spark, sf_dir):
    return terrain(spark, sf_dir).groupBy("biome").agg(F.count(F.lit(1)).alias("n"))


def run_summary(spark, sf_dir):
    land = ~classify.is_water(F.col("biome"))
    return terrain(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"), F.count_if(land).alias("land"), F.count_if(F.col("kind") != "none").alias("settled"), F.round(F.avg(F.when(land, (F.col("biome") == "forest").cast("int"))), 6).alias("forest_share"))


def land_slope_p90(spark, sf_dir):
    """The slope of the lower nearest rank at 0.9 among land."""
    land = terrain(spark, sf_dir).filter(~classify.is_water(F.col("biome")))
    return spark.createDataFrame([(tables.order_statistic(land, "slope", 0.9),)], "p90 double")


def points(spark, sf_dir):
    s = layers.layer(spark, sf_dir, layers.SETTLEMENTS_SQL)
    return s.select(F.col("k").alias("pid"), (F.col("lon") + 3.7e-5).alias("x"), (F.col("lat") + 2.3e-5).alias("y"))


def landuse_at_point(spark, sf_dir):
    shapes = layers.layer(spark, sf_dir, layers.LANDUSE_SQL)
    area = F.when(F.col("shape") == "rect", 4).otherwise(2) * F.col("hw") * F.col("hh")
    features = shapes.select("fid", F.round(area, 9).alias("area"), F.col("landuse_type").alias("kind"))
    return spatial.smallest_cover(points(spark, sf_dir), layers.rings(shapes), features).select(F.col("pid").alias("k"), F.col("kind").alias("landuse"))


def landuse_counts(spark, sf_dir):
    return layers.layer(spark, sf_dir, layers.LANDUSE_SQL).groupBy("landuse_type").agg(F.count(F.lit(1)).alias("n"))


def country_boxes(spark, sf_dir):
    c = layers.layer(spark, sf_dir, layers.COUNTRIES_SQL)
    return c.select(F.col("code").alias("fid"), F.lit("rect").alias("shape"), ((F.col("x0") + F.col("x1")) / 2).alias("cx"), ((F.col("y0") + F.col("y1")) / 2).alias("cy"), ((F.col("x1") - F.col("x0")) / 2).alias("hw"), ((F.col("y1") - F.col("y0")) / 2).alias("hh"))


def country_at_point(spark, sf_dir):
    boxes = country_boxes(spark, sf_dir)
    return spatial.cover_or_snap(points(spark, sf_dir), layers.rings(boxes), boxes.select("fid", F.col("fid").alias("code")), 0.02).select(F.col("pid").alias("k"), "code")


def country_rollup(spark, sf_dir):
    return country_at_point(spark, sf_dir).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def occupied(spark, sf_dir):
    return in_hexes(spark, sf_dir).select("q", "r").distinct()


def hex_neighbors(spark, sf_dir):
    return hexes.neighbors(occupied(spark, sf_dir))


def coastal_hexes(spark, sf_dir):
    wet = occupied(spark, sf_dir).withColumn("water", F.pmod(F.col("q") * 7 + F.col("r") * 3, F.lit(5)) == 0)
    return hexes.coastal(wet)


def hex_chains(spark, sf_dir):
    return hexes.chains(occupied(spark, sf_dir))


def roads(spark, sf_dir):
    w = layers.layer(spark, sf_dir, layers.WAYS_SQL)
    return w.select("k", F.when(F.col("kind") == "road", layers.road_level(F.col("highway"))).when(F.col("kind") == "rail", layers.rail_level(F.col("railway"), F.col("gauge"), F.col("tracks"))).otherwise("water").alias("level"))


def canal_selection(spark, sf_dir, least: float = 110_000.0):
    """Names of canals by total length of their ways, over consecutive points."""
    from pyspark.sql import Window

    at = layers.layer(spark, sf_dir, layers.WAY_POINTS_SQL)
    w = Window.partitionBy("k").orderBy("seq")
    at = at.withColumns({"lon2": F.lead("lon").over(w), "lat2": F.lead("lat").over(w)}).filter("lon2 is not null")
    a = F.sin(F.radians(F.col("lat2") - F.col("lat")) / 2) ** 2 + F.cos(F.radians("lat")) * F.cos(F.radians("lat2")) * F.sin(F.radians(F.col("lon2") - F.col("lon")) / 2) ** 2
    segments = at.withColumn("metres", 2 * 6_371_008.8 * F.asin(F.sqrt(a)))
    canals = layers.layer(spark, sf_dir, layers.WAYS_SQL).filter("kind = 'canal'").select("k", "name")
    return tables.long_names(segments.join(canals, "k"), "name", "metres", least).select("name", F.round("metres", 2).alias("metres"))


def unit_stacks(spark, sf_dir):
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").select((4.0 + ((F.col("s_suppkey") * 5791) % 10000) / 1e4).alias("lon"), (50.5 + ((F.col("s_suppkey") * 7103) % 5000) / 1e4).alias("lat"))
    return hexes.with_hex(s, SIZE, MERIDIAN).groupBy("q", "r").agg(F.count(F.lit(1)).alias("units"))


def movement_paths(spark, sf_dir):
    """Ordered hexes of each way's points, known hexes only, two at least."""
    at = hexes.with_hex(layers.layer(spark, sf_dir, layers.WAY_POINTS_SQL), SIZE, MERIDIAN).join(occupied(spark, sf_dir), ["q", "r"], "left_semi")
    paths = at.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("seq", "q", "r"))).alias("p")).filter(F.size("p") >= 2)
    return paths.select("k", F.size("p").alias("steps"), F.array_join(F.transform("p", lambda e: geo.hex_id(e["q"], e["r"])), " ").alias("path"))


def forces_by_side(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return c.groupBy(F.col("c_mktsegment").alias("side")).agg(F.count(F.lit(1)).alias("units"), F.array_join(F.array_sort(F.collect_set(F.col("c_nationkey").cast("string"))), "; ").alias("objectives"))


def name_scores(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").join(spark.read.parquet(f"{sf_dir}/nation.parquet"), F.col("c_nationkey") == F.col("n_nationkey"))
    a = classify.norm_name(F.concat_ws("-", "n_name", "c_mktsegment"))
    b = classify.norm_name(F.when(F.col("c_custkey") % 3 == 0, F.col("n_name")).when(F.col("c_custkey") % 3 == 1, F.concat_ws(" ", "n_name", "c_mktsegment")).otherwise(F.concat(F.lit("St. "), F.col("c_mktsegment"))))
    names = c.repartition("c_custkey").select(F.col("c_custkey").alias("k"), a.alias("a"), b.alias("b"))  # once a row, not once for each rule
    return names.select("k", classify.match_score(F.col("a"), F.col("b")).alias("score"))


def nearest_cities(spark, sf_dir):
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").cast("long").alias("pid"), (4.0 + ((F.col("s_suppkey") * 5791) % 10000) / 1e4).alias("x"), (50.5 + ((F.col("s_suppkey") * 7103) % 5000) / 1e4).alias("y"))
    cities = settlements(spark, sf_dir).filter("kind in ('city', 'metropolis')").select(F.col("k").alias("tid"), F.col("lon").alias("x"), F.col("lat").alias("y"))
    return spatial.nearest(s, cities, 3).select("pid", "rank", "tid", F.round("d", 6).alias("d"))


def near_bridges(spark, sf_dir):
    """Settlements within a hexagon's radius of a bridge."""
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").select((4.0 + ((F.col("s_suppkey") * 5791) % 10000) / 1e4).alias("x"), (50.5 + ((F.col("s_suppkey") * 7103) % 5000) / 1e4).alias("y"))
    return spatial.within(points(spark, sf_dir), s, geo.radius(SIZE) / 111_320).select(F.col("pid").alias("k"))


def layer_precedence(spark, sf_dir):
    s = settlements(spark, sf_dir)
    return tables.precedence([s.filter("k % 3 = 0").select("k", "kind"), s.select("k", F.col("place_type").alias("kind"))], ["k"], "kind")


def hex_diff(spark, sf_dir):
    h = in_hexes(spark, sf_dir)
    count = lambda df: df.groupBy("q", "r").agg(F.count(F.lit(1)).alias("n"), F.sum("population").alias("people"))
    return tables.diff(count(h.filter("kind <> 'village'")), count(h.filter("population > 0")), ["q", "r"])


def hex_first_differences(spark, sf_dir):
    h = in_hexes(spark, sf_dir)
    count = lambda df: df.groupBy("q", "r").agg(F.count(F.lit(1)).alias("n"), F.sum("population").alias("people"), F.min("kind").alias("kind"))
    return tables.first_differences(count(h.filter("kind <> 'village'")), count(h.filter("population > 0")), ["q", "r"])


def hex_fingerprint(spark, sf_dir):
    return tables.fingerprint(settlements_per_hex(spark, sf_dir))


def quality_checks(spark, sf_dir):
    c = F.col
    return tables.gates(terrain(spark, sf_dir), {"elevation": c("elev").between(-120, 3000), "slope": c("slope").between(0, 60), "water": ~c("water") | classify.is_water(c("biome")), "settled": (c("kind") == "none") | (c("population") > 0)})


def osm_elements(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    ident = F.when(F.col("event_id") % 10 == 9, F.floor(F.col("event_id") / 2)).otherwise(F.col("event_id")).cast("string")
    text = F.concat(F.lit('{"type":"node","id":'), ident, F.lit(',"lon":4.5,"lat":50.75,"tags":{"place":"'), F.col("event_type"), F.lit('"}}'))
    parsed = layers.parse_osm_elements(e.select(text.alias("element")))
    return parsed.groupBy("osm_id").agg(F.min("kind").alias("kind"), F.min(F.col("tags")["place"]).alias("place"))


def open_rings(spark, sf_dir):
    """Rings that miss a segment (every fifth feature's first) do not close."""
    segments = layers.rings(layers.layer(spark, sf_dir, layers.LANDUSE_SQL))
    first = (F.col("fid") % 5 == 0) & (F.col("x1") < F.col("x2")) & (F.col("y1") >= F.col("y2"))
    return tables.open_ends(segments.filter(~first)).groupBy("fid").agg(F.count(F.lit(1)).alias("ends"))


QUERIES = [
    settlements_per_hex, settlement_classes, terrain_classes, terrain_costs, vegetation_moisture, biome_distribution, run_summary, land_slope_p90,
    landuse_at_point, landuse_counts, country_at_point, country_rollup, hex_neighbors, coastal_hexes, hex_chains, roads, canal_selection,
    unit_stacks, movement_paths, forces_by_side, name_scores, nearest_cities, near_bridges, layer_precedence, hex_diff, hex_first_differences, hex_fingerprint, quality_checks, osm_elements, open_rings,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def _kind(place: str = "place_type") -> str:
    return f"CASE WHEN coalesce(population, 0) > 300000 THEN 'metropolis' WHEN population >= 50000 THEN 'city' WHEN population >= 2000 THEN 'town' WHEN population > 0 THEN 'village' WHEN {place} IN ('city', 'town') THEN {place} ELSE 'village' END"


def _hex_sql(source: str) -> str:
    """Hexes of lon/lat points: projection, then cube rounding (not the candidates of the operator)."""
    e = 2 * math.sqrt(geo._n) / (1 + geo._n)
    x = "eta" + "".join(f" + {a!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(geo.ALPHA, 1))
    y = "xi" + "".join(f" + {a!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(geo.ALPHA, 1))
    m = geo.SCALE * geo._RADIUS
    return f"""h0 AS (SELECT *, sin(radians(lat)) AS sn, radians(lon - {MERIDIAN}) AS far FROM {source}),
h1 AS (SELECT *, sinh(atanh(sn) - {e!r} * atanh({e!r} * sn)) AS t FROM h0),
h2 AS (SELECT *, atan2(t, cos(far)) AS xi, atanh(sin(far) / sqrt(1 + t * t)) AS eta FROM h1),
h3 AS (SELECT *, {geo.EASTING} + {m!r} * ({x}) AS x, {m!r} * ({y}) AS y FROM h2),
h4 AS (SELECT *, x / {1.5 * geo.radius(SIZE)!r} AS a, y / {SIZE} - x / {3 * geo.radius(SIZE)!r} AS b FROM h3),
h5 AS (SELECT *, round(a) AS ra, round(b) AS rb, round(-a - b) AS rc FROM h4),
h6 AS (SELECT *, CASE WHEN abs(ra - a) > abs(rb - b) AND abs(ra - a) > abs(rc + a + b) THEN -rb - rc ELSE ra END AS ca,
 CASE WHEN NOT (abs(ra - a) > abs(rb - b) AND abs(ra - a) > abs(rc + a + b)) AND abs(rb - b) > abs(rc + a + b) THEN -ra - rc ELSE rb END AS cb FROM h5),
hx AS (SELECT *, CAST(ca AS INT) AS q, CAST(cb + floor(ca / 2) AS INT) AS r FROM h6)"""


def oracle_sql() -> dict[str, str]:
    s = f"s AS (SELECT *, {_kind()} AS kind FROM ({layers.SETTLEMENTS_SQL}))"
    sh = f"WITH {s}, {_hex_sql('s')}"
    wp = f"WITH p AS ({layers.WAY_POINTS_SQL}), {_hex_sql('p')}"
    biome = """CASE WHEN water AND coastal THEN 'coastal_water' WHEN water THEN 'water' WHEN lake THEN 'lake' WHEN landuse = 'glacier' OR (elev > 2800 AND slope < 10) THEN 'glacier'
 WHEN landuse = 'beach' AND coastal THEN 'beach' WHEN place IN ('city', 'town') OR landuse = 'industrial' THEN 'urban'
 WHEN landuse = 'wetland' THEN CASE WHEN elev <= 1800 AND lat <= 68 THEN 'swamp' ELSE 'marsh' END WHEN landuse = 'forest' THEN 'forest'
 WHEN slope >= 20 OR (elev >= 800 AND slope >= 5) THEN 'mountain' WHEN slope >= 8 THEN 'hill' WHEN elev >= 1500 AND slope < 3 THEN 'highland_plateau'
 WHEN elev >= 1800 AND lat >= 55 THEN 'tundra' WHEN lat >= 65 AND coalesce(landuse, 'grass') IN ('grass', 'heath', 'scrub') THEN 'tundra'
 WHEN landuse = 'sand' OR (lat < 32 AND lon > -5 AND elev < 500 AND slope < 5) THEN 'desert' WHEN landuse IN ('heath', 'scrub') OR (lon > 25 AND elev < 300 AND slope < 5) THEN 'steppe' ELSE 'plains' END"""
    t = f"WITH t AS (SELECT *, {biome} AS biome, CASE WHEN place IS NULL THEN 'none' ELSE {_kind('place')} END AS kind FROM ({layers.TERRAIN_SQL}))"
    wet = "biome IN ('water', 'coastal_water', 'lake')"
    pts = f"p AS (SELECT k, lon + 3.7e-5 AS x, lat + 2.3e-5 AS y FROM ({layers.SETTLEMENTS_SQL}))"
    country = f"""WITH {pts}, c AS ({layers.COUNTRIES_SQL}), d AS (SELECT k, code, greatest(x0 - x, 0, x - x1) AS dx, greatest(y0 - y, 0, y - y1) AS dy FROM p, c),
 b AS (SELECT k, min_by(code, sqrt(dx * dx + dy * dy)) AS code FROM d WHERE sqrt(dx * dx + dy * dy) < 0.02 GROUP BY k),
 o AS (SELECT k, coalesce(b.code, '') AS code FROM p LEFT JOIN b USING (k))"""
    occupied = f"{sh}, o AS (SELECT DISTINCT q, r, q * CAST({1.5 * geo.radius(SIZE)!r} AS DOUBLE) AS cx, (r + 0.5e0 * (q % 2)) * CAST({SIZE} AS DOUBLE) AS cy FROM hx)"
    beside = "abs(a.q - b.q) <= 1 AND abs(a.r - b.r) <= 1 AND sqrt((a.cx - b.cx) ^ 2 + (a.cy - b.cy) ^ 2) BETWEEN 1990 AND 2010"
    edge = "CAST(CASE WHEN b.q > a.q THEN CASE WHEN b.cy > a.cy THEN 0 ELSE 5 END WHEN b.q < a.q THEN CASE WHEN b.cy > a.cy THEN 2 ELSE 3 END WHEN b.r > a.r THEN 1 ELSE 4 END AS INT)"
    sup = "SELECT s_suppkey, 4.0e0 + ((s_suppkey * 5791) % 10000) / 1e4 AS lon, 50.5e0 + ((s_suppkey * 7103) % 5000) / 1e4 AS lat FROM supplier"
    norm = lambda x: f"trim(regexp_replace(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}} ]', ' ', 'g'), ' +', ' ', 'g'))"
    sql = {
        "settlements_per_hex": f"""{sh}, v AS (SELECT *, CASE kind WHEN 'metropolis' THEN 3 WHEN 'city' THEN 2 WHEN 'town' THEN CASE WHEN population >= 20000 THEN 1 END END AS tier FROM hx)
 SELECT q, r, name, kind, population FROM v WHERE tier IS NOT NULL QUALIFY row_number() OVER (PARTITION BY q, r ORDER BY tier DESC, population DESC, k) = 1""",
        "settlement_classes": f"""WITH {s} SELECT k, kind, CAST(CASE kind WHEN 'village' THEN 1 WHEN 'town' THEN 2 WHEN 'city' THEN 3 ELSE 5 END AS INT) AS class,
 CAST(CASE WHEN kind = 'metropolis' THEN 14 WHEN kind = 'city' AND population >= 150000 THEN 11 WHEN kind = 'city' THEN 8 ELSE 0 END AS INT) AS radius_km FROM s""",
        "terrain_classes": f"""{t} SELECT k, biome, CASE WHEN slope < 3 THEN CASE WHEN elev > 1500 THEN 'highland_plateau' ELSE 'flat' END WHEN slope < 10 THEN 'hilly' WHEN slope < 20 THEN 'mountainous' ELSE 'rugged' END AS tier,
 CASE WHEN biome <> 'urban' AND kind = 'none' THEN CASE landuse WHEN 'farmland' THEN 'cropland' WHEN 'military' THEN 'fortified' WHEN 'quarry' THEN 'mining' ELSE 'none' END
  WHEN landuse = 'industrial' THEN 'industrial' WHEN kind IN ('metropolis', 'city') THEN 'metro' WHEN kind = 'town' THEN 'residential' ELSE 'none' END AS anthrome,
 {wet} OR biome = 'glacier' AS impassable FROM t""",
        "terrain_costs": f"""{t} SELECT k, CAST(CASE WHEN {wet} OR biome = 'glacier' THEN 99 WHEN biome IN ('mountain', 'marsh', 'swamp') THEN 3 WHEN biome IN ('forest', 'desert', 'hill', 'highland_plateau', 'tundra') THEN 2 ELSE 1 END AS INT) AS cost,
 CAST(CASE WHEN biome IN ('mountain', 'urban') THEN 2 WHEN biome IN ('forest', 'hill', 'highland_plateau', 'swamp') THEN 1 ELSE 0 END AS INT) AS defense,
 CASE WHEN {wet} THEN 'water' WHEN biome IN ('hill', 'highland_plateau', 'tundra') THEN 'rough' WHEN biome IN ('mountain', 'glacier') THEN 'mountain' WHEN biome IN ('marsh', 'swamp') THEN 'marsh' WHEN biome IN ('forest', 'desert', 'urban') THEN biome ELSE 'clear' END AS terrain,
 CAST(CASE WHEN {wet} THEN 99 WHEN biome IN ('mountain', 'glacier', 'marsh', 'swamp') THEN 3 WHEN biome IN ('hill', 'highland_plateau', 'tundra', 'forest', 'desert') THEN 2 ELSE 1 END AS INT) AS class_cost,
 biome IN ('forest', 'mountain', 'glacier', 'urban') AS blocks_los FROM t""",
        "vegetation_moisture": f"""{t} SELECT k, CASE WHEN {wet} OR biome IN ('glacier', 'desert', 'beach') THEN 'bare' WHEN biome IN ('forest', 'swamp') OR landuse IN ('forest', 'wetland') THEN 'dense'
 WHEN landuse IN ('farmland', 'grass', 'residential', 'industrial') THEN 'light' WHEN landuse IN ('heath', 'scrub', 'sand') OR biome IN ('tundra', 'steppe') THEN 'sparse' WHEN biome = 'urban' THEN 'bare' ELSE 'light' END AS vegetation,
 CASE WHEN biome IN ('marsh', 'swamp') OR landuse = 'wetland' THEN 'flooded' WHEN biome = 'desert' THEN 'arid' WHEN biome IN ('steppe', 'tundra') THEN 'dry' WHEN lat < 30 AND lon > -5 THEN 'arid'
 WHEN elev > 600 OR (lon < 5 AND lat > 45) THEN 'wet' ELSE 'temperate' END AS moisture FROM t""",
        "biome_distribution": f"{t} SELECT biome, count(*) AS n FROM t GROUP BY biome",
        "run_summary": f"{t} SELECT count(*) AS n, count(*) FILTER (NOT ({wet})) AS land, count(*) FILTER (kind <> 'none') AS settled, round(avg(CASE WHEN NOT ({wet}) THEN CAST(biome = 'forest' AS INT) END), 6) AS forest_share FROM t",
        "land_slope_p90": f"{t} SELECT list_sort(list(slope))[CAST(floor(0.9 * (count(*) - 1)) AS BIGINT) + 1] AS p90 FROM t WHERE NOT ({wet})",
        "landuse_at_point": f"""WITH {pts}, f AS ({layers.LANDUSE_SQL}) SELECT k, landuse_type AS landuse FROM p, f
 WHERE CASE shape WHEN 'rect' THEN abs(x - cx) < hw AND abs(y - cy) < hh ELSE abs(x - cx) / hw + abs(y - cy) / hh < 1 END
 QUALIFY row_number() OVER (PARTITION BY k ORDER BY round(CASE shape WHEN 'rect' THEN 4 ELSE 2 END * hw * hh, 9), landuse_type) = 1""",
        "landuse_counts": f"SELECT landuse_type, count(*) AS n FROM ({layers.LANDUSE_SQL}) GROUP BY landuse_type",
        "country_at_point": f"{country} SELECT k, code FROM o",
        "country_rollup": f"{country} SELECT code, count(*) AS n FROM o GROUP BY code",
        "hex_neighbors": f"{occupied} SELECT a.q, a.r, {edge} AS edge, b.q AS nq, b.r AS nr FROM o a JOIN o b ON {beside}",
        "coastal_hexes": f"{occupied}, w AS (SELECT *, (q * 7 + r * 3) % 5 = 0 AS water FROM o) SELECT q, r, water, NOT water AND EXISTS (SELECT 1 FROM w b WHERE b.water AND {beside}) AS coastal FROM w a",
        "hex_chains": f"""{occupied.replace('WITH ', 'WITH RECURSIVE ', 1)}, n AS (SELECT * FROM o), e AS (SELECT a.q, a.r, b.q AS nq, b.r AS nr FROM n a JOIN n b ON {beside}),
 z AS (SELECT q, r, q AS root_q, r AS root_r FROM n UNION SELECT e.nq, e.nr, z.root_q, z.root_r FROM z JOIN e ON z.q = e.q AND z.r = e.r WHERE (z.root_q, z.root_r) < (e.nq, e.nr)),
 m AS (SELECT q, r, min((root_q, root_r)) AS x FROM z GROUP BY q, r) SELECT q, r, x[1] AS root_q, x[2] AS root_r FROM m""",
        "roads": f"""SELECT k, CASE kind WHEN 'road' THEN CASE WHEN highway IN ('motorway', 'trunk') THEN 'highway' WHEN highway IN ('primary', 'secondary') THEN 'paved' ELSE 'none' END
 WHEN 'rail' THEN CASE WHEN railway = 'narrow_gauge' OR gauge < 1000 THEN 'narrow' WHEN tracks >= 2 THEN 'double' ELSE 'standard' END ELSE 'water' END AS level FROM ({layers.WAYS_SQL})""",
        "canal_selection": f"""WITH p AS ({layers.WAY_POINTS_SQL}), g AS (SELECT *, lead(lon) OVER (PARTITION BY k ORDER BY seq) AS lon2, lead(lat) OVER (PARTITION BY k ORDER BY seq) AS lat2 FROM p),
 c AS (SELECT k, name FROM ({layers.WAYS_SQL}) WHERE kind = 'canal'), m AS (SELECT name, 2 * 6371008.8 * asin(sqrt(sin(radians(lat2 - lat) / 2) ^ 2 + cos(radians(lat)) * cos(radians(lat2)) * sin(radians(lon2 - lon) / 2) ^ 2)) AS d FROM g JOIN c USING (k) WHERE lon2 IS NOT NULL)
 SELECT name, round(sum(d), 2) AS metres FROM m GROUP BY name HAVING sum(d) > 110000""",
        "unit_stacks": f"WITH u AS ({sup}), {_hex_sql('u')} SELECT q, r, count(*) AS units FROM hx GROUP BY q, r",
        "movement_paths": f"""{wp}, w AS (SELECT k, seq, q, r FROM hx), {s}, {_hex_sql('s').replace('h0', 'g0').replace('h1', 'g1').replace('h2', 'g2').replace('h3', 'g3').replace('h4', 'g4').replace('h5', 'g5').replace('h6', 'g6').replace('hx', 'gx')},
 o AS (SELECT DISTINCT q, r FROM gx) SELECT k, CAST(count(*) AS INT) AS steps, string_agg(concat(q, '_', r), ' ' ORDER BY seq) AS path FROM w SEMI JOIN o USING (q, r) GROUP BY k HAVING count(*) >= 2""",
        "forces_by_side": "SELECT c_mktsegment AS side, count(*) AS units, array_to_string(list_sort(list(DISTINCT CAST(c_nationkey AS VARCHAR))), '; ') AS objectives FROM customer GROUP BY c_mktsegment",
        "name_scores": f"""WITH n AS (SELECT c_custkey AS k, {norm("concat(n_name, '-', c_mktsegment)")} AS a, {norm("CASE c_custkey % 3 WHEN 0 THEN n_name WHEN 1 THEN concat(n_name, ' ', c_mktsegment) ELSE concat('St. ', c_mktsegment) END")} AS b FROM customer JOIN nation ON c_nationkey = n_nationkey),
 x AS (SELECT *, string_split(a, ' ') AS x, string_split(b, ' ') AS y FROM n)
 SELECT k, CAST(CASE WHEN a = b THEN 100 WHEN list_contains(x, b) OR list_contains(y, a) THEN 70 WHEN len(list_filter(list_intersect(x, y), lambda w: length(w) >= 4)) > 0 THEN 50 ELSE 0 END AS INT) AS score FROM x""",
        "nearest_cities": f"""WITH {s}, u AS ({sup}), d AS (SELECT s_suppkey AS pid, k AS tid, sqrt((s.lat - u.lat) ^ 2 + ((s.lon - u.lon) * cos(radians(u.lat))) ^ 2) AS d FROM u, s WHERE kind IN ('city', 'metropolis')),
 z AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY d, tid) AS rank FROM d) SELECT CAST(pid AS BIGINT) AS pid, CAST(rank AS INT) AS rank, tid, round(d, 6) AS d FROM z WHERE rank <= 3""",
        "near_bridges": f"WITH {pts}, u AS ({sup}) SELECT k FROM p WHERE EXISTS (SELECT 1 FROM u WHERE sqrt((u.lat - y) ^ 2 + ((u.lon - x) * cos(radians(y))) ^ 2) < {geo.radius(SIZE) / 111_320!r})",
        "layer_precedence": f"WITH {s} SELECT k, CASE WHEN k % 3 = 0 THEN kind ELSE place_type END AS kind FROM s",
        "hex_diff": f"""{sh}, a AS (SELECT q, r, count(*) AS n, sum(population) AS p FROM hx WHERE kind <> 'village' GROUP BY q, r), b AS (SELECT q, r, count(*) AS n, sum(population) AS p FROM hx WHERE population > 0 GROUP BY q, r),
 j AS (SELECT a.n AS an, b.n AS bn, a.p AS ap, b.p AS bp FROM a FULL JOIN b ON a.q = b.q AND a.r = b.r)
 SELECT 'only_a' AS field, count(*) FILTER (bn IS NULL) AS n FROM j UNION ALL SELECT 'only_b', count(*) FILTER (an IS NULL) FROM j UNION ALL SELECT 'n', count(*) FILTER (an <> bn) FROM j UNION ALL SELECT 'people', count(*) FILTER (ap <> bp) FROM j""",
        "hex_first_differences": f"""{sh}, a AS (SELECT q, r, count(*) AS n, sum(population) AS p, min(kind) AS t FROM hx WHERE kind <> 'village' GROUP BY q, r), b AS (SELECT q, r, count(*) AS n, sum(population) AS p, min(kind) AS t FROM hx WHERE population > 0 GROUP BY q, r),
 j AS (SELECT q, r, unnest([CASE WHEN a.n <> b.n THEN 'n' END, CASE WHEN a.p <> b.p THEN 'people' END, CASE WHEN a.t <> b.t THEN 'kind' END]) AS field FROM a JOIN b USING (q, r))
 SELECT field, count(*) AS n, min((q, r))[1] AS q, min((q, r))[2] AS r FROM j WHERE field IS NOT NULL GROUP BY field""",
        "hex_fingerprint": f"""WITH per_hex AS (PER_HEX), m AS (SELECT sha256(concat('-', {', '.join(f"concat(length(CAST({c} AS VARCHAR)), ':', {c})" for c in ('kind', 'name', 'population', 'q', 'r'))})) AS h FROM per_hex)
 SELECT count(*) AS n, CAST(sum(CAST(concat('0x', substr(h, 1, 15)) AS BIGINT)) % 1152921504606846976 AS BIGINT) AS mark_a, CAST(sum(CAST(concat('0x', substr(h, 16, 15)) AS BIGINT)) % 1152921504606846976 AS BIGINT) AS mark_b FROM m""",
        "quality_checks": f"""{t}, c AS (SELECT count(*) FILTER (NOT elev BETWEEN -120 AND 3000) AS a, count(*) FILTER (NOT slope BETWEEN 0 AND 60) AS b, count(*) FILTER (water AND NOT ({wet})) AS c, count(*) FILTER (kind <> 'none' AND population <= 0) AS d FROM t)
 SELECT 'elevation' AS name, a = 0 AS ok, a AS bad FROM c UNION ALL SELECT 'slope', b = 0, b FROM c UNION ALL SELECT 'water', c = 0, c FROM c UNION ALL SELECT 'settled', d = 0, d FROM c""",
        "osm_elements": "SELECT concat('node/', CAST(CASE WHEN event_id % 10 = 9 THEN event_id // 2 ELSE event_id END AS VARCHAR)) AS osm_id, 'point' AS kind, min(event_type) AS place FROM events GROUP BY 1",
        "open_rings": f"SELECT fid, CAST(2 AS BIGINT) AS ends FROM ({layers.LANDUSE_SQL}) WHERE fid % 5 = 0",
    }
    return sql | {"hex_fingerprint": sql["hex_fingerprint"].replace("PER_HEX", sql["settlements_per_hex"])}

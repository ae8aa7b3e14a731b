"""Registered queries over lines, provinces and records, and their SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexfold.functions import classify, geo
from hexfold.operators import hexes, lines, regions, spatial
from hexfold.operators.scratch import new_folder, written
from hexfold.plans import queries as maps
from hexfold.plans.queries import MERIDIAN, SIZE, _hex_sql, _kind
from hexfold.sources import layers, sinks

ROAD_LEVELS, RAIL_LEVELS = ["highway", "paved", "dirt"], ["double", "standard", "narrow"]


def ways_in_hexes(spark: SparkSession, sf_dir: str, kinds: str) -> DataFrame:
    """Ways of the kinds, cut by hexes."""
    ways = layers.layer(spark, sf_dir, layers.WAYS_SQL).filter(kinds)
    at = layers.layer(spark, sf_dir, layers.WAY_POINTS_SQL).join(ways.select("k"), "k", "left_semi")
    parts = lines.segments(hexes.with_hex(at, SIZE, MERIDIAN))
    return lines.clip(parts, SIZE).join(ways, "k")


def best_road(spark, sf_dir):
    roads = ways_in_hexes(spark, sf_dir, "kind = 'road'").withColumn("level", layers.road_level(F.col("highway")))
    return lines.best_level(roads, "level", ROAD_LEVELS)


def best_rail(spark, sf_dir):
    rails = ways_in_hexes(spark, sf_dir, "kind = 'rail'").withColumn("level", layers.rail_level(F.col("railway"), F.col("gauge"), F.col("tracks")))
    return lines.best_level(rails, "level", RAIL_LEVELS)


def river_hexes(spark, sf_dir):
    found = lines.rivers_of_hexes(ways_in_hexes(spark, sf_dir, "kind = 'river'"))
    return found.select("q", "r", "river_name", F.array_join(F.transform("river_edges", lambda e: e.cast("string")), " ").alias("edges"))


def river_chains(spark, sf_dir):
    """Chains of all hexes that a river crosses."""
    return hexes.chains(river_hexes(spark, sf_dir).select("q", "r").distinct())


def top_rivers(spark, sf_dir):
    """The report of the fifteen names that most hexes have, of rivers up to rank 8."""
    named = lines.ranked_rivers(ways_in_hexes(spark, sf_dir, "kind = 'river'"), 8)
    found = lines.rivers_of_hexes(named).filter("river_name <> ''").groupBy("river_name").agg(F.count(F.lit(1)).alias("n"))
    return found.orderBy(F.desc("n"), "river_name").limit(15)


def river_selection(spark, sf_dir):
    """Waterways that count: named rivers up to rank 8, and the canals of names with a long total, as rank 7."""
    ways = layers.layer(spark, sf_dir, layers.WAYS_SQL)
    rivers = lines.ranked_rivers(ways.filter("kind = 'river'"), 8).select("k", "name", "scalerank")
    canals = ways.filter("kind = 'canal'").join(maps.canal_selection(spark, sf_dir).select("name"), "name", "left_semi")
    return rivers.unionByName(canals.select("k", "name", F.lit(7).alias("scalerank")))


def provinces_of_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pid, country, province of the settlements' points; provinces are the halves of a country."""
    c = layers.layer(spark, sf_dir, layers.COUNTRIES_SQL).withColumn("mid", (F.col("x0") + F.col("x1")) / 2)
    half = lambda name, a, b: F.struct(F.concat("code", F.lit(name)).alias("fid"), F.col(a).alias("a"), F.col(b).alias("b"))
    h = c.select("code", "y0", "y1", F.explode(F.array(half("_W", "x0", "mid"), half("_E", "mid", "x1"))).alias("h"))
    mean = lambda a, b, sign: (F.col(b) + sign * F.col(a)) / 2
    boxes = h.select("h.fid", "code", F.lit("rect").alias("shape"), mean("h.a", "h.b", 1).alias("cx"), mean("y0", "y1", 1).alias("cy"), mean("h.a", "h.b", -1).alias("hw"), mean("y0", "y1", -1).alias("hh"))
    outlines = layers.rings(boxes).join(boxes.select("fid", F.col("code").alias("country")), "fid")
    at = maps.points(spark, sf_dir).join(maps.country_at_point(spark, sf_dir).select(F.col("k").alias("pid"), F.col("code").alias("country")), "pid")
    return at.select("pid", "country").join(regions.assign_province(at, outlines, 0.02), "pid")


def province_at_point(spark, sf_dir):
    return provinces_of_points(spark, sf_dir).select(F.col("pid").alias("k"), "country", "province")


def province_rollup(spark, sf_dir):
    """Points by country and province, with the totals of a country and of all."""
    return province_at_point(spark, sf_dir).rollup("country", "province").agg(F.count(F.lit(1)).alias("n"))


def province_coverage(spark, sf_dir):
    return regions.coverage(province_at_point(spark, sf_dir))


def country_overlaps(spark, sf_dir):
    """Points that two countries cover, by pair, of outlines that reach 0.03 degrees over their borders."""
    wide = maps.country_boxes(spark, sf_dir).withColumns({"hw": F.col("hw") + 0.03, "hh": F.col("hh") + 0.03})
    over = spatial.point_in_polygon(maps.points(spark, sf_dir), layers.rings(wide))
    return regions.overlaps(over.select("pid", F.col("fid").alias("code")))


def admin_tiers(spark, sf_dir):
    """Hexes by province, their tier, and the capital and one sub-capital of each province.

    The capital's name is the least in the province; the sub-capital has the
    same name, so that its exact match is taken already.
    """
    s = maps.in_hexes(spark, sf_dir).join(provinces_of_points(spark, sf_dir), F.col("k") == F.col("pid"))
    s = written(s.select("k", "q", "r", "name", "population", "kind", "country", "province"))
    meta = s.filter("province <> ''").groupBy("province").agg(F.array(F.min("name")).alias("names")).select("province", F.explode(F.array(F.lit(0), F.lit(1))).alias("rank"), "names")
    capitals = regions.designate_capitals(s.filter("province <> ''"), meta)
    town = F.count_if(F.col("kind") != "village") > 0
    by = s.groupBy("q", "r", "country", "province").agg(town.alias("settled"), F.min_by("population", "k").alias("first_population"))
    wet = F.pmod(F.col("q") * 7 + F.col("r") * 3, F.lit(5)) == 0
    by = by.withColumns({"tier": classify.admin_tier(wet, F.col("country"), F.col("province"), F.col("settled")), "kind": F.when(F.col("settled"), "town").otherwise("none"), "name": F.lit(""), "anthrome": F.lit("none")})
    return regions.with_capitals(by, capitals).select("q", "r", "province", "tier", "kind", "name", "anthrome")


def resources_at_hex(spark, sf_dir):
    """Every land use shape as a deposit: polygons of coal and iron, points of steel and oil."""
    shapes = layers.layer(spark, sf_dir, layers.LANDUSE_SQL)
    kind = F.array(*map(F.lit, regions.RESOURCES))[F.floor(F.col("fid") / 50).cast("int") % 4]
    shapes = shapes.withColumn("kind", kind)
    spots = hexes.with_hex(shapes.filter("kind in ('steel', 'oil')").select("kind", F.col("cx").alias("lon"), F.col("cy").alias("lat")), SIZE, MERIDIAN)
    polygons = shapes.filter("kind in ('coal', 'iron')")
    x, y = geo.centre(F.col("q"), F.col("r"), SIZE)
    lon, lat = geo.from_utm(F.col("cx"), F.col("cy"), MERIDIAN)
    centres = maps.occupied(spark, sf_dir).select("q", "r", x.alias("cx"), y.alias("cy")).select("q", "r", lon.alias("x"), lat.alias("y"))
    return regions.resources_of_hexes(centres, layers.rings(polygons), polygons.select("fid", "kind"), spots)


def hex_records(spark, sf_dir):
    best = maps.settlements_per_hex(spark, sf_dir)
    return sinks.hex_records(best, {"settlement": ["name", "kind", "population"]})


def hex_features(spark, sf_dir):
    """Features of hexes with a settlement, read back: name, form of the ring and its eastern corner."""
    f = sinks.geojson_features(maps.settlements_per_hex(spark, sf_dir), ["name", "population"], SIZE, MERIDIAN)
    read = F.from_json("feature", "type string, geometry struct<type: string, coordinates: array<array<array<double>>>>, properties struct<name: string, population: long>")
    ring = F.col("f.geometry.coordinates")[0]
    closed = F.size(ring).alias("corners"), (ring[0] == ring[6]).alias("closed")
    return f.select("q", "r", read.alias("f")).select("q", "r", "f.properties.name", *closed, ring[0][0].alias("lon"), ring[0][1].alias("lat"))


def map_metadata(spark, sf_dir):
    one = sinks.map_metadata(maps.in_hexes(spark, sf_dir), "kind")
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("biomes")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), " ")
    return one.select("min_q", "max_q", "min_r", "max_r", "n", shown.alias("kinds"))


def tiled_settlements(spark, sf_dir):
    """The most significant settlements, written by tiles in two runs, the second of which resumes the first."""
    rows = maps.settlements_per_hex(spark, sf_dir).select("*", F.floor(F.col("q") / 16).cast("int").alias("tile_lon"), F.floor(F.col("r") / 16).cast("int").alias("tile_lat"))
    folder = new_folder(spark, "tiles")
    key = sinks.run_key("tiled_settlements", SIZE, MERIDIAN)
    sinks.write_tiles(rows.filter("pmod(tile_lon, 2) = 0"), folder, key)
    return sinks.write_tiles(rows, folder, key).select("q", "r", "name", "tile_lon", "tile_lat")


QUERIES = [
    best_road, best_rail, river_hexes, river_chains, top_rivers, river_selection, country_overlaps, province_at_point, province_rollup, province_coverage, admin_tiers,
    resources_at_hex, hex_records, hex_features, map_metadata, tiled_settlements,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def _clip_sql(kinds: str) -> str:
    """Hexes of the ways' segments by brute force over each segment's box, by six half planes."""
    pitch, half = 1.5 * geo.radius(SIZE), SIZE / 2
    box = f"unnest(range(CAST(floor(least(x1, x2) / {pitch!r}) AS INT) - 1, CAST(ceil(greatest(x1, x2) / {pitch!r}) AS INT) + 2)) AS q"
    values = ", ".join(f"({j}, cos(radians({30 + 60 * j})), sin(radians({30 + 60 * j})))" for j in range(6))
    return f"""WITH w AS (SELECT * FROM ({layers.WAYS_SQL}) WHERE {kinds}), p AS (SELECT * FROM ({layers.WAY_POINTS_SQL}) WHERE k IN (SELECT k FROM w)), {_hex_sql('p')},
 sg AS (SELECT k, seq, x AS x1, y AS y1, lead(x) OVER v AS x2, lead(y) OVER v AS y2 FROM hx WINDOW v AS (PARTITION BY k ORDER BY seq)),
 c1 AS (SELECT *, {box} FROM sg WHERE x2 IS NOT NULL),
 c2 AS (SELECT *, unnest(range(CAST(floor(least(y1, y2) / {SIZE}) AS INT) - 2, CAST(ceil(greatest(y1, y2) / {SIZE}) AS INT) + 3)) AS r FROM c1),
 c3 AS (SELECT k, seq, CAST(q AS INT) AS q, CAST(r AS INT) AS r, x1, y1, x2 - x1 AS dx, y2 - y1 AS dy, q * {pitch!r}::DOUBLE AS cx, (r + 0.5e0 * (q % 2)) * {SIZE}::DOUBLE AS cy FROM c2),
 c4 AS (SELECT *, (x1 - cx) * nx + (y1 - cy) * ny - {half}::DOUBLE AS g, dx * nx + dy * ny AS f FROM c3, (VALUES {values}) AS n(edge, nx, ny)),
 c5 AS (SELECT k, seq, q, r, sqrt(any_value(dx) ^ 2 + any_value(dy) ^ 2) AS long, bool_or(abs(f) < 1e-9 AND g >= 0) AS off, greatest(0, max(-g / f) FILTER (f < 0)) AS t0, least(1, min(-g / f) FILTER (f > 0)) AS t1,
  arg_max(edge, -g / f) FILTER (f < 0) AS e0, arg_min(edge, -g / f) FILTER (f > 0) AS e1, max(-g / f) FILTER (f < 0) AS m0, min(-g / f) FILTER (f > 0) AS m1 FROM c4 GROUP BY k, seq, q, r),
 cl AS (SELECT k, q, r, (t1 - t0) * long AS metres, CASE WHEN m0 > 0 THEN e0 END AS enter, CASE WHEN m1 < 1 THEN e1 END AS leave, w.* EXCLUDE (k) FROM c5 JOIN w USING (k) WHERE t0 < t1 AND NOT off AND long > 0)"""


def _centre_sql(source: str, east: float = 0.0) -> str:
    """lon and lat of the points ``east`` metres from the centres of hexes q, r."""
    m, R = geo.SCALE * geo._RADIUS, geo.radius(SIZE)
    series = lambda f, g: "".join(f" - {c!r} * {f}({2 * j} * xi) * {g}({2 * j} * eta)" for j, c in enumerate(geo.BETA, 1))
    lat = "chi" + "".join(f" + {c!r} * sin({2 * j} * chi)" for j, c in enumerate(geo.DELTA, 1))
    return f"""z1 AS (SELECT *, (r + 0.5e0 * (((q % 2) + 2) % 2)) * {SIZE}::DOUBLE / {m!r} AS xi, (CAST(q AS DOUBLE) * {1.5 * R!r} - {geo.EASTING - east!r}) / {m!r} AS eta FROM {source}),
z2 AS (SELECT *, xi{series('sin', 'cosh')} AS a, eta{series('cos', 'sinh')} AS b FROM z1), z3 AS (SELECT *, asin(sin(a) / cosh(b)) AS chi FROM z2),
zx AS (SELECT *, {MERIDIAN} + degrees(atan2(sinh(b), cos(a))) AS clon, degrees({lat}) AS clat FROM z3)"""


def oracle_sql() -> dict[str, str]:
    given = maps.oracle_sql()
    per_hex, country = given["settlements_per_hex"], given["country_at_point"].rsplit("SELECT k, code FROM o", 1)[0]
    province = f"""{country}, pv AS (SELECT code AS country, concat(code, '_W') AS pc, x0 AS a, (x0 + x1) / 2 AS b, y0, y1 FROM c UNION ALL SELECT code, concat(code, '_E'), (x0 + x1) / 2, x1, y0, y1 FROM c),
 pd AS (SELECT k, pc, greatest(a - x, 0, x - b) AS dx, greatest(y0 - y, 0, y - y1) AS dy FROM p JOIN o USING (k) JOIN pv ON pv.country = o.code),
 pb AS (SELECT k, min_by(pc, sqrt(dx * dx + dy * dy)) AS pc FROM pd WHERE sqrt(dx * dx + dy * dy) < 0.02 GROUP BY k),
 pp AS (SELECT k, code AS country, coalesce(pc, '') AS province FROM o LEFT JOIN pb USING (k))"""
    s = f"s AS (SELECT *, {_kind()} AS kind FROM ({layers.SETTLEMENTS_SQL}))"
    other = lambda text: re.sub(r"\bh([0-6x])\b", r"g\1", text)
    res = f"(SELECT *, CASE fid // 50 % 4 WHEN 0 THEN 'coal' WHEN 1 THEN 'steel' WHEN 2 THEN 'iron' ELSE 'oil' END AS rk FROM ({layers.LANDUSE_SQL}))"
    road = "CASE WHEN highway IN ('motorway', 'trunk') THEN 0 WHEN highway IN ('primary', 'secondary') THEN 1 END"
    rail = "CASE WHEN railway = 'narrow_gauge' OR gauge < 1000 THEN 2 WHEN tracks >= 2 THEN 0 ELSE 1 END"
    best = lambda rank, names: f"SELECT q, r, ({names})[min({rank}) + 1] AS level FROM cl WHERE ({rank}) IS NOT NULL GROUP BY q, r"
    runs = "rn AS (SELECT q, r, k, min(name) AS name, round(sum(metres), 3) AS m FROM cl {0} GROUP BY q, r, k), bs AS (SELECT q, r, name AS river_name FROM rn QUALIFY row_number() OVER (PARTITION BY q, r ORDER BY m DESC, name) = 1)"
    return {
        "best_road": f"{_clip_sql("kind = 'road'")} {best(road, repr(ROAD_LEVELS))}",
        "best_rail": f"{_clip_sql("kind = 'rail'")} {best(rail, repr(RAIL_LEVELS))}",
        "river_hexes": f"""{_clip_sql("kind = 'river'")}, {runs.format('')}, ed AS (SELECT q, r, enter AS e FROM cl UNION SELECT q, r, leave FROM cl),
 es AS (SELECT q, r, string_agg(CAST(e AS VARCHAR), ' ' ORDER BY e) AS edges FROM ed WHERE e IS NOT NULL GROUP BY q, r) SELECT q, r, river_name, coalesce(edges, '') AS edges FROM bs LEFT JOIN es USING (q, r)""",
        "river_chains": f"""{_clip_sql("kind = 'river'").replace('WITH ', 'WITH RECURSIVE ', 1)}, o AS (SELECT *, q * CAST({1.5 * geo.radius(SIZE)!r} AS DOUBLE) AS cx, (r + 0.5e0 * (q % 2)) * CAST({SIZE} AS DOUBLE) AS cy FROM (SELECT DISTINCT q, r FROM cl)),
 nb AS (SELECT a.q, a.r, b.q AS nq, b.r AS nr FROM o a JOIN o b ON {given['hex_neighbors'].rsplit(' ON ', 1)[1]}),
 ch AS (SELECT q, r, q AS root_q, r AS root_r FROM o UNION SELECT nb.nq, nb.nr, ch.root_q, ch.root_r FROM ch JOIN nb ON ch.q = nb.q AND ch.r = nb.r WHERE (ch.root_q, ch.root_r) < (nb.nq, nb.nr)),
 mn AS (SELECT q, r, min((root_q, root_r)) AS x FROM ch GROUP BY q, r) SELECT q, r, x[1] AS root_q, x[2] AS root_r FROM mn""",
        "top_rivers": f"{_clip_sql("kind = 'river'")}, {runs.format('WHERE scalerank <= 8')} SELECT river_name, count(*) AS n FROM bs GROUP BY river_name ORDER BY n DESC, river_name LIMIT 15",
        "river_selection": f"""WITH c AS ({given['canal_selection']}), w AS (SELECT * FROM ({layers.WAYS_SQL})) SELECT k, name, scalerank FROM w WHERE kind = 'river' AND scalerank <= 8
 UNION ALL SELECT k, name, CAST(7 AS INT) FROM w WHERE kind = 'canal' AND name IN (SELECT name FROM c)""",
        "country_overlaps": f"""WITH p AS (SELECT k, lon + 3.7e-5 AS x, lat + 2.3e-5 AS y FROM ({layers.SETTLEMENTS_SQL})), c AS ({layers.COUNTRIES_SQL}),
 o AS (SELECT k, code FROM p JOIN c ON x > x0 - 0.03 AND x < x1 + 0.03 AND y > y0 - 0.03 AND y < y1 + 0.03) SELECT a.code AS a, b.code AS b, count(*) AS n FROM o a JOIN o b ON a.k = b.k AND a.code < b.code GROUP BY ALL""",
        "province_at_point": f"{province} SELECT k, country, province FROM pp",
        "province_rollup": f"{province} SELECT country, province, count(*) AS n FROM pp GROUP BY ROLLUP (country, province)",
        "province_coverage": f"{province} SELECT country, count(*) AS n, count(*) FILTER (province <> '') AS covered, round(count(*) FILTER (province <> '') / count(*), 6) AS share FROM pp WHERE country <> '' GROUP BY country",
        "admin_tiers": f"""{province}, {s}, {_hex_sql('s')}, nd AS (SELECT hx.k, q, r, name, population, kind, country, province FROM hx JOIN pp USING (k)),
 mn AS (SELECT province, min(name) AS cap FROM nd WHERE province <> '' GROUP BY province), sc AS (SELECT nd.*, CASE WHEN name = cap THEN 100 ELSE 50 END AS score FROM nd JOIN mn USING (province)),
 r0 AS (SELECT province, q, r, name, 'capital' AS t FROM sc QUALIFY row_number() OVER (PARTITION BY province ORDER BY score DESC, population DESC, q DESC, r DESC, name DESC) = 1),
 r1 AS (SELECT province, q, r, name, 'subcapital' AS t FROM sc WHERE (province, q, r) NOT IN (SELECT (province, q, r) FROM r0) QUALIFY row_number() OVER (PARTITION BY province ORDER BY score DESC, population DESC, q DESC, r DESC, name DESC) = 1),
 cp AS (SELECT * FROM r0 UNION ALL SELECT * FROM r1), hb AS (SELECT q, r, country, province, bool_or(kind <> 'village') AS st, min_by(population, k) AS fp FROM nd GROUP BY q, r, country, province)
 SELECT q, r, province, coalesce(t, CASE WHEN (((q * 7 + r * 3) % 5) + 5) % 5 = 0 OR country = '' OR province = '' THEN 'none' WHEN st THEN 'urban' ELSE 'rural' END) AS tier,
 CASE WHEN st THEN 'town' WHEN t IS NULL THEN 'none' WHEN fp >= 50000 THEN 'city' ELSE 'town' END AS kind, coalesce(name, '') AS name, CASE WHEN t IS NOT NULL AND NOT st THEN 'residential' ELSE 'none' END AS anthrome
 FROM hb LEFT JOIN cp USING (province, q, r)""",
        "resources_at_hex": f"""WITH {s}, {_hex_sql('s')}, oc AS (SELECT DISTINCT q, r FROM hx), {_centre_sql('oc')}, rs AS {res}, sp AS (SELECT rk, cx AS lon, cy AS lat FROM rs WHERE rk IN ('steel', 'oil')), {other(_hex_sql('sp'))},
 hl AS (SELECT q, r, rk FROM zx, rs WHERE rk IN ('coal', 'iron') AND CASE shape WHEN 'rect' THEN abs(clon - cx) < hw AND abs(clat - cy) < hh ELSE abs(clon - cx) / hw + abs(clat - cy) / hh < 1 END UNION SELECT q, r, rk FROM gx)
 SELECT q, r, {', '.join(f"coalesce(bool_or(rk = '{x}'), false) AS {x}" for x in regions.RESOURCES)} FROM oc LEFT JOIN hl USING (q, r) GROUP BY q, r""",
        "hex_records": f"""SELECT q, r, concat('{{"hex_id":"', q, '_', r, '","settlement":{{"name":"', name, '","kind":"', kind, '","population":', population, '}}}}') AS record FROM ({per_hex})""",
        "hex_features": f"WITH b AS ({per_hex}), {_centre_sql('b', geo.radius(SIZE))} SELECT q, r, name, CAST(7 AS INT) AS corners, true AS closed, round(clon, 6) AS lon, round(clat, 6) AS lat FROM zx",
        "map_metadata": f"""WITH {s}, {_hex_sql('s')}, g AS (SELECT kind, count(*) AS n FROM hx GROUP BY kind)
 SELECT min(q) AS min_q, max(q) AS max_q, min(r) AS min_r, max(r) AS max_r, count(*) AS n, (SELECT string_agg(concat(kind, '=', n), ' ' ORDER BY kind) FROM g) AS kinds FROM hx""",
        "tiled_settlements": f"SELECT q, r, name, CAST(floor(q / 16) AS INT) AS tile_lon, CAST(floor(r / 16) AS INT) AS tile_lat FROM ({per_hex})",
    }

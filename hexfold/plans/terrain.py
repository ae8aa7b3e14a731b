"""Queries over a raster, grids and points derived from the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hexfold.functions import classify, geo
from hexfold.operators import hexes, lines, raster, spatial, tables
from hexfold.plans import networks
from hexfold.plans import queries as maps
from hexfold.plans.networks import _centre_sql, _clip_sql
from hexfold.plans.queries import MERIDIAN, SIZE, _hex_sql
from hexfold.sources import layers

#: a pixel per event, 400 to a row, from the frame's north-west corner on
DEM_SQL = """SELECT CAST(floor(event_id / 400e0) AS INT) AS px_row, CAST(event_id % 400 AS INT) AS px_col,
 CAST(CASE WHEN event_id % 997 = 0 THEN -32768 ELSE abs((event_id % 400) % 100 - 50) * (1 + CAST(floor(event_id / 400e0) AS BIGINT) % 10) - 8 + event_id % 7 END AS DOUBLE) AS elev FROM events"""
LEFT, TOP, STEP = 4.0, 51.0, 0.0025
PLACE = dict(left=LEFT, top=TOP, step_x=STEP, step_y=-STEP)


def dem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.layer(spark, sf_dir, DEM_SQL)


def stored_dem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raster as a table of blocks."""
    return raster.store(raster.blocks(dem(spark, sf_dir)))


def slopes(stored: DataFrame) -> DataFrame:
    return raster.slope_deg(stored, STEP, -STEP, TOP)


def dem_slope(spark, sf_dir):
    return raster.pixels(slopes(stored_dem(spark, sf_dir)), "slope").withColumn("slope", F.round("slope", 6))


def hillshade(spark, sf_dir):
    return raster.pixels(raster.hillshade(stored_dem(spark, sf_dir)), "shade").withColumn("shade", F.round("shade", 6))


def point_elevation(spark, sf_dir):
    """Elevation of the pixel of every settlement."""
    return raster.sample(maps.points(spark, sf_dir), stored_dem(spark, sf_dir), **PLACE).select(F.col("pid").alias("k"), "elev")


def dem_window(spark, sf_dir):
    """The pixels of a box of the raster, renumbered, with the window's corner."""
    held, left, top = raster.window(stored_dem(spark, sf_dir), (4.211, 50.5, 4.629, 50.991), **PLACE)
    return held.select("px_row", "px_col", "elev", F.lit(round(left, 4)).alias("left"), F.lit(round(top, 4)).alias("top"))


def zone_slope_p90(spark, sf_dir):
    """90th percentile of slopes in the box of every land use shape."""
    s = layers.layer(spark, sf_dir, layers.LANDUSE_SQL)
    at = lambda a, b, sign: F.col(a) + sign * F.col(b)
    boxes = s.select(F.col("fid").alias("zid"), at("cx", "hw", -1).alias("x0"), at("cy", "hh", -1).alias("y0"), at("cx", "hw", 1).alias("x1"), at("cy", "hh", 1).alias("y1"))
    return raster.zonal_p90(boxes, slopes(stored_dem(spark, sf_dir)), **PLACE).select("zid", F.round("p90", 6).alias("p90"))


def grid_population(spark, sf_dir):
    """The grid over the box of all settlements, with the settlements of each hex."""
    s = layers.layer(spark, sf_dir, layers.SETTLEMENTS_SQL)
    box = s.agg(F.min("lon"), F.min("lat"), F.max("lon"), F.max("lat")).first()
    grid = hexes.hex_grid(spark, tuple(box), SIZE, ("utm", (MERIDIAN,)))
    n = hexes.with_hex(s, SIZE, MERIDIAN).groupBy("q", "r").agg(F.count(F.lit(1)).alias("n"))
    return grid.join(n, ["q", "r"], "left").select("q", "r", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), F.coalesce("n", F.lit(0)).alias("n"))


def frames(spark, sf_dir):
    """Boxes by centre and size, the centre and sizes of each again, the kind of its projection, and whether it meets the frame."""
    n = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("k"), (40.0 + F.col("c_custkey") % 20).alias("lat"), (F.col("c_custkey") % 31 - 5.0).alias("lon"), (50.0 + (F.col("c_custkey") * 97) % 3000).alias("w"), (50.0 + (F.col("c_custkey") * 61) % 2500).alias("h"))
    b = n.select("k", *[x.alias(a) for x, a in zip(geo.box_from_center(F.col("lat"), F.col("lon"), F.col("w"), F.col("h")), ("x0", "y0", "x1", "y1"), strict=True)])
    box = tuple(F.col(x) for x in ("x0", "y0", "x1", "y1"))
    (lat, lon), (w, h) = geo.box_center(*box), (geo.box_width_km(*box), geo.box_height_km(F.col("y0"), F.col("y1")))
    meets = geo.overlaps(box, (F.lit(4.0), F.lit(50.5), F.lit(5.0), F.lit(51.0)))
    return b.select("k", *[F.round(x, 6).alias(a) for x, a in ((box[0], "x0"), (box[1], "y0"), (box[2], "x1"), (box[3], "y1"), (lat, "lat"), (lon, "lon"), (w, "w"), (h, "h"))], geo.projection_kind(w, h).alias("kind"), meets.alias("meets"))


def landuse_slice(spark, sf_dir):
    """The shapes of a slice with its margin, each once though parts repeat it, by tile of its corner."""
    s = layers.layer(spark, sf_dir, layers.LANDUSE_SQL)
    parts = s.select("fid", (F.col("cx") - F.col("hw")).alias("min_x"), (F.col("cx") + F.col("hw")).alias("max_x"), (F.col("cy") - F.col("hh")).alias("min_y"), (F.col("cy") + F.col("hh")).alias("max_y"))
    parts = parts.union(parts.filter("fid % 3 = 0"))
    held = layers.layer_slice(parts, 4.4, 50.6, 4.6, 50.7, margin=0.1, key="fid")
    lon, lat = geo.tile(F.col("min_x") * 4, F.col("min_y") * 4)
    return held.select("fid", lon.alias("tile_lon"), lat.alias("tile_lat"))


def hex_distances(spark, sf_dir):
    """Metres between each hex with a settlement and the one two steps to the east, and whether that has none (infinitely far)."""
    h = maps.occupied(spark, sf_dir)
    x, y = geo.centre(F.col("q"), F.col("r"), SIZE)
    pairs = h.select("q", "r", (F.col("q") + 2).alias("nq"), F.col("r").alias("nr"))
    return hexes.distances(pairs, h.select("q", "r", x.alias("cx"), y.alias("cy"))).select("q", "r", F.when(F.col("metres") < float("inf"), F.round("metres", 3)).alias("metres"), (F.col("metres") == float("inf")).alias("absent"))


def display_numbers(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/customer.parquet").select((F.col("c_custkey") % 140 + 1).cast("int").alias("col"), (F.floor(F.col("c_custkey") / 140) + 1).cast("int").alias("row"))
    return o.select("col", "row", geo.hex_id(F.col("col"), F.col("row")).alias("id"), geo.display_number(F.col("col"), F.col("row"), True).alias("wide"), geo.display_number(F.col("col") % 100, F.col("row") % 100, False).alias("short"))


def resolved_biomes(spark, sf_dir):
    """Biomes by name, of eight classes where only the class is known, plains for others."""
    t = maps.terrain(spark, sf_dir)
    raw = F.when(F.col("k") % 4 == 0, F.col("biome")).when(F.col("k") % 4 == 1, classify.terrain_class(F.col("biome"))).when(F.col("k") % 4 == 2, F.lit("nothing"))
    return t.groupBy(classify.resolve_biome(raw).alias("biome")).agg(F.count(F.lit(1)).alias("n"))


def terrain_effects(spark, sf_dir):
    """Parts by class of their terrain, with the class's effects."""
    t = maps.terrain(spark, sf_dir).groupBy(classify.terrain_class(F.col("biome")).alias("terrain")).agg(F.count(F.lit(1)).alias("n"))
    return t.join(F.broadcast(classify.terrain_effects(spark)), "terrain")


def valid_regions(spark, sf_dir):
    """Orders as features valid from their date for a time, at one date; no end is open."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("start"), F.when(F.col("o_orderkey") % 3 > 0, F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 500).cast("int")).cast("string")).alias("end"))
    return tables.valid_at(o, "1995-06-17").select("o_orderkey")


def shore_hexes(spark, sf_dir):
    """Hexes that the outlines of countries run through."""
    corners = layers.rings(maps.country_boxes(spark, sf_dir))
    ends = corners.select("fid", F.xxhash64("fid", "x1", "y1", "x2", "y2").alias("k"), F.inline(F.array(F.struct(F.lit(1).alias("seq"), F.col("x1").alias("lon"), F.col("y1").alias("lat")), F.struct(F.lit(2).alias("seq"), F.col("x2").alias("lon"), F.col("y2").alias("lat")))))
    return lines.shore_hexes(lines.segments(geo.project(ends, ("utm", (MERIDIAN,)))), SIZE)


def land_lake_flags(spark, sf_dir):
    """Settlements on land (a country), water or in a lake."""
    lakes = spark.read.parquet(f"{sf_dir}/region.parquet").select(F.col("r_regionkey").alias("fid"), F.lit("diamond").alias("shape"), (4.2 + F.col("r_regionkey") * 0.15).alias("cx"), F.lit(50.75).alias("cy"), F.lit(0.07).alias("hw"), F.lit(0.05).alias("hh"))
    flags = spatial.flag_land_lake(maps.points(spark, sf_dir), layers.rings(maps.country_boxes(spark, sf_dir)), layers.rings(lakes))
    return flags.select(F.col("pid").alias("k"), "water", "lake")


def chain_sizes(spark, sf_dir):
    """Chains of the hexes with a settlement, their sizes, and which are alone."""
    h = maps.occupied(spark, sf_dir)
    return hexes.chain_sizes(h, h).select("root_q", "root_r", "n", "isolated", "interior")


def urban_sprawl(spark, sf_dir):
    """Footprints of cities over hexes by land use at random: parent, kilometres, and what each hex becomes."""
    h = maps.in_hexes(spark, sf_dir).groupBy("q", "r").agg(F.max_by(F.struct("kind", "name", "population"), F.struct("population", -F.col("k"))).alias("s"), F.count(F.lit(1)).alias("n"))
    code = F.pmod(F.col("q") * 7 + F.col("r") * 3, F.lit(5))
    h = h.select("q", "r", "s.kind", "s.name", "s.population", F.when(code == 0, "residential").when(code == 1, "industrial").otherwise("farmland").alias("landuse"), (code < 3).alias("built"), (code == 3).alias("open"))
    h = h.withColumns({"anthrome": F.lit("none"), "population_class": classify.population_class(F.col("kind"))})
    seeds = h.filter("kind in ('city', 'metropolis')").select("q", "r", classify.sprawl_radius_km(F.col("kind"), F.col("population")).alias("radius_km"))
    made = hexes.footprint(h.drop("built", "open", "population"), hexes.sprawl(h.select("q", "r", "built", "open"), seeds, SIZE))
    return made.select("q", "r", "kind", "anthrome", "population_class", "parent_city", F.round("km", 1).alias("km"))


def tiles_equal_whole(spark, sf_dir):
    """Differences between land use at points computed whole and computed by tiles with a margin: none."""
    whole = maps.landuse_at_point(spark, sf_dir)
    points, shapes = maps.points(spark, sf_dir), layers.layer(spark, sf_dir, layers.LANDUSE_SQL)
    area = F.when(F.col("shape") == "rect", 4).otherwise(2) * F.col("hw") * F.col("hh")
    features = shapes.select("fid", F.round(area, 9).alias("area"), F.col("landuse_type").alias("kind"))
    parts = shapes.select("*", (F.col("cx") - F.col("hw")).alias("min_x"), (F.col("cx") + F.col("hw")).alias("max_x"), (F.col("cy") - F.col("hh")).alias("min_y"), (F.col("cy") + F.col("hh")).alias("max_y"))
    tiled = None
    for x0 in (4.0, 4.5):
        for y0 in (50.5, 50.75):
            part = layers.layer_slice(parts, x0, y0, x0 + 0.5, y0 + 0.25, 0.05, "fid")
            here = points.filter(F.col("x").between(x0, x0 + 0.5 - 1e-9) & F.col("y").between(y0, y0 + 0.25 - 1e-9))
            one = spatial.smallest_cover(here, layers.rings(part), features).select(F.col("pid").alias("k"), F.col("kind").alias("landuse"))
            tiled = one if tiled is None else tiled.union(one)
    return tables.diff(whole, tiled, ["k"])


QUERIES = [
    dem_slope, hillshade, point_elevation, dem_window, zone_slope_p90, grid_population, frames, landuse_slice, hex_distances, display_numbers, resolved_biomes,
    terrain_effects, valid_regions, shore_hexes, land_lake_flags, chain_sizes, urban_sprawl, tiles_equal_whole,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    given = maps.oracle_sql()
    masked = f"d AS (SELECT px_row, px_col, nullif(elev, -32768) AS elev FROM ({DEM_SQL}))"
    near = lambda a, dr, dc: f"LEFT JOIN d {a} ON {a}.px_row = d.px_row + {dr} AND {a}.px_col = d.px_col + {dc}"
    sides = f"{near('w', 0, -1)} {near('e', 0, 1)} {near('n', -1, 0)} {near('s', 1, 0)}"
    slope = f"""{masked}, sl AS (SELECT d.px_row, d.px_col, degrees(atan(sqrt(((e.elev - w.elev) / (2 * {STEP} * 111320 * cos(radians({TOP} - (d.px_row + 0.5) * {STEP})))) ^ 2 + ((s.elev - n.elev) / (2 * {STEP} * 111320)) ^ 2))) AS slope FROM d {sides})"""
    pts = f"p AS (SELECT k, lon + 3.7e-5 AS x, lat + 2.3e-5 AS y FROM ({layers.SETTLEMENTS_SQL}))"
    sup = given["settlements_per_hex"].split(", v AS (SELECT", 1)[0]
    occupied = f"{sup}, o AS (SELECT DISTINCT q, r FROM hx)"
    e = lambda side: f"coalesce({side}.elev, d.elev)"
    terrain = given["biome_distribution"].rsplit(" SELECT biome", 1)[0]
    eight = "CASE WHEN biome IN ('water', 'coastal_water', 'lake') THEN 'water' WHEN biome IN ('hill', 'highland_plateau', 'tundra') THEN 'rough' WHEN biome IN ('mountain', 'glacier') THEN 'mountain' WHEN biome IN ('marsh', 'swamp') THEN 'marsh' WHEN biome IN ('forest', 'desert', 'urban') THEN biome ELSE 'clear' END"
    back = "CASE {0} WHEN 'clear' THEN 'plains' WHEN 'rough' THEN 'hill' ELSE {0} END".format(f"({eight})")
    margin = geo.radius(SIZE) / 111_000
    beside = given["hex_neighbors"].rsplit(" ON ", 1)[1]
    cy = given["hex_neighbors"].split(" SELECT a.q", 1)[0]
    rows = " UNION ALL ".join(f"SELECT '{k}' AS terrain, CAST({a} AS INT) AS cost, CAST({b} AS INT) AS defense, {str(c).lower()} AS blocks_los, '{d}' AS note" for k, (a, b, c, d) in classify.EFFECTS.items())
    return {
        "dem_slope": f"WITH {slope} SELECT px_row, px_col, round(slope, 6) AS slope FROM sl",
        "hillshade": f"""WITH {masked}, g AS (SELECT d.px_row, d.px_col, d.elev, {e('e')} - {e('w')} AS gx, {e('n')} - {e('s')} AS gy FROM d {sides}),
 l AS (SELECT px_row, px_col, CASE WHEN elev IS NOT NULL THEN (sin(radians(45)) - gx * cos(radians(-225)) * cos(radians(45)) - gy * sin(radians(-225)) * cos(radians(45))) / sqrt(1 + gx * gx + gy * gy) END AS l FROM g)
 SELECT px_row, px_col, round((l - min(l) OVER ()) / (max(l) OVER () - min(l) OVER ()), 6) AS shade FROM l""",
        "point_elevation": f"WITH {masked}, {pts} SELECT k, coalesce(elev, 0) AS elev FROM p LEFT JOIN d ON d.px_col = CAST(round_even((x - {LEFT}) / {STEP}, 0) AS INT) AND d.px_row = CAST(round_even(({TOP} - y) / {STEP}, 0) AS INT)",
        "dem_window": f"WITH {masked} SELECT px_row - 3 AS px_row, px_col - 84 AS px_col, elev, 4.21e0 AS left, 50.9925e0 AS top FROM d WHERE px_col BETWEEN 84 AND 251 AND px_row BETWEEN 3 AND 199",
        "zone_slope_p90": f"""WITH {slope}, z AS (SELECT fid, floor((cx - hw - {LEFT}) / {STEP}) AS c0, ceil((cx + hw - {LEFT}) / {STEP}) AS c1, floor(({TOP} - (cy + hh)) / {STEP}) AS r0, ceil(({TOP} - (cy - hh)) / {STEP}) AS r1 FROM ({layers.LANDUSE_SQL}))
 SELECT fid AS zid, round(coalesce(quantile_cont(slope, 0.9), 0), 6) AS p90 FROM z LEFT JOIN sl ON px_col BETWEEN c0 AND c1 AND px_row BETWEEN r0 AND r1 AND slope IS NOT NULL GROUP BY fid""",
        "grid_population": f"""{sup}, n AS (SELECT q, r, count(*) AS n FROM hx GROUP BY q, r), b AS (SELECT min(lon) AS x0, min(lat) AS y0, max(lon) AS x1, max(lat) AS y1, min(q) - 4 AS q0, max(q) + 5 AS q1, min(r) - 4 AS r0, max(r) + 5 AS r1 FROM hx),
 g0 AS (SELECT unnest(range(q0, q1)) AS q, r0, r1 FROM b), gr AS (SELECT CAST(q AS INT) AS q, CAST(unnest(range(r0, r1)) AS INT) AS r FROM g0), {_centre_sql('gr')}
 SELECT q, r, round(clon, 6) AS lon, round(clat, 6) AS lat, coalesce(n, 0) AS n FROM zx CROSS JOIN b LEFT JOIN n USING (q, r)
 WHERE clon BETWEEN x0 - {margin!r} / greatest(0.2, cos(radians(y1))) AND x1 + {margin!r} / greatest(0.2, cos(radians(y1))) AND clat BETWEEN y0 - {margin!r} AND y1 + {margin!r}""",
        "frames": """WITH n AS (SELECT c_custkey AS k, 40.0e0 + c_custkey % 20 AS lat, c_custkey % 31 - 5.0e0 AS lon, 50.0e0 + (c_custkey * 97) % 3000 AS w, 50.0e0 + (c_custkey * 61) % 2500 AS h FROM customer),
 b AS (SELECT *, w / 2 / (111.32e0 * cos(radians(lat))) AS a, h / 2 / 111.32e0 AS c FROM n)
 SELECT k, round(lon - a, 6) AS x0, round(lat - c, 6) AS y0, round(lon + a, 6) AS x1, round(lat + c, 6) AS y1, round(lat, 6) AS lat, round(lon, 6) AS lon, round(w, 6) AS w, round(h, 6) AS h,
 CASE WHEN round(greatest(w, h), 6) < 200 THEN 'utm' WHEN round(greatest(w, h), 6) < 2000 THEN 'lcc' ELSE 'aeqd' END AS kind, lon - a <= 5 AND lon + a >= 4 AND lat - c <= 51 AND lat + c >= 50.5 AS meets FROM b""",
        "landuse_slice": f"""SELECT fid, CAST(floor((cx - hw) * 4) AS INT) AS tile_lon, CAST(floor((cy - hh) * 4) AS INT) AS tile_lat FROM ({layers.LANDUSE_SQL})
 WHERE cx - hw <= 4.6e0 + 0.1e0 AND cx + hw >= 4.4e0 - 0.1e0 AND cy - hh <= 50.7e0 + 0.1e0 AND cy + hh >= 50.6e0 - 0.1e0""",
        "hex_distances": f"{occupied} SELECT a.q, a.r, CASE WHEN b.q IS NOT NULL THEN round(3e0 * {geo.radius(SIZE)!r}::DOUBLE, 3) END AS metres, b.q IS NULL AS absent FROM o a LEFT JOIN o b ON b.q = a.q + 2 AND b.r = a.r",
        "display_numbers": """WITH o AS (SELECT CAST(c_custkey % 140 + 1 AS INT) AS col, CAST(floor(c_custkey / 140) + 1 AS INT) AS row FROM customer)
 SELECT col, row, concat(col, '_', row) AS id, printf('%03d%03d', col, row) AS wide, printf('%02d%02d', col % 100, row % 100) AS short FROM o""",
        "resolved_biomes": f"{terrain} SELECT CASE k % 4 WHEN 0 THEN biome WHEN 1 THEN {back} ELSE 'plains' END AS biome, count(*) AS n FROM t GROUP BY 1",
        "terrain_effects": f"{terrain}, e AS ({rows}), c AS (SELECT {eight} AS terrain, count(*) AS n FROM t GROUP BY 1) SELECT terrain, n, cost, defense, blocks_los, note FROM c JOIN e USING (terrain)",
        "valid_regions": "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1995-06-17' AND (o_orderkey % 3 = 0 OR CAST(o_orderdate AS DATE) + CAST(o_orderkey % 500 AS INT) > DATE '1995-06-17')",
        "shore_hexes": _shores_sql(),
        "land_lake_flags": f"""WITH {pts}, c AS ({layers.COUNTRIES_SQL}), f AS (SELECT k, NOT EXISTS (SELECT 1 FROM c WHERE x > x0 AND x < x1 AND y > y0 AND y < y1) AS water,
 EXISTS (SELECT 1 FROM region WHERE abs(x - (4.2e0 + r_regionkey * 0.15e0)) / 0.07e0 + abs(y - 50.75e0) / 0.05e0 < 1) AS inside FROM p) SELECT k, water, inside AND NOT water AS lake FROM f""",
        "chain_sizes": f"""{cy.replace('WITH ', 'WITH RECURSIVE ', 1)}, e AS (SELECT a.q, a.r, b.q AS nq, b.r AS nr FROM o a JOIN o b ON {beside}),
 z AS (SELECT q, r, q AS root_q, r AS root_r FROM o UNION SELECT e.nq, e.nr, z.root_q, z.root_r FROM z JOIN e ON z.q = e.q AND z.r = e.r WHERE (z.root_q, z.root_r) < (e.nq, e.nr)),
 m AS (SELECT q, r, min((root_q, root_r)) AS x FROM z GROUP BY q, r) SELECT x[1] AS root_q, x[2] AS root_r, count(*) AS n, count(*) = 1 AS isolated, false AS interior FROM m GROUP BY x""",
        "tiles_equal_whole": "SELECT unnest(['only_a', 'only_b', 'landuse']) AS field, CAST(0 AS BIGINT) AS n",
    }


def _shores_sql() -> str:
    """Outlines of countries as ways, by the brute force of ``_clip_sql``."""
    ways = f"(SELECT row_number() OVER (ORDER BY code, s) AS k, * FROM ({layers.COUNTRIES_SQL}) CROSS JOIN (SELECT unnest(range(4)) AS s))"
    points = f"""(SELECT k, seq, CASE WHEN (s + seq) % 4 IN (1, 2) THEN x0 ELSE x1 END AS lon, CASE WHEN (s + seq) % 4 IN (2, 3) THEN y0 ELSE y1 END AS lat FROM {ways} CROSS JOIN (SELECT unnest([1, 2]) AS seq))"""
    sql = _clip_sql("true").replace(f"({layers.WAYS_SQL})", ways).replace(f"({layers.WAY_POINTS_SQL})", points)
    return f"{sql} SELECT DISTINCT q, r FROM cl"

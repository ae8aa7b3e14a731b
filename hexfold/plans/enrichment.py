"""The whole enrichment: a grid, every layer joined to it, the passes over neighbours, and one record a hex.

Layers come from staged elements and boundary files, as they would on a map of
any size; each join is one of the library's operators.  Hexes, settlements and
what is found per hex are written where several later steps read them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexfold.functions import classify, geo
from hexfold.operators import hexes, lines, quality, raster, regions, spatial
from hexfold.operators.scratch import written
from hexfold.plans import elements as staged
from hexfold.plans import queries as maps
from hexfold.plans import terrain
from hexfold.plans.networks import RAIL_LEVELS, ROAD_LEVELS
from hexfold.sources import boundaries, elements, layers, sinks

FRAME = (4.0, 50.5, 5.0, 51.0)
SNAP = 0.02
RANK, LONG_CANAL = 8, 110_000.0


def in_plane(layer: DataFrame, projection: tuple, *keep: str) -> DataFrame:
    """osm_id, ``keep``, x1, y1, x2, y2: the segments of a layer's lines, both ends projected where they lie."""
    parts = elements.line_segments(layer, *keep)
    for n in (1, 2):
        parts = geo.project(parts, projection, f"lon{n}", f"lat{n}").withColumnsRenamed({"x": f"x{n}", "y": f"y{n}"})
    return parts.select("osm_id", *keep, "x1", "y1", "x2", "y2").filter("x2 is not null")


def in_projection(layer: DataFrame, projection: tuple, size: float, *keep: str) -> DataFrame:
    """Lines of a layer cut by hexes, with ``keep``."""
    return lines.clip(in_plane(layer, projection, *keep), size)


def settlement_of_hexes(places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The most significant settlement of each hex, and all nodes (q, r, osm_id, name, population, kind).

    Villages never tag a hex, towns only with 20,000 people; ties go to the least osm_id.
    """
    nodes = places.withColumn("kind", classify.settlement_type(F.col("place_type"), F.col("population")))
    tier = F.when(F.col("kind") == "metropolis", 3).when(F.col("kind") == "city", 2).when((F.col("kind") == "town") & (F.col("population") >= 20_000), 1)
    order = F.struct((-tier).alias("t"), (-F.col("population")).alias("p"), "osm_id")
    best = nodes.filter(tier.isNotNull()).groupBy("q", "r").agg(F.min_by(F.struct("name", "kind", "population", "place_type"), order).alias("s"))
    return best.select("q", "r", "s.name", "s.kind", "s.population", "s.place_type"), nodes


def enriched(spark: SparkSession, sf_dir: str, size: float = maps.SIZE, box: tuple = FRAME) -> DataFrame:
    """Every hex of a frame with what ``sinks.full_records`` takes."""
    projection = geo.select_projection(*box)
    parsed = lambda df: layers.parse_osm_elements(df)
    grid = written(hexes.hex_grid(spark, box, size, projection).withColumn("pid", F.struct("q", "r")))
    centres = grid.select("pid", F.col("lon").alias("x"), F.col("lat").alias("y"))

    # water, elevation and slope
    countries = boundaries.read_geojson(spark, staged.boundary_files(spark, sf_dir)[0], "country_code string")
    outlines = written(boundaries.outlines(countries, "country_code"))
    land = layers.rings(spark.createDataFrame([("land", "rect", (box[0] + 0.04 + box[2]) / 2, (box[1] + box[3]) / 2, (box[2] - box[0]) / 2 + 0.06, (box[3] - box[1]) / 2 + 0.1)], "fid string, shape string, cx double, cy double, hw double, hh double"))
    lakes = layers.rings(spark.read.parquet(f"{sf_dir}/region.parquet").select(F.col("r_regionkey").alias("fid"), F.lit("diamond").alias("shape"), (4.2 + F.col("r_regionkey") * 0.15).alias("cx"), F.lit(50.75).alias("cy"), F.lit(0.03).alias("hw"), F.lit(0.02).alias("hh")))
    wet = spatial.flag_land_lake(centres, land, lakes).select("pid", "water", "lake")
    dem = terrain.stored_dem(spark, sf_dir)
    elev = raster.sample(centres, dem, **terrain.PLACE).select("pid", "elev")
    half = size / 2 / 111_320
    wide = half / F.cos(F.radians("y"))
    zones = centres.select(F.col("pid").alias("zid"), (F.col("x") - wide).alias("x0"), (F.col("y") - half).alias("y0"), (F.col("x") + wide).alias("x1"), (F.col("y") + half).alias("y1"))
    slope = raster.zonal_p90(zones, terrain.slopes(dem), **terrain.PLACE).select(F.col("zid").alias("pid"), F.col("p90").alias("slope"))
    base = written(reduce(lambda a, b: a.join(b, "pid", "left"), (wet, elev, slope), grid))
    dry = base.filter("not water and not lake")
    dry_centres = dry.select("pid", F.col("lon").alias("x"), F.col("lat").alias("y"))

    # land use, settlements, country and province
    uses = written(elements.landuse_layer(parsed(staged.areas(spark, sf_dir))), "landuse")
    rings = elements.ring_segments(uses)
    features = uses.select(F.col("osm_id").alias("fid"), F.col("landuse_type").alias("kind"), elements.ring_area(F.col("points")).alias("area"))
    landuse = spatial.smallest_cover(dry_centres, rings, features).select("pid", F.col("kind").alias("landuse"))
    places = geo.place_in_hex(geo.project(elements.settlement_layer(parsed(staged.places(spark, sf_dir))), projection), size)
    best, nodes = settlement_of_hexes(written(places))
    country = spatial.cover_or_snap(dry_centres, outlines, outlines.select("fid", F.col("fid").alias("code")).distinct(), SNAP).select("pid", F.col("code").alias("country"))
    country = written(country)
    halves = outlines.groupBy("fid").agg(F.min("x1").alias("x0"), F.max("x1").alias("x1"), F.min("y1").alias("y0"), F.max("y1").alias("y1")).withColumn("mid", (F.col("x0") + F.col("x1")) / 2)
    part = lambda name, a, b: F.struct(F.concat("fid", F.lit(name)).alias("fid"), ((F.col(a) + F.col(b)) / 2).alias("cx"), ((F.col(b) - F.col(a)) / 2).alias("hw"))
    shapes = halves.select(F.col("fid").alias("country"), "y0", "y1", F.inline(F.array(part("_W", "x0", "mid"), part("_E", "mid", "x1"))))
    shapes = shapes.select("country", "fid", F.lit("rect").alias("shape"), "cx", ((F.col("y0") + F.col("y1")) / 2).alias("cy"), "hw", ((F.col("y1") - F.col("y0")) / 2).alias("hh"))
    province_rings = layers.rings(shapes).join(shapes.select("fid", "country"), "fid")
    province = regions.assign_province(dry_centres.join(country, "pid"), province_rings, SNAP).select("pid", "province")

    # lines
    ways = written(parsed(staged.ways(spark, sf_dir)))
    road = lines.best_level(in_projection(elements.road_layer(ways), projection, size, "road_level"), "road_level", ROAD_LEVELS).select("q", "r", F.col("road_level").alias("road"))
    rail = lines.best_level(in_projection(elements.rail_layer(ways), projection, size, "rail_level"), "rail_level", RAIL_LEVELS).select("q", "r", F.col("rail_level").alias("rail"))
    waters = elements.waterway_layer(ways, F.col("tags")["scalerank"].cast("int").alias("scalerank"))
    chosen = lines.selected_waterways(waters, in_plane(waters.filter("waterway_type = 'canal'"), projection), RANK, LONG_CANAL)
    rivers = lines.rivers_of_hexes(in_projection(chosen, projection, size, "name"), "osm_id").withColumn("has_river", F.lit(True))
    rivers = written(rivers)
    crossed = rivers.filter(F.size("river_edges") > 0).join(base, ["q", "r"]).select("pid", F.col("lon").alias("x"), F.col("lat").alias("y"))
    bridges = elements.bridge_layer(parsed(staged.crossings(spark, sf_dir))).select(F.col("lon").alias("x"), F.col("lat").alias("y"))
    bridge = spatial.within(crossed, bridges, geo.radius(size) / 111_320).select("pid", F.lit(True).alias("bridge"))

    # resources
    bearing = F.create_map(*[F.lit(x) for pair in zip(("quarry", "industrial", "sand", "beach"), regions.RESOURCES, strict=True) for x in pair])
    marked = layers.layer(spark, sf_dir, layers.LANDUSE_SQL).withColumn("kind", bearing[F.col("landuse_type")]).filter("kind is not null")
    spots = geo.place_in_hex(geo.project(marked.filter("kind in ('steel', 'oil')").select("kind", F.col("cx").alias("lon"), F.col("cy").alias("lat")), projection), size)
    fields = marked.filter("kind in ('coal', 'iron')")
    found = regions.resources_of_hexes(base.select("q", "r", F.col("lon").alias("x"), F.col("lat").alias("y")), layers.rings(fields), fields.select("fid", "kind"), spots.select("q", "r", "kind"))

    # one row a hex, and its classes
    by_pid = (landuse, country, province, bridge)
    by_hex = (road, rail, rivers, found)
    h = reduce(lambda a, b: a.join(b, "pid", "left"), by_pid, base)
    h = reduce(lambda a, b: a.join(b, ["q", "r"], "left"), by_hex, h)
    c, is_dry = F.col, ~F.col("water") & ~F.col("lake")
    h = h.join(best, ["q", "r"], "left")
    h = h.withColumns({x: F.when(is_dry, c(x)) for x in ("name", "kind", "population", "place_type", "road", "rail")})
    h = h.withColumns({"kind": F.coalesce("kind", F.lit("none")), "name": F.coalesce("name", F.lit("")), "country": F.coalesce("country", F.lit("")), "province": F.coalesce("province", F.lit(""))})
    h = h.withColumn("biome", classify.biome(c("water"), c("lake"), F.lit(False), c("landuse"), c("elev"), c("slope"), c("lat"), c("lon"), c("place_type")))
    h = h.withColumns({"vegetation": classify.vegetation(c("landuse"), c("biome")), "moisture": classify.moisture(c("biome"), c("landuse"), c("elev"), c("lat"), c("lon")), "anthrome": classify.anthrome(c("biome"), c("landuse"), c("kind")), "population_class": classify.population_class(c("kind"))})
    h = written(h.drop("water", "lake", "pid"))

    # passes over neighbours: coast, footprints, tiers and capitals
    wet = classify.is_water(c("biome"))
    h = hexes.beaches(h.join(hexes.coastal(h.select("q", "r", wet.alias("water"))), ["q", "r"]).drop("water"))
    h = written(h)
    built = (c("biome") == "urban") | F.coalesce(c("landuse").isin("residential", "industrial"), F.lit(False))
    seeds = h.filter("kind in ('city', 'metropolis')").select("q", "r", classify.sprawl_radius_km(c("kind"), F.coalesce("population", F.lit(0))).alias("radius_km"))
    h = hexes.footprint(h, hexes.sprawl(h.select("q", "r", built.alias("built"), c("biome").isin("plains", "steppe").alias("open")), seeds, size))
    h = written(h.withColumn("tier", classify.admin_tier(wet, c("country"), c("province"), c("kind") != "none")))
    people = nodes.select("q", "r", "osm_id", "name", "population").join(h.filter("province <> ''").select("q", "r", "province"), ["q", "r"])
    meta = people.filter("name <> ''").groupBy("province").agg(F.min("name").alias("a"), F.max("name").alias("b")).select("province", F.posexplode(F.array(F.array("a"), F.array("b"))).alias("rank", "names"))
    capitals = regions.designate_capitals(people, meta)
    first = nodes.groupBy("q", "r").agg(F.min_by("population", "osm_id").alias("first_population"))
    done = regions.with_capitals(h.join(first, ["q", "r"], "left"), capitals)
    classes = F.when((c("kind") == "city") & (c("population_class") == 0), 3).when((c("kind") == "town") & (c("population_class") == 0), 2).otherwise(c("population_class"))
    inert = {"port": F.lit(False), "airfield": F.lit(False), "fortification": F.lit("none"), "population_class": classes, "tier": F.when(c("tier") == "subcapital", "sub_capital").otherwise(c("tier"))}
    out = written(done.withColumns(inert))
    sinks.require_complete(grid, out)
    return out


def hex_enrichment(spark, sf_dir):
    """The record of every hex of the frame."""
    rows = enriched(spark, sf_dir)
    return sinks.full_records(rows).select("col", "row", F.to_json("record").alias("record"))


def enrichment_checks(spark, sf_dir):
    """The gates on the enriched hexes."""
    rows = enriched(spark, sf_dir).withColumns({"schema": F.lit(sinks.SCHEMA_VERSION), "id": geo.hex_id(F.col("col"), F.col("row")), "has_river": F.coalesce("has_river", F.lit(False)), "river_name": F.coalesce("river_name", F.lit("")), "bridge": F.coalesce("bridge", F.lit(False))})
    expect = {"schema": sinks.SCHEMA_VERSION, "hex_count": (1000, 1500), "countries": {"C00": (10, 80)}, "water_min": 1, "biome_bands": {"forest": ("pct", 0, 60)}, "river_hexes": (1, 1500), "cities_min": 1, "sprawl": {}, "resources": {"coal": 0}, "provinces_min": 10, "covered_countries": ["C00", "C01"], "partial_countries": []}
    return quality.checks(rows, quality.record_gates(expect)).union(quality.group_gates(rows, expect)).select("name", "ok", F.round("detail", 4).alias("detail"))


QUERIES = [hex_enrichment, enrichment_checks]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    """None: tests hold the enrichment against its parts, which have SQL."""
    return {}

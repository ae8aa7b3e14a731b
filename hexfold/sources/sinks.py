"""Records, features and tiles as outputs."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from hexfold.functions import classify, geo


def require_complete(grid: DataFrame, hexes: DataFrame) -> None:
    """Fail when a hex of the grid has no row."""
    missing = grid.select("q", "r").join(hexes.select("q", "r"), ["q", "r"], "left_anti").limit(1).collect()
    if missing:
        raise ValueError(f"a hex of the grid has no data: {tuple(missing[0])}")


def hex_records(hexes: DataFrame, blocks: dict[str, list[str]]) -> DataFrame:
    """q, r, record: JSON of hex_id and a nested block for each entry of ``blocks``; null values stay out."""
    nested = [F.struct(*columns).alias(name) for name, columns in blocks.items()]
    return hexes.select("q", "r", F.to_json(F.struct(geo.hex_id(F.col("q"), F.col("r")).alias("hex_id"), *nested)).alias("record"))


def geojson_features(hexes: DataFrame, properties: list[str], size: float, meridian: float, places: int = 6) -> DataFrame:
    """q, r, feature: a polygon of seven lon/lat corners, the first again at the end, and flat properties."""
    cx, cy = geo.centre(F.col("q"), F.col("r"), size)

    def corner(p: Column) -> Column:
        lon, lat = geo.from_utm(p["x"], p["y"], meridian)
        return F.array(F.round(lon, places), F.round(lat, places))

    ring = geo.let(F.transform(F.slice(geo.vertices(cx, cy, size), 1, 6), corner), lambda a: F.concat(a, F.slice(a, 1, 1)))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    return hexes.select("q", "r", F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*properties).alias("properties"))).alias("feature"))


def map_metadata(hexes: DataFrame, biome: str = "biome") -> DataFrame:
    """One row: extents of q and r, number of hexes, and a map of hexes by biome."""
    by = hexes.groupBy(biome).agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c in "qr" for f in (F.min, F.max)])
    ends = [F.min("min_q").alias("min_q"), F.max("max_q").alias("max_q"), F.min("min_r").alias("min_r"), F.max("max_r").alias("max_r")]
    return by.agg(*ends, F.sum("n").alias("n"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(biome, "n")))).alias("biomes"))


def run_key(*inputs) -> str:
    """A key of everything a tile's result depends on: parameters, input fingerprints, version."""
    return hashlib.sha256(repr(inputs).encode()).hexdigest()[:16]


def finished_tiles(spark: SparkSession, path: str, key: str) -> DataFrame:
    """tile_lon, tile_lat that a run with this key has finished."""
    schema = "run_key string, tile_lon int, tile_lat int"
    try:
        return spark.read.schema(schema).parquet(f"{path}/finished").filter(F.col("run_key") == key).select("tile_lon", "tile_lat").distinct()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema).select("tile_lon", "tile_lat")


def write_tiles(rows: DataFrame, path: str, key: str) -> DataFrame:
    """Write the tiles (tile_lon, tile_lat) of ``rows`` that are not finished under ``key``; returns all of the run's rows.

    Finished tiles are not computed again where ``rows`` can be pruned by
    tile.  Tiles count as finished only after their rows are written, so a run
    that broke off writes its tiles anew, over what it left.
    """
    spark = rows.sparkSession
    left = rows.join(finished_tiles(spark, path, key), ["tile_lon", "tile_lat"], "left_anti").withColumn("run_key", F.lit(key))
    parts = ["run_key", "tile_lon", "tile_lat"]
    left.repartition("tile_lon", "tile_lat", F.pmod(F.xxhash64("q", "r"), F.lit(8))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(f"{path}/tiles")
    whole = spark.read.schema(left.schema).parquet(f"{path}/tiles").filter(F.col("run_key") == key)
    done = whole.select(*parts).distinct().join(finished_tiles(spark, path, key), ["tile_lon", "tile_lat"], "left_anti")
    done.select(*parts).write.mode("append").parquet(f"{path}/finished")
    return whole.drop("run_key").select(*rows.columns)


SCHEMA_VERSION = "1.0.5"  #: fixed value: of the record


def full_records(hexes: DataFrame) -> DataFrame:
    """col, row and the whole nested record (a struct) of every hex; derived tiers, flags and costs, numbers rounded half to even.

    ``hexes``: col, row, lat, lon, elev, slope, biome, vegetation, moisture,
    coastal, river_edges, has_river, river_name, country, province, kind, name,
    population_class, anthrome, parent_city, km, tier, road, rail, bridge, port,
    airfield, fortification, oil, coal, steel, iron, landuse.  Missing values
    take the defaults of the record; only km stays null.
    """
    c, text = F.col, lambda name, default="": F.coalesce(F.col(name), F.lit(default)).alias(name)
    flag = lambda name: F.coalesce(F.col(name), F.lit(False)).alias(name)
    biome = classify.resolve_biome(c("biome"))
    rows = hexes.withColumns({"biome": biome, "kind": F.coalesce("kind", F.lit("none")), "elev": F.coalesce("elev", F.lit(0.0)), "slope": F.coalesce("slope", F.lit(0.0))})
    wet, coastal = classify.is_water(c("biome")), F.coalesce("coastal", F.lit(False))
    return rows.select(
        "col",
        "row",
        F.struct(
            geo.hex_id(c("col"), c("row")).alias("id"),
            F.struct("col", "row").alias("coords"),
            F.struct(F.bround("lat", 6).alias("center_lat"), F.bround("lon", 6).alias("center_lon"), F.bround("elev", 1).alias("elevation_m"), F.bround("slope", 2).alias("slope_deg")).alias("geo"),
            F.struct(
                "biome", classify.elevation_tier(c("elev"), c("slope")).alias("elevation_tier"), text("vegetation", "sparse"), text("moisture", "temperate"),
                coastal.alias("is_coastal"), F.coalesce("river_edges", F.array().cast("array<int>")).alias("river_edges"),
            ).alias("terrain"),
            F.struct(flag("has_river"), text("river_name")).alias("rivers"),
            F.struct(text("country").alias("country_at_start"), text("province").alias("province_at_start")).alias("political"),
            F.struct(
                c("kind").alias("type"), text("name"), F.coalesce("population_class", classify.population_class(c("kind"))).alias("population_class"), text("anthrome", "none"), text("parent_city"),
                F.bround("km", 1).alias("distance_from_centroid_km"), F.coalesce("tier", classify.admin_tier_default(wet, c("country"), c("kind"))).alias("admin_tier"),
            ).alias("settlement"),
            F.struct(text("road", "none"), text("rail", "none"), flag("bridge"), flag("port"), flag("airfield"), text("fortification", "none")).alias("infrastructure"),
            F.struct(*map(flag, ("oil", "coal", "steel", "iron")), F.coalesce(c("landuse") == "farmland", F.lit(False)).alias("agriculture"), F.coalesce((c("landuse") == "industrial").cast("int"), F.lit(0)).alias("industry_level")).alias("resources"),
            F.struct(F.coalesce(classify.base_cost(c("biome")), F.lit(1)).alias("base_cost"), F.coalesce(classify.base_defense(c("biome")), F.lit(0)).alias("base_defense")).alias("movement"),
            F.struct(wet.alias("is_water"), classify.is_impassable(c("biome")).alias("is_impassable"), coastal.alias("is_coastal")).alias("flags"),
        ).alias("record"),
    )


def write_records(grid: DataFrame, hexes: DataFrame, path: str) -> None:
    """Write the records as JSON lines, sorted by (col, row) over all files; fails where a hex of the grid has none."""
    require_complete(grid, hexes)
    full_records(hexes).orderBy("col", "row").select("record.*").write.mode("overwrite").option("ignoreNullFields", "false").json(path)

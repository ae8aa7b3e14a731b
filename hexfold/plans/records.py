"""Queries over records of hexes derived from the given tables: whole records, rollups and gates, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexfold.functions import classify
from hexfold.operators import quality, spatial, tables
from hexfold.sources import boundaries, layers, sinks

RECORDS_SQL = """SELECT c_custkey AS k, CAST((c_custkey - 1) % 40 + 1 AS INT) AS col, CAST(floor((c_custkey - 1) / 40e0) AS INT) + 1 AS row,
 CASE WHEN c_custkey % 499 = 0 THEN '1.0.4' ELSE '1.0.5' END AS schema,
 concat(CAST(CAST((c_custkey - 1) % 40 + 1 AS INT) AS STRING), '_', CAST(CAST(floor((c_custkey - 1) / 40e0) AS INT) + CASE WHEN c_custkey % 211 = 0 THEN 2 ELSE 1 END AS STRING)) AS id,
 50.5e0 + ((c_custkey * 10427) % 5000) / 1e4 AS lat, 4.0e0 + ((c_custkey * 7919) % 10000) / 1e4 AS lon,
 CAST((c_custkey * 37) % 5200 - 150 AS DOUBLE) AS elev, CAST((c_custkey * 13) % 610 AS DOUBLE) / 10e0 AS slope,
 CASE c_custkey % 12 WHEN 0 THEN 'water' WHEN 1 THEN 'coastal_water' WHEN 2 THEN 'lake' WHEN 3 THEN 'glacier' WHEN 4 THEN 'forest' WHEN 5 THEN 'plains'
  WHEN 6 THEN 'steppe' WHEN 7 THEN 'hill' WHEN 8 THEN 'mountain' WHEN 9 THEN 'urban' WHEN 10 THEN 'marsh' ELSE 'beach' END AS biome,
 CASE c_custkey % 9 WHEN 0 THEN 'farmland' WHEN 1 THEN 'industrial' WHEN 2 THEN 'residential' WHEN 3 THEN 'forest' END AS landuse,
 c_custkey % 6 = 0 AS coastal, c_custkey % 5 = 0 AS has_river, CASE WHEN c_custkey % 5 = 0 AND c_custkey % 95 <> 0 THEN concat('R', CAST(c_custkey % 17 AS STRING)) ELSE '' END AS river_name,
 CAST(c_custkey % 7 AS INT) AS edge,
 CASE WHEN c_custkey % 11 = 0 THEN '' ELSE concat('C', CAST(c_custkey % 7 AS STRING)) END AS country,
 CASE WHEN c_custkey % 13 = 0 THEN '' ELSE concat('C', CAST(CASE WHEN c_custkey % 101 = 0 THEN 0 ELSE c_custkey % 7 END AS STRING), '_', CAST(c_custkey % 3 AS STRING)) END AS province,
 CASE WHEN c_custkey % 97 = 1 THEN 'metropolis' WHEN c_custkey % 23 = 0 THEN 'city' WHEN c_custkey % 8 = 4 THEN 'town' WHEN c_custkey % 8 = 1 THEN 'suburb' ELSE 'none' END AS kind,
 CASE WHEN c_custkey % 97 = 1 OR c_custkey % 23 = 0 OR c_custkey % 4 = 0 THEN c_name ELSE '' END AS name,
 CASE WHEN c_custkey % 8 = 1 AND c_custkey % 200 <> 1 THEN concat('City', CAST(c_custkey % 10 AS STRING)) ELSE '' END AS parent_city,
 CASE WHEN c_custkey % 8 = 1 THEN CAST(c_custkey % 120 AS DOUBLE) / 10e0 END AS km,
 CASE c_custkey % 5 WHEN 0 THEN 'metro' WHEN 1 THEN 'industrial' WHEN 2 THEN 'residential' WHEN 3 THEN 'outskirts' ELSE 'none' END AS anthrome,
 CASE WHEN c_custkey % 150 = 7 THEN 'capital' WHEN c_custkey % 50 = 3 THEN 'sub_capital' WHEN c_custkey % 4 = 0 THEN 'urban' WHEN c_custkey % 4 = 1 THEN 'rural' WHEN c_custkey % 4 = 2 THEN 'none' END AS tier,
 CASE c_custkey % 3 WHEN 0 THEN 'highway' WHEN 1 THEN 'paved' ELSE 'none' END AS road, CASE c_custkey % 4 WHEN 0 THEN 'double' WHEN 1 THEN 'standard' ELSE 'none' END AS rail,
 c_custkey % 10 = 0 AS bridge, false AS port, c_custkey % 701 = 0 AS airfield, CASE WHEN c_custkey % 503 = 0 THEN 'light' ELSE 'none' END AS fortification,
 c_custkey % 61 = 0 AS oil, c_custkey % 29 = 0 AS coal, c_custkey % 31 = 0 AS steel, c_custkey % 37 = 0 AS iron FROM customer"""

EXPECT = {
    "schema": "1.0.5", "hex_count": (1000, 2000), "countries": {"C1": (100, 300), "C2": (1, 50)}, "water_min": 200, "biome_bands": {"forest": ("pct", 5, 20), "urban": ("count", 1, 20)},
    "river_hexes": (100, 400), "cities_min": 50, "sprawl": {"city1": 20, "city2": 10}, "resources": {"coal": 20, "steel": 20, "iron": 20, "oil": 100},
    "provinces_min": 15, "covered_countries": ["C0", "C1", "C2", "C3"], "partial_countries": ["C3"],
}


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = layers.layer(spark, sf_dir, RECORDS_SQL)
    return r.withColumns({"river_edges": F.when(F.col("has_river"), F.array("edge")).otherwise(F.array().cast("array<int>")), "population_class": F.lit(None).cast("int"), "vegetation": F.lit(None).cast("string"), "moisture": F.lit(None).cast("string")})


def full_records(spark, sf_dir):
    """Every record, written as its JSON and read back: ids, rounded numbers, derived tiers, flags and costs."""
    made = sinks.full_records(records(spark, sf_dir))
    read = made.select(F.from_json(F.to_json("record"), made.schema["record"].dataType).alias("r"))
    return read.select(
        F.col("r.id").alias("id"), F.col("r.coords.col").alias("col"), F.col("r.coords.row").alias("row"), "r.geo.center_lat", "r.geo.center_lon", "r.geo.elevation_m", "r.geo.slope_deg", "r.terrain.biome", "r.terrain.elevation_tier",
        "r.terrain.vegetation", F.size("r.terrain.river_edges").cast("int").alias("edges"), "r.rivers.river_name", "r.political.country_at_start", "r.settlement.type", "r.settlement.population_class", "r.settlement.parent_city",
        "r.settlement.distance_from_centroid_km", "r.settlement.admin_tier", "r.infrastructure.road", "r.resources.agriculture", "r.resources.industry_level", "r.movement.base_cost", "r.movement.base_defense", "r.flags.is_water", "r.flags.is_impassable",
    )


def admin_defaults(spark, sf_dir):
    """Hexes by the tier that they have where no provinces are known."""
    r = records(spark, sf_dir)
    tier = classify.admin_tier_default(classify.is_water(F.col("biome")), F.col("country"), F.col("kind"))
    return r.groupBy(tier.alias("tier"), "kind").agg(F.count(F.lit(1)).alias("n"))


def footprint_mix(spark, sf_dir):
    """Hexes of each city's footprint, by anthrome, those in a box, and whether it has several."""
    r = records(spark, sf_dir).filter("parent_city <> ''")
    box = F.col("lon").between(4.2, 4.8) & F.col("lat").between(50.6, 50.9)
    return r.groupBy("parent_city").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("anthrome") == a).alias(a) for a in quality.FOOTPRINT], F.count_if(box).alias("in_box"), (F.count(F.lit(1)) > 1).alias("several"))


def settlement_listing(spark, sf_dir):
    """The report of the first eight settlements of each kind by name."""
    from pyspark.sql import Window

    r = records(spark, sf_dir).filter("kind <> 'none' and name <> ''")
    place = F.row_number().over(Window.partitionBy("kind").orderBy("name", "k"))
    return r.select("kind", place.alias("place"), "name", "k").filter("place <= 8")


def record_shares(spark, sf_dir):
    """Biomes in per cent of land, and shares of river hexes, settled hexes and the largest biome."""
    r = records(spark, sf_dir)
    land, n = F.count_if(~classify.is_water(F.col("biome"))), F.count(F.lit(1))
    by = r.groupBy("biome").agg(n.alias("n"), F.count_if(F.col("has_river")).alias("rivers"), F.count_if(F.col("kind") != "none").alias("settled"), land.alias("land"))
    whole = by.agg(F.sum("n").alias("_n"), F.sum("land").alias("_land"), F.sum("rivers").alias("_r"), F.sum("settled").alias("_s"), F.max("n").alias("_top"), F.collect_list(F.struct("biome", "n")).alias("b"))
    share = lambda a, b: F.round(F.col(a) / F.col(b), 6)
    return whole.select("*", F.inline("b")).select("biome", F.round(100 * F.col("n") / F.col("_land"), 4).alias("pct_of_land"), share("_r", "_n").alias("river_share"), share("_s", "_n").alias("settled_share"), share("_top", "_n").alias("top_share"))


def resource_counts(spark, sf_dir):
    r = records(spark, sf_dir)
    return r.agg(*[F.count_if(F.col(x)).alias(x) for x in ("coal", "steel", "iron", "oil")])


def record_checks(spark, sf_dir):
    """All gates on the records: bands, ids, rivers, footprints, provinces, order and spots."""
    r = records(spark, sf_dir)
    per = r.agg(F.max("row")).scalar()
    placed = r.withColumn("position", (F.col("col") - 1) * per + F.col("row"))
    spots = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey").cast("long").alias("pid"), F.concat(F.lit("spot "), "n_name").alias("name"), (4.0 + (F.col("n_nationkey") % 5) * 0.2 + 0.1).alias("x"), (50.5 + F.floor(F.col("n_nationkey") / 5) * 0.1 + 0.05).alias("y"))
    near = spatial.nearest(spots, r.select(F.col("k").alias("tid"), F.col("lon").alias("x"), F.col("lat").alias("y")), 3).join(r.select(F.col("k").alias("tid"), "kind", "coal"), "tid")
    gates = quality.checks(r, quality.record_gates(EXPECT)).union(quality.group_gates(r, EXPECT)).union(quality.order_gate(placed, "position"))
    gates = gates.union(quality.spot_gates(spots, near, F.col("kind") != "none", 15.0))
    return gates.select("name", "ok", F.round("detail", 4).alias("detail"))


def region_remap(spark, sf_dir):
    """Customers as modern units by nation and name, put into the regions of a mapping; some names are split by a line."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    country = F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))
    whole = n.select(country.alias("country"), F.lit("a").alias("name"), F.concat(country, F.lit("_A")).alias("province"), F.lit(None).cast("string").alias("axis"), F.lit(None).cast("double").alias("cut"), F.lit(False).alias("upper"))
    split = lambda name, axis, cut, ids: [n.select(country.alias("country"), F.lit(name).alias("name"), F.concat(country, F.lit(i)).alias("province"), F.lit(axis).alias("axis"), F.lit(cut).alias("cut"), F.lit(upper).alias("upper")) for i, upper in ids]
    names = whole
    for more in [*split("b", "lon", 4.5, [("_A", False), ("_B", True)]), *split("c", "lat", 50.75, [("_C", False), ("_B", True)])]:
        names = names.union(more)
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    k = F.col("c_custkey")
    units = c.select(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country"), F.element_at(F.array(*map(F.lit, "abcd")), (k % 4 + 1).cast("int")).alias("name"), (4.0 + ((k * 7919) % 10000) / 1e4).alias("lon"), (50.5 + ((k * 10427) % 5000) / 1e4).alias("lat"))
    return boundaries.remapped(units, names).groupBy("province").agg(F.count(F.lit(1)).alias("n"))


def record_differences(spark, sf_dir):
    """Leaves of whole records in which a changed copy differs: names, roads, a river's edges, and towns that it does not have."""
    r = records(spark, sf_dir)
    name, road = F.when(F.col("k") % 9 == 4, F.upper("name")).otherwise(F.col("name")), F.when(F.col("road") == "paved", "dirt").otherwise(F.col("road"))
    edges = F.when(F.col("k") % 6 == 1, F.concat("river_edges", F.array(F.lit(5)))).otherwise(F.col("river_edges"))
    other = r.filter("kind <> 'town'").withColumns({"name": name, "road": road, "river_edges": edges})
    return tables.diff_leaves(sinks.full_records(r), sinks.full_records(other), ["col", "row"])


def spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return n.select(F.col("n_nationkey").cast("long").alias("pid"), F.col("n_name").alias("name"), (4.0 + (F.col("n_nationkey") % 5) * 0.2 + 0.1).alias("x"), (50.5 + F.floor(F.col("n_nationkey") / 5) * 0.1 + 0.05).alias("y"))


def map_checks(spark, sf_dir):
    """Gates on chains of rivers, on the slope of land, and on the provinces of each country against those that were authored."""
    r, at = records(spark, sf_dir), spots(spark, sf_dir)
    near = spatial.nearest(at, r.select(F.col("k").alias("tid"), F.col("lon").alias("x"), F.col("lat").alias("y")), 1).join(r.select(F.col("k").alias("tid"), "col", "row"), "tid")
    authored = spark.range(9).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("country"), F.explode(F.array(*map(F.lit, "012"))).alias("p")).select("country", F.concat_ws("_", "country", "p").alias("province"))
    gates = quality.chain_gates(r, at, near).union(quality.slope_gate(r, 30, 60)).union(quality.total_gates(r.filter("country = substr(province, 1, 2) or province = ''"), authored))
    return gates.select("name", "ok", F.round("detail", 4).alias("detail"))


QUERIES = [map_checks, record_differences, full_records, admin_defaults, footprint_mix, settlement_listing, record_shares, resource_counts, record_checks, region_remap]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def _checks_sql() -> str:
    wet, land = "biome IN ('water', 'coastal_water', 'lake')", "biome NOT IN ('water', 'coastal_water', 'lake')"
    n = lambda cond: f"count(*) FILTER ({cond})"
    zero = lambda name, cond: (name, n(cond), "v = 0")
    e, b = EXPECT, lambda low, high: f"v BETWEEN {low} AND {high}"
    landn = f"greatest({n(land)}, 1)"
    gates = [
        zero("schema version", f"schema <> '{e['schema']}'"), zero("ids", "id <> concat(col, '_', row)"), ("hex count", "count(*)", b(*e["hex_count"])), ("water minimum", n(wet), f"v >= {e['water_min']}"),
        ("land without country", f"{n(f"{land} AND country = ''")} / {landn}", "v <= 0.01"), zero("land elevation", f"{land} AND NOT elev BETWEEN -120 AND 4900"), zero("no void shipped", "elev <= -32767"), zero("slope", "NOT slope BETWEEN 0 AND 60"),
        zero("inert fields", "port OR airfield OR fortification <> 'none'"), ("river hexes", n("has_river"), b(*e["river_hexes"])), zero("river names", "has_river <> (river_name <> '')"), zero("river edges", "has_river AND edge > 5"),
        ("settled share", f"{n("kind <> 'none'")} / count(*)", "v <= 0.4"), ("cities", n("kind IN ('city', 'metropolis')"), f"v >= {e['cities_min']}"), ("bridges", f"{n('bridge')} / greatest({n('has_river')}, 1)", "v >= 0.5"),
        zero("footprint anthromes", "parent_city <> '' AND anthrome = 'none'"), zero("suburbs have a parent", "kind = 'suburb' AND parent_city = ''"), zero("province country", "province <> '' AND country <> '' AND substr(province, 1, 2) <> country"),
        zero("province without country", "province <> '' AND country = ''"), zero("settled tiers", "province <> '' AND kind <> 'none' AND coalesce(tier NOT IN ('capital', 'sub_capital', 'urban'), false)"), zero("rural names", "tier = 'rural' AND name <> ''"),
        *[(f"country {c}", n(f"country = '{c}'"), b(*x)) for c, x in e["countries"].items()],
        *[(f"biome {x}", f"100 * {n(f"biome = '{x}'")} / {landn}" if kind == "pct" else n(f"biome = '{x}'"), b(lo, hi)) for x, (kind, lo, hi) in e["biome_bands"].items()],
        *[(f"footprint {p}", n(f"contains(lower(parent_city), '{p}')"), f"v >= {x}") for p, x in e["sprawl"].items()], *[(f"resource {k}", n(k), f"v >= {x}") for k, x in e["resources"].items()],
    ]
    union = " UNION ALL ".join(f"SELECT '{name}' AS name, CAST({value} AS DOUBLE) AS v, '{ok}' AS t FROM r" for name, value, ok in gates)
    rule = " ".join(f"WHEN name = '{name}' THEN {ok}" for name, _, ok in gates)
    groups = f"""SELECT 'duplicates' AS name, CAST(count(*) FILTER (n > 1) AS DOUBLE) AS v FROM (SELECT count(*) AS n FROM r GROUP BY col, row) UNION ALL SELECT 'largest biome share', max(n) / sum(n) FROM (SELECT count(*) AS n FROM r GROUP BY biome)
 UNION ALL SELECT 'provinces', count(DISTINCT province) FROM r WHERE province <> '' UNION ALL SELECT 'several capitals', count(*) FROM (SELECT province FROM r WHERE province <> '' AND tier = 'capital' GROUP BY province HAVING count(*) > 1)
 UNION ALL SELECT 'province coverage', 1 - count(*) FILTER (province = '') / count(*) FROM r WHERE {land} AND country IN ('C0', 'C1', 'C2')
 UNION ALL SELECT 'major rivers', count(*) FROM (SELECT river_name FROM r WHERE river_name <> '' GROUP BY river_name HAVING count(*) >= 10) UNION ALL SELECT 'generic river names', 0 UNION ALL SELECT 'order', 0"""
    spots = """sp AS (SELECT n_nationkey AS pid, concat('spot ', n_name) AS name, 4.0e0 + (n_nationkey % 5) * 0.2e0 + 0.1e0 AS x, 50.5e0 + floor(n_nationkey / 5) * 0.1e0 + 0.05e0 AS y FROM nation),
 sd AS (SELECT pid, sp.name, kind, sqrt((lat - y) ^ 2 + ((lon - x) * cos(radians(y))) ^ 2) AS d, k FROM sp, r QUALIFY row_number() OVER (PARTITION BY pid ORDER BY d, k) <= 3)"""
    return f"""WITH r AS ({RECORDS_SQL}), g AS ({union}), h AS ({groups}), {spots}
 SELECT name, coalesce(CASE {rule} END, false) AS ok, round(v, 4) AS detail FROM g
 UNION ALL SELECT name, CASE name WHEN 'largest biome share' THEN v <= 0.6 WHEN 'provinces' THEN v >= {e['provinces_min']} WHEN 'province coverage' THEN v >= 0.98 WHEN 'major rivers' THEN v >= 2 ELSE v = 0 END, round(v, 4) FROM h
 UNION ALL SELECT any_value(name), bool_or(kind <> 'none') OR min(d) * 111.32 > 15, round(min(d), 4) FROM sd GROUP BY pid"""


def _map_checks_sql() -> str:
    steps = " UNION ALL ".join(f"SELECT {p} AS p, {a} AS dc, {b} AS dr" for p, t in ((0, ((1, 0), (0, 1), (-1, 0), (-1, -1), (0, -1), (1, -1))), (1, ((1, 1), (0, 1), (-1, 1), (-1, 0), (0, -1), (1, 0)))) for a, b in t)
    return f"""WITH RECURSIVE r AS ({RECORDS_SQL}), s AS ({steps}), v AS (SELECT col, row FROM r WHERE has_river), e AS (SELECT v.col, v.row, v.col + dc AS nc, v.row + dr AS nr FROM v JOIN s ON v.col % 2 = p),
 f AS (SELECT e.* FROM e SEMI JOIN v ON v.col = nc AND v.row = nr), z AS (SELECT col, row, col AS rc, row AS rr FROM v UNION SELECT f.nc, f.nr, z.rc, z.rr FROM z JOIN f ON f.col = z.col AND f.row = z.row WHERE (z.rc, z.rr) < (f.nc, f.nr)),
 m AS (SELECT col, row, min((rc, rr)) AS x FROM z GROUP BY col, row), n AS (SELECT *, count(*) OVER (PARTITION BY x) AS n FROM m),
 i AS (SELECT n.col, n.row, (SELECT count(*) FROM e JOIN r ON r.col = nc AND r.row = nr WHERE e.col = n.col AND e.row = n.row) = 6 AS inner_ FROM n WHERE n = 1),
 p AS (SELECT n_name, 4.0e0 + (n_nationkey % 5) * 0.2e0 + 0.1e0 AS x, 50.5e0 + floor(n_nationkey / 5) * 0.1e0 + 0.05e0 AS y FROM nation),
 q AS (SELECT n_name, col, row FROM p, r QUALIFY row_number() OVER (PARTITION BY n_name ORDER BY sqrt((lat - y) ^ 2 + ((lon - x) * cos(radians(y))) ^ 2), k) = 1),
 t AS (SELECT * FROM r WHERE country = substr(province, 1, 2) OR province = ''), a AS (SELECT country, count(DISTINCT province) FILTER (province <> '') AS n FROM t WHERE country <> '' GROUP BY country)
 SELECT 'interior isolated rivers' AS name, count(*) FILTER (inner_) = 0 AS ok, CAST(count(*) FILTER (inner_) AS DOUBLE) AS detail FROM i
 UNION ALL SELECT 'isolated river share', (SELECT count(*) FROM i) / count(*) <= 0.03, round((SELECT count(*) FROM i) / count(*), 4) FROM v
 UNION ALL SELECT concat('river chain at ', n_name), coalesce(n, 0) >= 3, CAST(coalesce(n, 0) AS DOUBLE) FROM q LEFT JOIN n USING (col, row)
 UNION ALL SELECT 'land slope p90', d BETWEEN 30 AND 60, round(d, 4) FROM (SELECT list_sort(list(slope))[CAST(floor(0.9 * (count(*) - 1)) AS BIGINT) + 1] AS d FROM r WHERE biome NOT IN ('water', 'coastal_water', 'lake'))
 UNION ALL SELECT concat('provinces of ', country), n = 3, CAST(n AS DOUBLE) FROM a"""


def oracle_sql() -> dict[str, str]:
    wet = "biome IN ('water', 'coastal_water', 'lake')"
    tier = f"CASE WHEN {wet} OR country = '' THEN 'none' WHEN kind <> 'none' THEN 'urban' ELSE 'rural' END"
    return {
        "full_records": f"""WITH r AS ({RECORDS_SQL}) SELECT concat(col, '_', row) AS id, col, row, round(lat, 6) AS center_lat, round(lon, 6) AS center_lon, round(elev, 1) AS elevation_m, round(slope, 2) AS slope_deg, biome,
 CASE WHEN slope < 3 THEN CASE WHEN elev > 1500 THEN 'highland_plateau' ELSE 'flat' END WHEN slope < 10 THEN 'hilly' WHEN slope < 20 THEN 'mountainous' ELSE 'rugged' END AS elevation_tier, 'sparse' AS vegetation,
 CAST(has_river AS INT) AS edges, river_name, country AS country_at_start, kind AS type, CAST(CASE kind WHEN 'metropolis' THEN 5 WHEN 'city' THEN 3 WHEN 'town' THEN 2 ELSE 0 END AS INT) AS population_class, parent_city,
 km AS distance_from_centroid_km, coalesce(tier, {tier}) AS admin_tier, road, coalesce(landuse = 'farmland', false) AS agriculture, CAST(coalesce(landuse = 'industrial', false) AS INT) AS industry_level,
 CAST(CASE WHEN {wet} OR biome = 'glacier' THEN 99 WHEN biome IN ('mountain', 'marsh') THEN 3 WHEN biome IN ('forest', 'hill') THEN 2 ELSE 1 END AS INT) AS base_cost,
 CAST(CASE WHEN biome IN ('mountain', 'urban') THEN 2 WHEN biome IN ('forest', 'hill') THEN 1 ELSE 0 END AS INT) AS base_defense, {wet} AS is_water, {wet} OR biome = 'glacier' AS is_impassable FROM r""",
        "map_checks": _map_checks_sql(),
        "record_differences": f"""WITH r AS ({RECORDS_SQL}), o AS (SELECT * FROM r WHERE kind <> 'town'), d AS (SELECT 'record.settlement.name' AS path, col, row, name AS a, upper(name) AS b FROM o WHERE k % 9 = 4 AND name <> ''
 UNION ALL SELECT 'record.infrastructure.road', col, row, 'paved', 'dirt' FROM o WHERE road = 'paved' UNION ALL SELECT 'record.terrain.river_edges[1]', col, row, NULL, '5' FROM o WHERE k % 6 = 1 AND has_river
 UNION ALL SELECT 'record.terrain.river_edges[0]', col, row, NULL, '5' FROM o WHERE k % 6 = 1 AND NOT has_river UNION ALL SELECT 'record.terrain.river_edges', col, row, '[]', NULL FROM o WHERE k % 6 = 1 AND NOT has_river
 UNION ALL SELECT 'only a', col, row, NULL, NULL FROM r WHERE kind = 'town')
 SELECT path, count(*) OVER (PARTITION BY path) AS n, col, row, a, b FROM d QUALIFY row_number() OVER (PARTITION BY path ORDER BY col, row) = 1""",
        "admin_defaults": f"WITH r AS ({RECORDS_SQL}) SELECT {tier} AS tier, kind, count(*) AS n FROM r GROUP BY 1, 2",
        "footprint_mix": f"""WITH r AS ({RECORDS_SQL}) SELECT parent_city, count(*) AS n, {', '.join(f"count(*) FILTER (anthrome = '{a}') AS {a}" for a in quality.FOOTPRINT)},
 count(*) FILTER (lon BETWEEN 4.2 AND 4.8 AND lat BETWEEN 50.6 AND 50.9) AS in_box, count(*) > 1 AS several FROM r WHERE parent_city <> '' GROUP BY parent_city""",
        "settlement_listing": f"WITH r AS ({RECORDS_SQL}), p AS (SELECT kind, CAST(row_number() OVER (PARTITION BY kind ORDER BY name, k) AS INT) AS place, name, k FROM r WHERE kind <> 'none' AND name <> '') SELECT * FROM p WHERE place <= 8",
        "record_shares": f"""WITH r AS ({RECORDS_SQL}), b AS (SELECT biome, count(*) AS n FROM r GROUP BY biome), w AS (SELECT count(*) AS n, count(*) FILTER (NOT {wet}) AS land, count(*) FILTER (has_river) AS rv, count(*) FILTER (kind <> 'none') AS st FROM r)
 SELECT biome, round(100 * b.n / land, 4) AS pct_of_land, round(rv / w.n, 6) AS river_share, round(st / w.n, 6) AS settled_share, round((SELECT max(n) FROM b) / w.n, 6) AS top_share FROM b, w""",
        "resource_counts": f"WITH r AS ({RECORDS_SQL}) SELECT {', '.join(f'count(*) FILTER ({x}) AS {x}' for x in ('coal', 'steel', 'iron', 'oil'))} FROM r",
        "record_checks": _checks_sql(),
        "region_remap": """WITH u AS (SELECT concat('N', c_nationkey) AS c, c_custkey % 4 AS m, 4.0e0 + ((c_custkey * 7919) % 10000) / 1e4 AS lon, 50.5e0 + ((c_custkey * 10427) % 5000) / 1e4 AS lat FROM customer)
 SELECT concat(c, CASE WHEN m = 0 OR (m = 1 AND lon <= 4.5) THEN '_A' WHEN m = 2 AND lat <= 50.75 THEN '_C' ELSE '_B' END) AS province, count(*) AS n FROM u WHERE m < 3 GROUP BY 1""",
    }

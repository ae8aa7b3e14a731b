"""Queries that compute by tile what the whole map gives, and the whole map's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexfold.functions import classify, geo
from hexfold.operators import tables, tiles
from hexfold.operators import hexes as plain
from hexfold.operators.scratch import new_folder
from hexfold.plans import queries as maps
from hexfold.plans.queries import MERIDIAN, SIZE, _hex_sql, _kind
from hexfold.sources import layers
from hexfold.streaming import ingest

SIDE = 8


def settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hexes with their largest settlement; water and land use by coordinates."""
    h = maps.in_hexes(spark, sf_dir).groupBy("q", "r").agg(F.max_by(F.struct("kind", "name", "population"), F.struct("population", -F.col("k"))).alias("s"))
    code = F.pmod(F.col("q") * 7 + F.col("r") * 3, F.lit(5))
    h = h.select("q", "r", "s.kind", "s.name", "s.population", F.when(code == 0, "residential").when(code == 1, "industrial").otherwise("farmland").alias("landuse"), (code < 3).alias("built"), (code == 3).alias("open"), (code == 4).alias("water"))
    radius = F.when(F.col("kind").isin("city", "metropolis"), classify.sprawl_radius_km(F.col("kind"), F.col("population"))).otherwise(0)
    return h.withColumns({"anthrome": F.lit("none"), "population_class": classify.population_class(F.col("kind")), "radius_km": radius})


COLUMNS = ["q", "r", "coastal", "kind", "anthrome", "population_class", "parent_city", "km", "root_q", "root_r"]


def tiled_passes(spark, sf_dir):
    """Coast, footprints and chains of land of every hex, found tile by tile."""
    h = settled(spark, sf_dir)
    chains = tiles.chains(h.filter("not water").select("q", "r"), SIDE)
    return tiles.passes_by_tile(h, SIZE, SIDE).join(chains, ["q", "r"], "left").withColumn("km", F.round("km", 1)).select(*COLUMNS)


def tiled_chains(spark, sf_dir):
    """Chains of hexes in two levels."""
    return tiles.chains(maps.occupied(spark, sf_dir), SIDE)


def passes_equal_whole(spark, sf_dir):
    """Differences between coast, footprints and chains by tile and over the whole: none."""
    h = settled(spark, sf_dir)
    chains = plain.chains(h.filter("not water").select("q", "r"))
    whole = tiles.passes(h, SIZE).join(chains, ["q", "r"], "left").withColumn("km", F.round("km", 1)).select(*COLUMNS)
    return tables.diff(whole, tiled_passes(spark, sf_dir), ["q", "r"])


def staged_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place nodes with the part that they land in; some have the id of one in another part."""
    s = layers.layer(spark, sf_dir, layers.SETTLEMENTS_SQL)
    k = F.col("k")
    tags = F.create_map(F.lit("name"), F.col("name"), F.lit("place"), F.col("place_type"), F.lit("population"), F.col("population").cast("string"))
    number = F.when(k % 10 == 9, F.floor(k / 2)).otherwise(k)
    return s.select((k % 4).alias("part"), F.to_json(F.struct(F.lit("node").alias("type"), number.alias("id"), "lon", "lat", tags.alias("tags"))).alias("value"))


def incremental_records(spark, sf_dir):
    """Settled hexes after four parts have landed one after the other, each taken in by the stream when it does."""
    staged, folder = staged_places(spark, sf_dir), new_folder(spark, "ingest")
    for part in range(4):
        staged.filter(F.col("part") == part).select("value").write.mode("append").text(f"{folder}/parts")
        ingest.ingest_settlements(spark, f"{folder}/parts", f"{folder}/layer", f"{folder}/records", f"{folder}/checkpoint", SIZE, MERIDIAN)
    return spark.read.parquet(f"{folder}/records").select("q", "r", "name", "kind", "n", "people", "crowd")


QUERIES = [tiled_passes, tiled_chains, passes_equal_whole, incremental_records]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def footprint_sql(water: str) -> str:
    """``f``: the footprints of hexes ``h`` by land use from coordinates, every seed against every hex."""
    given = maps.oracle_sql()
    beside = given["hex_neighbors"].rsplit(" ON ", 1)[1]
    start = given["hex_neighbors"].split(", o AS (SELECT DISTINCT", 1)[0].replace("WITH ", "WITH RECURSIVE ", 1)
    where = given["hex_neighbors"].split("o AS (SELECT DISTINCT q, r, ", 1)[1].split(" FROM hx)", 1)[0]
    return f"""{start}, p0 AS (SELECT q, r, arg_max(kind, (population, -k)) AS kind, arg_max(name, (population, -k)) AS name, max(population) AS population FROM hx GROUP BY q, r),
 h AS (SELECT *, {where}, (q * 7 + r * 3) % 5 AS code, {water} AS water FROM p0),
 nb AS (SELECT a.q, a.r, b.q AS nq, b.r AS nr, b.water AS wet FROM h a JOIN h b ON {beside}),
 sd AS (SELECT *, CASE WHEN kind = 'metropolis' THEN 14 WHEN population >= 150000 THEN 11 ELSE 8 END AS radius FROM h WHERE kind IN ('city', 'metropolis')),
 far AS (SELECT sd.q AS sq, sd.r AS sr, sd.radius, h.q, h.r, h.code, (h.q - sd.q) * CAST({1.5 * geo.radius(SIZE)!r} AS DOUBLE) AS dx, (h.r - sd.r + 0.5e0 * (h.q % 2 - sd.q % 2)) * CAST({SIZE} AS DOUBLE) AS dy FROM sd JOIN h ON abs(h.q - sd.q) <= 20 AND abs(h.r - sd.r) <= 20),
 able AS (SELECT sq, sr, q, r, sqrt(dx * dx + dy * dy) / 1000 AS km FROM far WHERE sqrt(dx * dx + dy * dy) / 1000 <= radius AND (code < 3 OR (code = 3 AND sqrt(dx * dx + dy * dy) / 1000 <= 11) OR (sq = q AND sr = r))),
 z AS (SELECT sq, sr, q, r FROM able WHERE sq = q AND sr = r UNION SELECT b.sq, b.sr, b.q, b.r FROM z JOIN nb ON nb.q = z.q AND nb.r = z.r JOIN able b ON b.sq = z.sq AND b.sr = z.sr AND b.q = nb.nq AND b.r = nb.nr),
 w AS (SELECT q, r, min((km, sq, sr)) AS m FROM z JOIN able USING (sq, sr, q, r) GROUP BY q, r),
 f AS (SELECT h.q, h.r, h.water, h.kind IN ('city', 'metropolis') AS major, m[1] AS d, CASE WHEN m IS NOT NULL AND NOT (m[2] = h.q AND m[3] = h.r) AND h.kind NOT IN ('city', 'metropolis') THEN 'suburb' ELSE h.kind END AS kind,
  CASE WHEN m IS NULL THEN 'none' WHEN h.code = 1 THEN 'industrial' WHEN m[1] < 3 THEN 'metro' WHEN h.code = 0 THEN 'residential' ELSE 'outskirts' END AS anthrome, coalesce(s.name, '') AS parent_city
  FROM h LEFT JOIN w USING (q, r) LEFT JOIN h s ON s.q = m[2] AND s.r = m[3]),
 g AS (SELECT q, r, water, kind, anthrome, CAST(CASE kind WHEN 'suburb' THEN CASE WHEN d < 6 THEN 3 ELSE 2 END WHEN 'village' THEN 1 WHEN 'town' THEN 2 WHEN 'city' THEN 3 WHEN 'metropolis' THEN 5 ELSE 0 END AS INT) AS population_class, parent_city, round_even(d, 1) AS km FROM f)"""


def oracle_sql() -> dict[str, str]:
    chains = """c AS (SELECT q, r, q AS root_q, r AS root_r FROM h WHERE NOT water UNION SELECT nb.nq, nb.nr, c.root_q, c.root_r FROM c JOIN nb ON c.q = nb.q AND c.r = nb.r WHERE NOT nb.wet AND (c.root_q, c.root_r) < (nb.nq, nb.nr)),
 l AS (SELECT q, r, min((root_q, root_r)) AS x FROM c GROUP BY q, r)"""
    beside = maps.oracle_sql()["hex_neighbors"].rsplit(" ON ", 1)[1]
    return {
        "incremental_records": f"""WITH s AS (SELECT *, {_kind()} AS kind, CASE WHEN k % 10 = 9 THEN k // 2 ELSE k END AS id FROM ({layers.SETTLEMENTS_SQL}) QUALIFY row_number() OVER (PARTITION BY CASE WHEN k % 10 = 9 THEN k // 2 ELSE k END ORDER BY k % 4) = 1), {_hex_sql('s')},
 h AS (SELECT q, r, arg_min(name, (-population, concat('node/', id))) AS name, arg_min(kind, (-population, concat('node/', id))) AS kind, count(*) AS n, CAST(sum(population) AS BIGINT) AS people, q * CAST({1.5 * geo.radius(SIZE)!r} AS DOUBLE) AS cx, (r + 0.5e0 * (q % 2)) * CAST({SIZE} AS DOUBLE) AS cy FROM hx GROUP BY q, r),
 c AS (SELECT a.q, a.r, sum(b.n) AS n FROM h a JOIN h b ON {beside} GROUP BY 1, 2)
 SELECT h.q, h.r, name, kind, h.n, people, CAST(h.n + coalesce(c.n, 0) AS BIGINT) AS crowd FROM h LEFT JOIN c USING (q, r)""",
        "tiled_passes": f"""{footprint_sql("(q * 7 + r * 3) % 5 = 4")}, {chains}
 SELECT g.q, g.r, NOT g.water AND EXISTS (SELECT 1 FROM nb WHERE nb.q = g.q AND nb.r = g.r AND nb.wet) AS coastal, kind, anthrome, population_class, parent_city, km, x[1] AS root_q, x[2] AS root_r FROM g LEFT JOIN l USING (q, r)""",
        "tiled_chains": maps.oracle_sql()["hex_chains"],
        "passes_equal_whole": "SELECT unnest(['only_a', 'only_b', 'coastal', 'kind', 'anthrome', 'population_class', 'parent_city', 'km', 'root_q', 'root_r']) AS field, CAST(0 AS BIGINT) AS n",
        "urban_sprawl": f"{footprint_sql('false')} SELECT q, r, kind, anthrome, population_class, parent_city, km FROM g",
    }

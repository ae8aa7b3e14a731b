import math
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from hexfold.functions import classify, geo
from hexfold.operators import hexes, lines, raster, tables
from hexfold.plans import catalog
from hexfold.sources import layers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    made = duckdb.connect()
    for f in os.listdir(SF):
        made.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return made


def plain(rows):
    return sorted((tuple(int(v) if isinstance(v, float) and v == int(v) else v for v in r) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    got = catalog.queries()[name](spark, SF)
    columns = sorted(got.columns)
    want = con.sql(catalog.oracle_sql()[name]).select(*columns).fetchall()
    assert plain(got.select(*columns).collect()) == plain(want)


@pytest.mark.parametrize("box", [(4.0, 50.5, 5.0, 51.0), (-71.2, -10.5, -70.7, -10.1)])
def test_grid(spark, box):
    size = 10_000.0
    grid = hexes.hex_grid(spark, box, size).cache()
    assert grid.agg(F.min("q"), F.min(F.pmod(F.col("q") - F.col("col"), F.lit(2)))).first()[1] == 0
    pairs = hexes.neighbors(grid).join(grid.select("q", "r", "cx", "cy"), ["q", "r"]).join(grid.select(F.col("q").alias("nq"), F.col("r").alias("nr"), F.col("cx").alias("x"), F.col("cy").alias("y")), ["nq", "nr"])
    far = pairs.select(F.hypot(F.col("cx") - F.col("x"), F.col("cy") - F.col("y")).alias("d")).agg(F.min("d"), F.max("d")).first()
    assert abs(far[0] - size) < 0.01 and abs(far[1] - size) < 0.01
    assert pairs.groupBy("q", "r").count().agg(F.max("count")).first()[0] <= 6
    own = hexes.with_hex(grid.select("lon", "lat", F.col("q").alias("gq"), F.col("r").alias("gr")), size, geo.utm_meridian((box[0] + box[2]) / 2))
    assert own.filter("q <> gq or r <> gr").count() == 0


def test_projection_round_trip(spark):
    at = spark.createDataFrame([(3.0, 0.0), (4.7, 50.85), (5.9, -33.0)], "lon double, lat double")
    there = at.select("*", geo.utm(F.col("lon"), F.col("lat"), 3.0).alias("p"))
    lon, lat = geo.from_utm(F.col("p.x"), F.col("p.y"), 3.0)
    for r in there.select("lon", "lat", lon.alias("a"), lat.alias("b")).collect():
        assert math.isclose(r.lon, r.a, abs_tol=1e-10) and math.isclose(r.lat, r.b, abs_tol=1e-10)


def test_sprawl_needs_touching_hexes(spark):
    cells = [(q, 0, q != 3, False) for q in range(-1, 8)]
    got = hexes.sprawl(spark.createDataFrame(cells, "q int, r int, built boolean, open boolean"), spark.createDataFrame([(0, 0, 14)], "q int, r int, radius_km int"), 2000.0)
    assert {r.q for r in got.collect()} <= {-1, 0, 1, 2}


def test_raster(spark):
    dem = spark.createDataFrame([(r, c, -32768 if (r, c) == (2, 2) else c * 10) for r in range(5) for c in range(5)], "px_row int, px_col int, elev int")
    dem = raster.store(raster.blocks(dem))
    slopes = {(r.px_row, r.px_col): r.slope for r in raster.pixels(raster.slope_deg(dem, 0.001, 0.001, 0.0), "slope").collect()}
    assert slopes[(0, 0)] is None and slopes[(2, 1)] is None
    assert math.isclose(slopes[(1, 1)], math.degrees(math.atan(10 / 111.32)), rel_tol=1e-4)
    points = spark.createDataFrame([(0.002, -0.002), (0.0031, -0.0009), (9.0, 9.0)], "x double, y double")
    assert [r.elev for r in sorted(raster.sample(points, dem, 0.0, 0.0, 0.001, 0.001).collect())] == [0.0, 30.0, 0.0]
    flat = spark.createDataFrame([(0, 0, 5), (0, 1, 5)], "px_row int, px_col int, elev int")
    assert [r.shade for r in raster.pixels(raster.hillshade(raster.store(raster.blocks(flat))), "shade").collect()] == [0.5, 0.5]
    assert raster.pixels(raster.slope_deg(raster.store(raster.blocks(flat.limit(0))), 0.001, 0.001, 0.0), "slope").count() == 0


def test_blocks_are_sent_their_borders_alone(spark):
    """Slopes over many blocks with voids and missing pixels, against every pixel by itself; what is shuffled and read."""
    rng, size, k, step = random.Random(9), 16, 3, 0.00027
    given = {(r, c): -32768.0 if rng.random() < 0.02 else float(rng.randrange(900)) for r in range(-20, 61) for c in range(-9, 70) if rng.random() > 0.03}
    dem = spark.createDataFrame([(*at, e) for at, e in given.items()] + [(0, 0, None)] * ((0, 0) in given), "px_row int, px_col int, elev double")
    stored = raster.store(raster.blocks(dem, size))
    slopes = raster.slope_deg(stored, step, -step, 51.0)
    got = {(r.px_row, r.px_col): r.slope for r in raster.pixels(slopes, "slope").collect()}
    at = lambda r, c: None if given.get((r, c), -32768.0) == -32768.0 else given[r, c]
    assert got.keys() == given.keys()
    for (r, c), slope in got.items():
        near = [at(r, c - k), at(r, c + k), at(r - k, c), at(r + k, c)]
        if None in near:
            assert slope is None
            continue
        w, e, n, s = near
        dx, dy = (e - w) / (2 * k * step * 111_320 * math.cos(math.radians(51.0 - (r + 0.5) * step))), (s - n) / (2 * k * step * 111_320)
        assert math.isclose(slope, math.degrees(math.atan(math.hypot(dx, dy))), rel_tol=1e-9)
    plan = slopes._jdf.queryExecution().executedPlan().toString()
    own = plan[plan.index("SortMergeJoin") :] if "SortMergeJoin" in plan else plan
    assert "Bucketed: true" in own and plan.count("Exchange hashpartitioning") == 1  # of the strips
    far = dem.filter("px_row between 0 and 9 and px_col between 0 and 9").selectExpr("px_row * 100 as px_row", "px_col * 100 as px_col", "elev")
    held, _, _ = raster.window(raster.store(raster.blocks(far, size)), (0.0, -2.5, 2.5, 0.0), 0.0, 0.0, 0.01, -0.01, size)
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tile_" in plan and "tile_row" in plan
    assert held.count() == sum(0 <= r < 3 and 0 <= c < 3 for r, c in given)


def test_names_and_dates(spark):
    rows = spark.createDataFrame([("Straße-Köln", "strasse koln"), ("Aix", "Aix la Chapelle"), ("Neu Berlin", "Berlin West"), ("Aachen", "Aach"), ("", "")], "a string, b string")
    got = [r[0] for r in rows.select(classify.match_score(classify.norm_name(F.col("a")), classify.norm_name(F.col("b")))).collect()]
    assert got == [100, 70, 50, 0, 0]
    dated = spark.createDataFrame([("1920-01-01", None), ("1920-01-01", "1930-01-01"), ("1931-01-01", None)], "start string, end string")
    assert tables.valid_at(dated, "1930-01-01").count() == 1


def test_elements(spark):
    way = lambda points: '{"type":"way","id":7,"geometry":[' + ",".join(f'{{"lon":{x},"lat":{y}}}' for x, y in points) + "]}"
    texts = [way([(0, 0), (1, 0), (1, 1), (0, 0)]), way([(0, 0), (1, 0)]), way([(0, 0)]), '{"type":"relation","id":1,"center":{"lon":1,"lat":2}}', "broken"]
    got = layers.parse_osm_elements(spark.createDataFrame([(t,) for t in texts], "element string")).collect()
    assert sorted((r.osm_id, r.kind, len(r.points)) for r in got) == [("relation/1", "point", 1), ("way/7", "line", 2), ("way/7", "polygon", 4)]


def test_zonal_p90(spark):
    slopes = spark.createDataFrame([(r, c, None if r == c else float(r * 7 + c)) for r in range(9) for c in range(9)], "px_row int, px_col int, slope double")
    boxes = spark.createDataFrame([(1, 0.15, -0.55, 0.45, -0.25), (2, 5.0, 5.0, 6.0, 6.0), (3, -9.0, -9.0, 9.0, 9.0)], "zid int, x0 double, y0 double, x1 double, y1 double")
    got = dict(map(tuple, raster.zonal_p90(boxes, raster.blocks(slopes.withColumnRenamed("slope", "elev"), 4), 0.0, 0.0, 0.1, 0.1, block=4).collect()))

    def plain(rows, columns):
        v = sorted(float(r * 7 + c) for r in rows for c in columns if r != c)
        at = 0.9 * (len(v) - 1)
        return v[int(at)] + (at - int(at)) * (v[min(int(at) + 1, len(v) - 1)] - v[int(at)])

    assert got[2] == 0.0
    assert math.isclose(got[1], plain(range(2, 7), range(1, 6)))
    assert math.isclose(got[3], plain(range(9), range(9)))


def test_resolve_biome(spark):
    raw = spark.createDataFrame([("taiga",), ("rough",), ("odd",), (None,)], "raw string")
    assert [r[0] for r in raw.select(classify.resolve_biome(F.col("raw"))).collect()] == ["taiga", "hill", "plains", "plains"]
    assert [r[0] for r in raw.filter("raw = 'taiga'").select(classify.resolve_biome(F.col("raw"), strict=True)).collect()] == ["taiga"]
    with pytest.raises(Exception, match="unknown biome: odd"):
        raw.filter("raw = 'odd'").select(classify.resolve_biome(F.col("raw"), strict=True)).collect()


def test_clip_ends_and_edges(spark):
    size = 2000.0
    segments = spark.createDataFrame([(1, 0.0, 0.0, 0.0, 4000.0), (2, 0.0, 100.0, 0.0, 100.0), (3, -100.0, 0.0, 100.0, 0.0), (4, -500.0, 1000.0, 500.0, 1000.0)], "k int, x1 double, y1 double, x2 double, y2 double")
    got = {(r.k, r.q, r.r): (round(r.metres), r.enter, r.leave) for r in lines.clip(segments, size).collect()}
    assert got == {(1, 0, 0): (1000, None, 1), (1, 0, 1): (2000, 4, 1), (1, 0, 2): (1000, 4, None), (3, 0, 0): (200, None, None)}
    assert lines.clip(segments.limit(0), size).count() == 0


def test_rivers_without_names(spark):
    rows = spark.createDataFrame([(0, 0, 1, None, 50.0, None, 1), (0, 0, 2, "", 60.0, 4, 1), (0, 0, 3, "B", 10.0, None, None), (0, 0, 4, "A", 10.0, None, None), (1, 0, 1, None, 5.0, 2, None)], "q int, r int, k int, name string, metres double, enter int, leave int")
    got = {(r.q, r.r): (r.river_name, r.river_edges) for r in lines.rivers_of_hexes(rows).collect()}
    assert got == {(0, 0): ("A", [1, 4]), (1, 0): ("", [2])}


def test_river_chains_cover_all_river_hexes(spark):
    queries = catalog.queries()
    left = {(r.q, r.r) for r in queries["river_hexes"](spark, SF).collect()}
    pairs = hexes.neighbors(spark.createDataFrame(sorted(left), "q int, r int")).collect()
    beside = {}
    for r in pairs:
        beside.setdefault((r.q, r.r), []).append((r.nq, r.nr))
    want = []
    while left:
        root = min(left)
        todo = [root]
        left.remove(root)
        while todo:
            at = todo.pop()
            want.append((*at, *root))
            todo += [n for n in beside.get(at, []) if n in left]
            left -= set(todo)
    got = [(r.q, r.r, r.root_q, r.root_r) for r in queries["river_chains"](spark, SF).collect()]
    assert want and sorted(got) == sorted(want)

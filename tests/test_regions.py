import math

import pytest
from pyspark.sql import functions as F

from hexfold.functions import classify, geo
from hexfold.operators import regions
from hexfold.plans import catalog
from hexfold.sources import sinks

SF = "/root/testdata/sf0.001"


def test_a_snap_stays_in_its_country(spark):
    # both provinces lie within the snap distance; the nearer is another country's
    square = lambda fid, country, x: [(fid, country, x, 0.0, x + 1, 0.0), (fid, country, x + 1, 0.0, x + 1, 1.0), (fid, country, x + 1, 1.0, x, 1.0), (fid, country, x, 1.0, x, 0.0)]
    outlines = spark.createDataFrame(square("A1", "A", 0.0) + square("B1", "B", 1.1), "fid string, country string, x1 double, y1 double, x2 double, y2 double")
    points = spark.createDataFrame([(1, 1.08, 0.5, "A"), (2, 1.08, 0.5, "B"), (3, 1.08, 0.5, ""), (4, 0.5, 0.5, "A"), (5, 9.0, 9.0, "A"), (6, 0.5, 0.5, None)], "pid int, x double, y double, country string")
    got = dict(map(tuple, regions.assign_province(points, outlines, 0.2).collect()))
    assert got == {1: "A1", 2: "B1", 3: "", 4: "A1", 5: "", 6: ""}
    assert regions.assign_province(points.limit(0), outlines, 0.2).count() == 0


def test_capitals_choose_in_turn(spark):
    nodes = spark.createDataFrame(
        [("P", 0, 0, "Köln", 10), ("P", 1, 0, "Koln West", 900), ("P", 2, 0, "Aachen", None), ("Q", 5, 5, "Ulm", 7), ("Q", 6, 5, "Ulm", 7), ("R", 9, 9, "Elsewhere", 1)],
        "province string, q int, r int, name string, population long",
    )
    meta = spark.createDataFrame([("P", 0, ["KOLN"]), ("P", 1, ["Koln"]), ("P", 2, ["Trier", "aachen"]), ("Q", 0, ["Ulm"]), ("R", 0, ["Nowhere"])], "province string, rank int, names array<string>")
    capitals = regions.designate_capitals(nodes, meta)
    assert {(x.province, x.rank, x.q, x.r) for x in capitals.collect()} == {("P", 0, 0, 0), ("P", 1, 1, 0), ("P", 2, 2, 0), ("Q", 0, 6, 5)}
    assert regions.designate_capitals(nodes, meta.limit(0)).count() == 0
    hexes = spark.createDataFrame([(0, 0, "P", "rural", "none", "", "none", 60000), (1, 0, "P", "urban", "town", "Old", "metro", 1), (7, 7, "P", "rural", "none", "", "none", 1)], "q int, r int, province string, tier string, kind string, name string, anthrome string, first_population long")
    got = {(x.q, x.r): (x.tier, x.kind, x.name, x.anthrome) for x in regions.with_capitals(hexes, capitals).collect()}
    assert got == {(0, 0): ("capital", "city", "Köln", "residential"), (1, 0): ("subcapital", "town", "Old", "metro"), (7, 7): ("rural", "none", "", "none")}


def test_tiles_resume_and_keys_part_them(spark, tmp_path):
    rows = spark.createDataFrame([(q, q % 3, q, q // 4, 0) for q in range(12)], "q int, r int, v int, tile_lon int, tile_lat int")
    path = str(tmp_path / "t")
    sinks.write_tiles(rows.filter("tile_lon = 0"), path, "a")
    # a finished tile is not written again, so this run's other value for it does not show
    got = sinks.write_tiles(rows.withColumn("v", F.col("v") + 100), path, "a")
    assert sorted((x.q, x.v) for x in got.collect()) == [(q, q if q < 4 else q + 100) for q in range(12)]
    other = sinks.write_tiles(rows, path, "b")
    assert sorted((x.q, x.v) for x in other.collect()) == [(q, q) for q in range(12)]
    assert sinks.finished_tiles(spark, path, "a").count() == 3
    assert sinks.run_key(1, "x") != sinks.run_key(2, "x")


def test_tiles_equal_the_whole(spark, tmp_path):
    best = catalog.queries()["settlements_per_hex"](spark, SF)
    tiled = best.withColumns({"tile_lon": F.floor(F.col("q") / 8).cast("int"), "tile_lat": F.floor(F.col("r") / 8).cast("int")})
    got = sinks.write_tiles(tiled, str(tmp_path / "w"), "k").select(*best.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, best.collect()))


def test_an_incomplete_grid_fails(spark):
    grid = spark.createDataFrame([(0, 0), (0, 1)], "q int, r int")
    sinks.require_complete(grid, grid)
    with pytest.raises(ValueError, match="no data"):
        sinks.require_complete(grid, grid.limit(1))


def test_tiers_and_effects(spark):
    rows = spark.createDataFrame([(True, "A", "P", True), (False, "", "P", True), (False, "A", None, True), (False, "A", "P", True), (False, "A", "P", False)], "w boolean, c string, p string, s boolean")
    assert [r[0] for r in rows.select(classify.admin_tier(*map(F.col, "wcps"))).collect()] == ["none", "none", "none", "urban", "rural"]
    effects = {r.terrain: (r.cost, r.blocks_los) for r in classify.terrain_effects(spark).collect()}
    assert len(effects) == 8 and effects["water"] == (99, False) and effects["forest"] == (2, True)


def test_lambert_round_trip(spark):
    at = spark.createDataFrame([(3.0, 45.0), (4.7, 50.85), (-20.9, 60.0)], "lon double, lat double")
    cone = geo.lambert(-5.0, 52.0, 45.0, 58.0)
    there = at.select("*", cone.forward(F.col("lon"), F.col("lat")).alias("p"))
    lon, lat = cone.inverse(F.col("p.x"), F.col("p.y"))
    for r in there.select("lon", "lat", lon.alias("a"), lat.alias("b")).collect():
        # the latitude's third-order series leaves out terms that add up to 1.5e-10 radians at most
        assert abs(r.lon - r.a) < 1e-9 and abs(r.lat - r.b) < 9e-9
    # north is up on the central meridian, and distances are true along a standard parallel
    near = spark.createDataFrame([(-5.0, 45.0), (-4.99, 45.0)], "lon double, lat double").select(cone.forward(F.col("lon"), F.col("lat")).alias("p")).select("p.*").collect()
    e2 = geo.FLATTENING * (2 - geo.FLATTENING)
    parallel = math.radians(0.01) * geo.AXIS * math.cos(math.radians(45)) / math.sqrt(1 - e2 * math.sin(math.radians(45)) ** 2)
    assert abs(near[0].x) < 1e-6 and abs(math.hypot(near[1].x - near[0].x, near[1].y - near[0].y) / parallel - 1) < 1e-6


def test_projection_by_extent():
    assert geo.select_projection(4.0, 50.5, 5.0, 51.0) == ("utm", (3.0,))
    assert geo.select_projection(0.0, 44.0, 10.0, 50.0)[0] == "lcc"
    assert geo.select_projection(-30.0, 30.0, 40.0, 70.0)[0] == "aeqd"

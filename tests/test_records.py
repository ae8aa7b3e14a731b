import json
import math
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from hexfold.functions import classify, geo
from hexfold.operators import hexes, lines, quality, raster, spatial, tables
from hexfold.plans import enrichment, records
from hexfold.sources import boundaries, elements, layers, sinks

SF = "/root/testdata/sf0.001"


def place(spark, rows):
    return spark.createDataFrame(rows, "lon double, lat double")


def test_azimuthal_is_a_geodesic(spark):
    centre = ("aeqd", (0.0, 0.0))
    east, north = (r for r in geo.project(place(spark, [(10.0, 0.0), (0.0, 10.0)]), centre).collect())
    assert math.isclose(east.x, geo.AXIS * math.radians(10), abs_tol=1e-3) and abs(east.y) < 1e-6
    e2 = geo.FLATTENING * (2 - geo.FLATTENING)
    steps = [math.radians(10) * (i + 0.5) / 20_000 for i in range(20_000)]
    arc = sum(geo.AXIS * (1 - e2) / (1 - e2 * math.sin(v) ** 2) ** 1.5 for v in steps) * math.radians(10) / 20_000
    assert math.isclose(north.y, arc, abs_tol=1e-2)


@pytest.mark.parametrize("projection", [("utm", (9.0,)), ("lcc", (10.0, 48.0, 40.0, 56.0)), ("aeqd", (10.0, 48.0))])
def test_projections_invert(spark, projection):
    given = place(spark, [(10.0 + dx, 48.0 + dy) for dx in (-4.0, 0.0, 3.5) for dy in (-12.0, 0.0, 9.0)])
    back = geo.unproject(geo.project(given, projection).withColumnsRenamed({"lon": "a", "lat": "b"}), projection).filter("lat > 0")
    assert all(abs(r.lon - r.a) < 1e-8 and abs(r.lat - r.b) < 1e-7 for r in back.collect())


@pytest.mark.parametrize(("box", "size"), [((4.0, 50.5, 5.0, 51.0), 10_000.0), ((2.5, 45.0, 15.0, 53.6), 60_000.0), ((-10.0, 36.0, 30.0, 60.0), 200_000.0)])
def test_grids_of_every_projection(spark, box, size):
    grid = hexes.hex_grid(spark, box, size)
    pairs = hexes.distances(hexes.neighbors(grid).select("q", "r", "nq", "nr"), grid)
    low, high = pairs.agg(F.min("metres"), F.max("metres")).first()
    assert abs(low - size) < 0.01 and abs(high - size) < 0.01
    assert all((r.col - r.q) % 2 == 0 for r in grid.collect()) and not math.isfinite(hexes.distances(pairs.limit(1).select("q", "r", F.lit(10**6).alias("nq"), "nr"), grid).first().metres)


def test_staged_hex_is_that_of_the_expression(spark):
    points = spark.range(2000).select((F.pmod(F.col("id") * 7919, F.lit(100_000)) - 50_000.0).alias("x"), (F.pmod(F.col("id") * 10_427, F.lit(90_000)) - 45_000.0).alias("y"))
    both = geo.place_in_hex(points, 2000.0).withColumn("h", geo.point_to_hex(F.col("x"), F.col("y"), 2000.0))
    assert both.filter("q <> h.q or r <> h.r").count() == 0


def test_nearest_ends_on_missing_and_far_coordinates(spark):
    points = spark.createDataFrame([(1, 4.0, 50.0), (2, None, 50.0), (3, float("nan"), 1.0), (4, -170.0, -80.0)], "pid long, x double, y double")
    targets = spark.createDataFrame([(1, 4.1, 50.0), (2, 4.0, 50.2), (3, None, None), (4, 4.0, 50.0), (5, 4.0, 50.0)], "tid long, x double, y double")
    rows = sorted((r.pid, r["rank"], r.tid) for r in spatial.nearest(points, targets, 2).collect())
    assert rows[:2] == [(1, 1, 4), (1, 2, 5)] and [r[:2] for r in rows[2:]] == [(4, 1), (4, 2)]
    assert spatial.nearest(points, targets.limit(0), 2).count() == 0


def test_a_missing_pixel_shifts_nothing(spark):
    rows = [(r, c, float(10 * c + r)) for r in range(5) for c in range(6) if (r, c) != (2, 2)]
    dem = spark.createDataFrame(rows, "px_row int, px_col int, elev double")
    found = {(r.px_row, r.px_col): r.slope for r in raster.pixels(raster.slope_deg(raster.store(raster.blocks(dem)), 1 / 111_320, 1 / 111_320, 0.0, 1.0), "slope").collect()}
    assert len(found) == 29 and found[2, 1] is None and found[2, 3] is None and found[1, 2] is None and found[0, 3] is None
    lat = math.cos(math.radians(1.5 / 111_320))
    assert math.isclose(found[1, 3], math.degrees(math.atan(math.hypot(10 / lat, 1))), rel_tol=1e-6)


def test_window_of_a_raster(spark):
    dem = spark.range(10_000).select((F.col("id") / 100).cast("int").alias("px_row"), (F.col("id") % 100).cast("int").alias("px_col"), F.col("id").cast("double").alias("elev"))
    held, left, top = raster.window(raster.store(raster.blocks(dem, 64)), (0.205, -0.405, 0.755, -0.1), 0.0, 0.0, 0.01, -0.01, 64)
    assert held.count() == 56 * 31 and (round(left, 6), round(top, 6)) == (0.2, -0.1) and held.filter("px_row = 0 and px_col = 0").first().elev == 1020


def test_terrain_effects_and_tags(spark):
    rows = {r.terrain: (r.cost, r.defense, r.blocks_los) for r in classify.terrain_effects(spark).collect()}
    assert rows["rough"] == (2, 1, False) and rows["mountain"] == (3, 2, True) and rows["urban"] == (1, 2, True) and len(rows) == 8
    tags = spark.createDataFrame([({"natural": "wood", "landuse": "farmland"},), ({"landuse": "meadow"},), ({"natural": "cliff", "landuse": "retail"},), ({},), (None,)], "tags map<string, string>")
    assert [r[0] for r in tags.select(classify.landuse_tag(F.col("tags"))).collect()] == ["forest", "grass", "residential", None, None]
    names = spark.createDataFrame([("Łódź-Straße",), ("Ȧbc’d",), ("éa",), ("ΆΒ",)], "n string")
    assert [r[0] for r in names.select(classify.norm_name(F.col("n"))).collect()] == ["łodz strasse", "abc d", "ea", "αβ"]
    given = ["ﬁord", "Ĳmuiden", "Ｗｉｄｅ－Ｔｏｗｎ", "Haﬄe № ５", "Ǆep", "ẛ̣x", "㎏ 한글", "ﷺ", "", None, "½ mile", "plain"]
    fold = lambda t: " ".join(re.sub(r"[^\w ]|_", " ", "".join(c for c in unicodedata.normalize("NFKD", t.replace("ß", "ss")) if unicodedata.category(c) != "Mn").lower()).split())
    got = [r[0] for r in spark.createDataFrame([(t,) for t in given], "n string").select(classify.norm_name(F.col("n"))).collect()]
    assert got == [t if t is None else unicodedata.normalize("NFC", fold(t)) for t in given]


def test_missing_boundary_files(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        boundaries.read_geojson(spark, str(tmp_path / "none.geojson"), "name string")
    empty = boundaries.read_geojson(spark, str(tmp_path / "none.geojson"), "name string", optional=True)
    assert empty.columns == ["name", "kind", "rings", "lon", "lat"] and empty.count() == 0


def test_read_geojson_kinds(spark, tmp_path):
    hole = [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[1, 1], [3, 1], [3, 3], [1, 3]]]
    features = [("a", "Polygon", hole), ("b", "MultiPolygon", [[[[10, 0], [11, 0], [11, 1], [10, 0]]], [[[20, 0], [21, 0], [21, 1], [20, 0]]]]), ("c", "Point", [5, 6]), ("d", "LineString", [[0, 0], [1, 1]])]
    (tmp_path / "x.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"name": n}, "geometry": {"type": k, "coordinates": c}} for n, k, c in features]}))
    read = boundaries.read_geojson(spark, str(tmp_path / "x.geojson"), "name string")
    lines = boundaries.outlines(read.filter("rings is not null"), "name")
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 2.0, 2.0), (3, 10.9, 0.5), (4, 20.9, 0.5)], "pid long, x double, y double")
    assert sorted((r.pid, r.fid) for r in spatial.point_in_polygon(points, lines).collect()) == [(1, "a"), (3, "b"), (4, "b")]
    assert [(r.lon, r.lat) for r in read.filter("kind = 'Point'").collect()] == [(5.0, 6.0)]


def test_a_feature_file_is_read_by_several_tasks(spark, tmp_path):
    """Features across the ends of ranges, with braces, quotes and marks inside strings, in several spacings."""
    rng, features = random.Random(3), []
    for i in range(3000):
        n = rng.choice([3, 4, 60, 900 if i % 500 == 0 else 5])
        ring = [[round(rng.uniform(0, 9), 6), round(rng.uniform(0, 9), 6)] for _ in range(n)]
        name = rng.choice(["plain", 'a "quoted" }, {', '{"type": "Feature", "x": 1}', "\\ back", "é 漢", None, '"Feature"'])
        features.append({"type": "Feature", "properties": {"name": name, "n": i}, "geometry": {"type": "Polygon", "coordinates": [ring + ring[:1]]} if i % 7 else None})
    texts = {
        "line.geojson": '{"type": "FeatureCollection", "name": "x", "features": [\n' + ",\n".join(map(json.dumps, features)) + "\n]}\n",
        "tight.geojson": json.dumps({"type": "FeatureCollection", "features": features}, separators=(",", ":"), ensure_ascii=False),
        "wide.geojson": json.dumps({"features": features, "type": "FeatureCollection"}, indent=1),
        "mixed.geojson": '{"features": [' + ", ".join(json.dumps(f, separators=(",", ":") if i % 3 else None) for i, f in enumerate(features)) + "]}",
        "last.geojson": json.dumps({"type": "FeatureCollection", "features": [dict(reversed(f.items())) for f in features]}),
    }
    want = sorted((f["properties"]["n"], f["properties"]["name"], f["geometry"] and len(f["geometry"]["coordinates"][0])) for f in features)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        for name, text in texts.items():
            (tmp_path / name).write_text(text)
            read = boundaries.read_geojson(spark, str(tmp_path / name), "name string, n int")
            got = sorted((r.n, r.name, r.rings and len(r.rings[0])) for r in read.collect())
            assert got == want, name
            assert (read.rdd.getNumPartitions() > 3) == (name != "last.geojson")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "none.json").write_text('{"type": "FeatureCollection", "features": []}')
    assert boundaries.read_geojson(spark, str(tmp_path / "none.json"), "name string").count() == 0
    (tmp_path / "odd.json").write_text('{"features": [{"type": "Feature", "properties": {"name": "a"}, "geometry": null}, {"id": 1, "type": "Feature", "properties": {"name": "b"}, "geometry": null}]}')
    with pytest.raises(Exception, match="does not begin with its type"):
        boundaries.read_geojson(spark, str(tmp_path / "odd.json"), "name string").collect()


def test_relations_and_rings_that_do_not_close(spark):
    way = lambda role, *at: {"type": "way", "ref": 1, "role": role, "geometry": [{"lon": x, "lat": y} for x, y in at]}
    whole = [way("outer", (0, 0), (4, 0), (4, 4)), way("outer", (0, 0), (0, 4), (4, 4)), way("inner", (1, 1), (3, 1), (3, 3), (1, 3), (1, 1))]
    rows = [{"type": "relation", "id": i, "tags": {"type": t}, "members": m} for i, t, m in ((1, "multipolygon", whole), (2, "boundary", whole[:1]), (3, "route", whole), (4, "multipolygon", []), (5, "multipolygon", [way("outer", (9, 9)), {"type": "node", "ref": 2, "role": ""}]))]
    staged = spark.createDataFrame([(json.dumps(r),) for r in rows] + [("broken",), (None,)], "element string")
    assert layers.parse_osm_elements(staged).count() == 0  # off unless asked for
    segments = elements.relation_segments(staged)
    assert {(r.fid, r.role) for r in segments.collect()} == {("relation/1", "outer"), ("relation/1", "inner"), ("relation/2", "outer")}
    rings = elements.closed(segments)
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 2.0, 2.0), (3, 5.0, 5.0)], "pid long, x double, y double")
    assert [(r.pid, r.fid) for r in spatial.point_in_polygon(points, rings).collect()] == [(1, "relation/1")]
    with pytest.raises(ValueError, match="relation/2"):
        elements.closed(segments, strict=True)


def test_selected_waterways(spark):
    layer = spark.createDataFrame([("a", "river", "R", 3), ("b", "river", "S", 9), ("c", "canal", "K", 9), ("d", "canal", "K", 9), ("d", "canal", "K", 9), ("e", "canal", "L", 1), ("f", "river", " ", 1), ("g", "river", "T", None)], "osm_id string, waterway_type string, name string, scalerank int")
    parts = spark.createDataFrame([(i, 0.0, 0.0, 0.0, m) for i, m in (("a", 1.0), ("c", 60.0), ("d", 50.0), ("e", 100.0))], "osm_id string, x1 double, y1 double, x2 double, y2 double")
    assert sorted(r.osm_id for r in lines.selected_waterways(layer, parts, 8, 100.0).collect()) == ["a", "c", "d"]


def test_differences_of_leaves(spark):
    kind = "k int, s struct<x: int, l: array<struct<y: string>>>, m map<string, int>, t string"
    a = [(1, (1, [("p",), ("q",)]), {"u": 1}, "same"), (2, None, None, None), (3, (0, []), {}, "gone")]
    b = [(1, (2, [("p",)]), {"u": 1, "v": 2}, "same"), (2, (None, None), {}, None), (4, (0, []), {}, "new")]
    got = {r.path: (r.n, r.k, r.a, r.b) for r in tables.diff_leaves(spark.createDataFrame(a, kind), spark.createDataFrame(b, kind), ["k"]).collect()}
    assert got == {"s.x": (1, 1, "1", "2"), "s.l[1].y": (1, 1, "q", None), "m[v]": (1, 1, None, "2"), "m": (1, 2, None, "{}"), "only a": (1, 3, None, None), "only b": (1, 4, None, None)}


def test_remapped(spark):
    units = spark.createDataFrame([("A", "x", 1.0, 1.0), ("A", "y", 7.3, 1.0), ("A", "y", 7.4, 1.0), ("A", "z", 0.0, 0.0)], "country string, name string, lon double, lat double")
    names = spark.createDataFrame([("A", "x", "P", None, None, False), ("A", "y", "W", "lon", 7.3, False), ("A", "y", "E", "lon", 7.3, True)], "country string, name string, province string, axis string, cut double, upper boolean")
    assert sorted((r.lon, r.province) for r in boundaries.remapped(units, names).collect()) == [(1.0, "P"), (7.3, "W"), (7.4, "E")]


def test_settlement_elements(spark):
    tags = [{"place": "city", "population": "12"}, {"place": "village", "population": "499"}, {"place": "village", "population": "few", "name:en": "E"}, {"place": "hamlet"}, {"place": "town", "population": None, "name": "T"}]
    rows = [(f"node/{i}", "point", [(4.0, 50.0)], t) for i, t in enumerate(tags)]
    made = elements.settlement_layer(spark.createDataFrame(rows, "osm_id string, kind string, points array<struct<lon: double, lat: double>>, tags map<string, string>"))
    assert sorted((r.osm_id, r.name, r.place_type, r.population) for r in made.collect()) == [("node/0", "", "city", 12), ("node/2", "E", "village", 0), ("node/4", "T", "town", 0)]


def test_order_statistic(spark):
    rows = spark.range(999).select(F.pmod(F.col("id") * 7919, F.lit(500)).cast("double").alias("v"))
    want = sorted(r.v for r in rows.collect())
    for share in (0, 0.5, 0.9, 1):
        assert tables.order_statistic(rows.repartition(3), "v", share, 7) == want[int(share * 998)]
    assert tables.order_statistic(rows.limit(0), "v", 0.9) is None
    inf, nan = float("inf"), float("nan")
    of = lambda values, share: tables.order_statistic(spark.createDataFrame([(v,) for v in values], "v double"), "v", share)
    assert of([1.0, 2.0, inf], 0.5) == 2.0 and of([1.0, 2.0, inf], 1.0) == inf and of([-inf, 1.0, 2.0], 0.0) == -inf
    assert of([1.0, 2.0, 3.0, nan, None], 0.9) == 2.0 and of([nan], 0.5) is None and of([-inf, -inf, inf], 0.5) == -inf
    assert of([-1.7e308, 0.0, 1.7e308], 0.5) == 0.0


def test_fingerprint_of_rows_in_any_order(spark):
    mark = lambda rows: tuple(tables.fingerprint(spark.createDataFrame(rows, "a string, b string")).first())
    one = mark([("x", "1"), ("y", "2"), ("y", "2")])
    assert one == mark([("y", "2"), ("x", "1"), ("y", "2")]) and one[0] == 3
    others = [[("x", "1"), ("x", "1"), ("y", "2")], [("x", "1"), ("x", "1")], [("y", "2"), ("y", "2")], [("a|", "b")], [("a", "|b")], [(None, "b")], [("", "b")], [("-", "b")]]
    assert len({mark(o) for o in others} | {one}) == len(others) + 1
    assert mark([("", "")])[1:] != mark([(None, None)])[1:] and tuple(tables.fingerprint(spark.createDataFrame([], "a string")).first()) == (0, 0, 0)


def test_gates_fail_where_they_should(spark):
    good = {"schema": "1", "id": "1_1", "col": 1, "row": 1, "biome": "plains", "country": "A", "province": "A_1", "elev": 1.0, "slope": 1.0, "port": False, "airfield": False, "fortification": "none", "has_river": True, "river_name": "R", "river_edges": [5], "kind": "none", "bridge": True, "parent_city": "", "anthrome": "none", "tier": "rural", "name": "", "coal": True}
    schema = "schema string, id string, col int, row int, biome string, country string, province string, elev double, slope double, port boolean, airfield boolean, fortification string, has_river boolean, river_name string, river_edges array<int>, kind string, bridge boolean, parent_city string, anthrome string, tier string, name string, coal boolean"
    expect = {"schema": "1", "hex_count": (1, 1), "countries": {"A": (1, 1)}, "water_min": 0, "biome_bands": {"plains": ("pct", 100, 100)}, "river_hexes": (1, 1), "cities_min": 0, "sprawl": {}, "resources": {"coal": 1}}
    run = lambda **change: {r.name for r in quality.checks(spark.createDataFrame([tuple((good | change).values())], schema), quality.record_gates(expect)).collect() if not r.ok}
    assert run() == set()
    for change, broken in [({"id": "1_2"}, "ids"), ({"country": ""}, "land without country"), ({"elev": -32768.0}, "no void shipped"), ({"fortification": "light"}, "inert fields"), ({"river_name": ""}, "river names"), ({"river_edges": [6]}, "river edges"), ({"kind": "suburb"}, "suburbs have a parent"), ({"province": "B_1"}, "province country"), ({"name": "x"}, "rural names"), ({"coal": False}, "resource coal")]:
        assert broken in run(**change)
    assert not quality.order_gate(spark.createDataFrame([(0, 1, 2), (1, 1, 1)], "position long, col int, row int"), "position").first().ok


def test_records_take_defaults_and_are_sorted(spark, tmp_path):
    rows = records.records(spark, SF).filter("k between 1 and 60").withColumns({c: F.lit(None).cast(t) for c, t in (("country", "string"), ("road", "string"), ("river_edges", "array<int>"), ("bridge", "boolean"), ("elev", "double"))})
    rows = rows.withColumns({"q": F.col("col"), "r": F.col("row")}).repartition(4)
    sinks.write_records(rows.select("q", "r"), rows, str(tmp_path / "out"))
    lines = [json.loads(x) for p in sorted((tmp_path / "out").glob("*.json")) for x in p.read_text().splitlines()]
    at = [(x["coords"]["col"], x["coords"]["row"]) for x in lines]
    assert at == sorted(at) and len(at) == 60
    assert lines[0]["infrastructure"]["road"] == "none" and lines[0]["political"]["country_at_start"] == "" and lines[0]["terrain"]["river_edges"] == [] and lines[0]["geo"]["elevation_m"] == 0.0
    with pytest.raises(ValueError, match="no data"):
        sinks.write_records(rows.select("q", "r").union(spark.createDataFrame([(99, 99)], "q int, r int")), rows, str(tmp_path / "again"))


def test_footprint_and_beach(spark):
    rows = [(0, 0, "city", "C", "farmland", "none", 3), (0, 1, "none", "", "industrial", "none", 0), (0, 2, "town", "T", "residential", "none", 2), (0, 9, "none", "", None, "cropland", 0)]
    h = spark.createDataFrame(rows, "q int, r int, kind string, name string, landuse string, anthrome string, population_class int")
    claims = spark.createDataFrame([(0, 0, 0, 0, 0.0), (0, 1, 0, 0, 2.0), (0, 2, 0, 0, 7.25)], "q int, r int, sq int, sr int, km double")
    got = [(r.r, r.kind, r.anthrome, r.population_class, r.parent_city, r.km) for r in hexes.footprint(h, claims).orderBy("r").collect()]
    assert got == [(0, "city", "metro", 3, "C", 0.0), (1, "suburb", "industrial", 3, "C", 2.0), (2, "suburb", "residential", 2, "C", 7.2), (9, "none", "cropland", 0, "", None)]
    beach = spark.createDataFrame([(True, "plains", "beach"), (False, "plains", "beach"), (True, "hill", "beach"), (True, "plains", None)], "coastal boolean, biome string, landuse string")
    assert [r.biome for r in hexes.beaches(beach).collect()] == ["beach", "plains", "hill", "plains"]


def test_enrichment_agrees_with_its_parts(spark):
    """A coarse grid: completeness, and land use, rivers and settlements as plain Python finds them."""
    size, box = 10_000.0, enrichment.FRAME
    rows = enrichment.enriched(spark, SF, size, box)
    grid = hexes.hex_grid(spark, box, size)
    sinks.require_complete(grid, rows)
    got = {(r.q, r.r): r for r in rows.collect()}
    assert len(got) == rows.count() == grid.count()
    shapes = layers.layer(spark, SF, layers.LANDUSE_SQL).collect()
    for h in got.values():
        if h.biome in ("water", "lake"):
            assert h.landuse is None and h.road is None
            continue
        over = [s for s in shapes if s.fid % 10 != 9 and s.landuse_type != "quarry" and (abs(h.lon - s.cx) < s.hw and abs(h.lat - s.cy) < s.hh if s["shape"] == "rect" else abs(h.lon - s.cx) / s.hw + abs(h.lat - s.cy) / s.hh < 1)]
        areas = sorted((round((4 if s["shape"] == "rect" else 2) * s.hw * s.hh, 12), s.landuse_type) for s in over)
        assert h.landuse == (areas[0][1] if areas else None)
        assert bool(h.has_river) == (h.river_name is not None) and (h.tier == "none") == (h.country == "" or h.province == "")
    assert sum(h.tier == "capital" for h in got.values()) == len({h.province for h in got.values() if h.tier == "capital"}) > 0

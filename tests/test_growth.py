"""Work that grows with places, windows and rows, not with copies of them or with both sides of a join."""

import numpy as np
from pyspark.sql import functions as F

from hexfold.functions import geo
from hexfold.operators import cover, lines, raster, spatial
from hexfold.plans import elements, enrichment
from hexfold.plans import queries as maps
from hexfold.sources import elements as sources
from hexfold.sources import layers

SQUARE = ((0.0, 0.0, 1.0, 0.0), (1.0, 0.0, 1.0, 1.0), (1.0, 1.0, 0.0, 1.0), (0.0, 1.0, 0.0, 0.0))


def squares(spark, sides):
    rows = [(fid, *(v * side for v in s)) for fid, side in sides.items() for s in SQUARE]
    return spark.createDataFrame(rows, "fid long, x1 double, y1 double, x2 double, y2 double")


def points(spark, places, copies):
    return spark.createDataFrame([(n * len(places) + i, x, y) for n in range(copies) for i, (x, y) in enumerate(places)], "pid long, x double, y double")


def watched(monkeypatch, module, name, at):
    """The number of rows of argument ``at`` of each call."""
    seen, real = [], getattr(module, name)

    def call(*args, **more):
        seen.append(args[at].count())
        return real(*args, **more)

    monkeypatch.setattr(module, name, call)
    return seen


def test_boxes_of_one_window_ask_once(spark, monkeypatch):
    asked = watched(monkeypatch, raster, "written", 0)
    slopes = spark.createDataFrame([(r, c, float(10 * r + c)) for r in range(8) for c in range(8)], "px_row int, px_col int, elev double")
    boxes = spark.createDataFrame([(i, 0.11, -0.39, 0.39, -0.11) for i in range(20)] + [(20, 9.0, 9.0, 9.5, 9.5), (21, None, 0.0, 1.0, 1.0)], "zid long, x0 double, y0 double, x1 double, y1 double")
    got = {r.zid: r.p90 for r in raster.zonal_p90(boxes, raster.blocks(slopes, 4), 0.0, 0.0, 0.1, 0.1, block=4).collect()}
    values = sorted(10 * r + c for r in range(1, 5) for c in range(1, 5))
    assert asked == [2] and got == {**dict.fromkeys(range(20), values[13] + 0.5 * (values[14] - values[13])), 20: 0.0, 21: 0.0}


def joins(plan):
    """The names of the columns of every join of a plan."""
    below = [plan.children().apply(i) for i in range(plan.children().size())]
    own = [{plan.output().apply(i).name() for i in range(plan.output().size())}] if plan.nodeName() == "Join" else []
    return own + [names for b in below for names in joins(b)]


def test_windows_meet_blocks_in_groups_not_in_rows_with_pixels(spark, monkeypatch):
    monkeypatch.setattr(raster, "SHARE", 300, raising=False)  # several copies of a block
    slopes = {(r, c): None if (r + 2 * c) % 7 == 0 else float(r * 37 % 23 + c * 11 % 17) for r in range(11) for c in range(9) if (r, c) != (5, 5)}
    sides = [(a, b) for a in range(-2, 12, 2) for b in range(a, 12, 3)]
    windows = dict(enumerate([*((r, c) for r in sides for c in sides), ((9, 1), (1, 9)), ((1, 9), (9, 1))]))
    boxes = spark.createDataFrame([(i, c0 + 0.5, -r1 + 0.5, c1 - 0.5, -r0 - 0.5) for i, ((r0, r1), (c0, c1)) in windows.items()], "zid long, x0 double, y0 double, x1 double, y1 double")
    stored = raster.blocks(spark.createDataFrame([(r, c, v) for (r, c), v in slopes.items()], "px_row int, px_col int, elev double"), 4)
    made = raster.zonal_p90(boxes, stored, 0.0, 0.0, 1.0, 1.0, block=4)
    inside = lambda w: [v for (r, c), v in slopes.items() if v is not None and w[0][0] <= r <= w[0][1] and w[1][0] <= c <= w[1][1]]
    assert {r.zid: round(r.p90, 9) for r in made.collect()} == {i: round(float(np.percentile(inside(w) or [0.0], 90)), 9) for i, w in windows.items()}
    found = joins(made._jdf.queryExecution().optimizedPlan())
    assert found and not any({"c0", "pixels"} <= names for names in found)


def test_stencils_work_on_few_blocks_at_a_time(spark):
    def west_of(mid, west, east, north, south, rows):
        if len(mid) > 16:
            raise ValueError(f"{len(mid)} blocks at once")
        return west

    dem = spark.createDataFrame([(r, c, float(100 * r + c)) for r in range(30) for c in range(20)], "px_row int, px_col int, elev double")
    made = raster.pixels(raster.stencil(raster.store(raster.blocks(dem, 1), 1), 1, west_of), "v")
    assert {(r.px_row, r.px_col): r.v for r in made.collect()} == {(r, c): 100.0 * r + c - 1 if c else None for r in range(30) for c in range(20)}


def test_places_and_the_least_targets_of_a_place_are_compared(spark, monkeypatch):
    kept = watched(monkeypatch, spatial, "written", 0)
    targets = points(spark, [(0.0, 0.0), (0.01, 0.0)], 50).withColumnRenamed("pid", "tid")
    got = sorted((r.pid, r["rank"], r.tid) for r in spatial.nearest(points(spark, [(0.001, 0.0)], 3), targets, 3).collect())
    assert got == [(p, n + 1, 2 * n) for p in range(3) for n in range(3)] and kept[:2] == [1, 6]


def test_names_are_normalised_once_a_row(spark):
    plan = maps.name_scores(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("\\p{Mn}") == 2  # of one name and of the other


def test_a_place_asks_once_for_its_least_feature(spark, monkeypatch):
    asked = watched(monkeypatch, spatial, "point_in_polygon", 0)
    segments = squares(spark, {1: 1.0, 2: 0.5})
    features = spark.createDataFrame([(1, 1.0, "wide"), (2, 0.25, "small")], "fid long, area double, kind string")
    at = points(spark, [(0.2, 0.2), (0.7, 0.7), (3.0, 3.0), (None, 1.0)], 10)
    got = {(r.pid % 4, r.kind) for r in spatial.smallest_cover(at, segments, features).collect()}
    assert got == {(0, "small"), (1, "wide")} and asked == [3]


def test_dense_features_are_asked_from_the_least_on(spark, monkeypatch):
    sides = {fid: 0.2 + fid / 500 for fid in range(400)}
    features = spark.createDataFrame([(fid, side * side, f"k{fid}") for fid, side in sides.items()], "fid long, area double, kind string")
    at = points(spark, [(i / 40, i / 40) for i in range(41)], 1)
    asked = watched(monkeypatch, spatial, "point_in_polygon", 0)
    got = {r.pid: r.kind for r in spatial.smallest_cover(at, squares(spark, sides), features).collect()}
    assert got == {i: f"k{min(f for f, s in sides.items() if i / 40 < s)}" for i in range(40)}
    assert len(asked) > 1 and asked[0] == 41 and asked == sorted(asked, reverse=True) and asked[-1] < 41


def test_only_features_with_the_point_in_their_envelope_are_crossed(spark):
    cells, levels, _ = cover.cover(squares(spark, {1: 0.6}))
    assert {tuple(r) for r in cells.select(*cover.BOX).collect()} == {(0.0, 0.0, 0.6, 0.6)}


def test_json_is_read_once_a_row(spark):
    text = F.to_json(F.struct(F.lit("way").alias("type"), F.col("id"), F.array(F.struct(F.lit(1.0).alias("lon"), F.lit(2.0).alias("lat"))).alias("geometry")))
    parsed = layers.parse_osm_elements(spark.range(3).select(text.alias("element"))).filter("kind = 'polygon' and size(points) > 3 and tags['a'] is null")
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_a_place_asks_once_for_its_outline(spark, monkeypatch):
    asked = watched(monkeypatch, spatial, "point_in_polygon", 0)
    codes = spark.createDataFrame([(1, "a")], "fid long, code string")
    at = points(spark, [(0.5, 0.5), (1.01, 0.5), (2.0, 0.5), (float("nan"), 0.5)], 10)
    got = {(r.pid % 4, r.code) for r in spatial.cover_or_snap(at, squares(spark, {1: 1.0}), codes, 0.02).collect()}
    assert got == {(0, "a"), (1, "a"), (2, ""), (3, "")} and asked == [3]


def test_ways_read_json_once_for_each_layer(spark):
    plan = elements.way_elements(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 3


def test_features_count_points_by_place(spark, monkeypatch):
    asked = watched(monkeypatch, spatial, "point_in_polygon", 0)
    at = points(spark, [(0.2, 0.2), (0.7, 0.7), (3.0, 3.0)], 10)
    got = {(r.fid, r.n) for r in spatial.covered_counts(at, squares(spark, {1: 1.0, 2: 0.5, 3: 0.1})).collect()}
    assert got == {(1, 20), (2, 10)} and asked == [3]


def test_lines_are_cut_where_they_lie(spark):
    points = "array<struct<lon: double, lat: double>>"
    rows = [("way/1", [(4.1, 50.6), (4.13, 50.63), (4.2, 50.7)], "paved"), ("way/2", [(4.3, 50.6)], "none"), ("way/3", [(4.1, 50.8), (None, 50.9), (4.2, 50.9), (4.21, 50.9)], "highway"), ("way/4", None, "none")]
    layer, to = spark.createDataFrame(rows, f"osm_id string, points {points}, road_level string"), ("utm", (3.0,))
    cut = enrichment.in_projection(layer, to, 2000.0, "road_level")
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan
    moved = lines.clip(lines.segments(geo.project(sources.line_points(layer, "road_level"), to), "osm_id"), 2000.0).join(layer.select("osm_id", "road_level"), "osm_id")
    assert sorted(map(str, cut.select(sorted(cut.columns)).collect())) == sorted(map(str, moved.select(sorted(cut.columns)).collect()))
    assert {r.osm_id for r in cut.collect()} == {"way/1", "way/3"}


def test_edges_of_rivers_are_numbers_in_groups(spark):
    rows = spark.createDataFrame([(0, 0, 1, "A", 5.0, None, 3), (0, 0, 1, "A", 5.0, 0, 5), (1, 0, 2, "A", 5.0, None, None)], "q int, r int, k int, name string, metres double, enter int, leave int")
    rivers = lines.rivers_of_hexes(rows)
    assert "collect_set" not in rivers._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.q, tuple(r.river_edges)) for r in rivers.collect()} == {(0, (0, 3, 5)), (1, ())}

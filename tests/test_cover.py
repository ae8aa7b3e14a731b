import math
import random

from pyspark.sql import functions as F

from hexfold.operators import cover

SEGMENTS, POINTS = "fid string, x1 double, y1 double, x2 double, y2 double", "pid int, x double, y double"


def ring(fid, points):
    return [(fid, *map(float, a), *map(float, b)) for a, b in zip(points, points[1:] + points[:1], strict=True)]


def inside(x, y, segments):
    return sum(((y1 > y) != (y2 > y)) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 for _, x1, y1, x2, y2 in segments) % 2


def test_equals_a_ray_over_all_segments(spark, capacity=16):
    rng = random.Random(4)
    shapes = {"hole": ring("hole", [(0, 0), (8, 0), (8, 8), (0, 8)]) + ring("hole", [(2, 2), (6, 2), (6, 6), (2, 6)])}
    shapes["parts"] = ring("parts", [(-5, -5), (-3, -5), (-4, -1)]) + ring("parts", [(3, -5), (5, -5), (4, -1)])
    star = [((3 + 6 * (i % 2) * rng.random()) * math.cos(i * math.pi / 60) + 1.5, (3 + 6 * (i % 2)) * math.sin(i * math.pi / 60) - 0.25) for i in range(120)]
    shapes["star"] = ring("star", star)
    shapes["fan"] = [s for i in range(60) for s in ring("fan", [(1, 1), (1 + 5 * math.cos(i / 10), 1 + 5 * math.sin(i / 10)), (1 + 5 * math.cos(i / 10 + 0.05), 1 + 5 * math.sin(i / 10 + 0.05))])]
    shapes["far"] = ring("far", [(-170.5, -80), (175, -60.5), (100, 85)])
    shapes["tiny"] = ring("tiny", [(1, 1), (1.000001, 1), (1.000001, 1.000001)])
    at = [(rng.uniform(-9, 9), rng.uniform(-9, 9)) for _ in range(600)] + [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(200)]
    at += [(x / 2, y / 2) for x in range(-11, 18) for y in range(-11, 18)] + [(1.0000005, 1.0000002), (1.0000009, 1.0000001)]
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(at)] + [(-1, None, 1.0), (-2, float("nan"), 1.0)]
    segments = spark.createDataFrame([s for shape in shapes.values() for s in shape] + [("hole", None, 1.0, 2.0, 2.0)], SEGMENTS)
    got = {(r.pid, r.fid) for r in cover.point_in_polygon(spark.createDataFrame(points, POINTS), segments, capacity=capacity).collect()}
    # a corner of a sloped side may be taken for either side of it: only points off the outline, or on upright sides, count
    want = {(i, f) for i, x, y in points if i >= 0 for f, shape in shapes.items() if inside(x, y, shape)}
    wrong = {(i, f) for i, f in got ^ want if f not in ("fan", "star", "parts") or min(distance(*points[i][1:], s) for s in shapes[f]) > 1e-9}
    assert not wrong


def distance(x, y, segment):
    _, x1, y1, x2, y2 = segment
    dx, dy = x2 - x1, y2 - y1
    t = max(0, min(1, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy)))
    return math.hypot(x - x1 - t * dx, y - y1 - t * dy)


def test_a_long_outline_costs_its_length(spark):
    """100,000 segments with all points inside: cells follow the outline, and a point meets few segments."""
    n = 100_000
    a = lambda i: F.radians(i * (360.0 / n))
    r = lambda i: 3 + 0.05 * F.sin(i * (400 * math.pi / n))
    i, k = F.col("id"), (F.col("id") + 1) % n
    outline = spark.range(n).select(F.lit("a").alias("fid"), (r(i) * F.cos(a(i))).alias("x1"), (r(i) * F.sin(a(i))).alias("y1"), (r(k) * F.cos(a(k))).alias("x2"), (r(k) * F.sin(a(k))).alias("y2"))
    cells, levels, several = cover.cover(outline)
    made = cells.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("segments")).alias("s"), F.max(F.size("segments")).alias("most")).first()
    assert made.most <= cover.CAPACITY and made.s < 1.5 * n and made.n < n / 4 and len(levels) < 20 and not several
    points = spark.range(4000).select(F.col("id").cast("int").alias("pid"), (2.9 * F.sqrt(F.rand(1)) * F.cos(F.col("id"))).alias("x"), F.lit(0.0).alias("y"))
    points = points.withColumn("y", F.col("x") * F.sin(F.col("pid")) * 0.2)
    assert cover.point_in_polygon(points, outline).count() == 4000
    near = spark.range(2000).select(F.col("id").cast("int").alias("pid"), (r(i * 50 + 0.5) * F.cos(a(i * 50 + 0.5)) * F.when(i % 2 == 0, 0.9999).otherwise(1.0001)).alias("x"), (r(i * 50 + 0.5) * F.sin(a(i * 50 + 0.5)) * F.when(i % 2 == 0, 0.9999).otherwise(1.0001)).alias("y"))
    got = {row.pid for row in cover.point_in_polygon(near, outline).collect()}
    assert got == set(range(0, 2000, 2))
    assert cover.point_in_polygon(points, outline.limit(0)).count() == 0

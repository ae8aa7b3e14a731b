"""Spatial joins: both sides in cells, an equi-join, an exact test, a reduction."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexfold.functions import geo
from hexfold.operators.cover import point_in_polygon
from hexfold.operators.scratch import written

DENSE, STEP = 32, 4


def spots(points: DataFrame, *same: str) -> DataFrame:
    """The places (pid, x, y, ``same``) of points, each once; pid is the place itself.  Points without a coordinate have none."""
    known = points.filter("x is not null and y is not null and not isnan(x) and not isnan(y)").select("x", "y", *same).distinct()
    return written(known, "spots").withColumn("pid", F.struct("x", "y", *same))


def at_spots(points: DataFrame, found: DataFrame, *same: str, how: str = "left") -> DataFrame:
    """``points`` with what was found for their places."""
    place = ["x", "y", *same]
    return points.join(found.select(*[F.col(f"pid.{c}").alias(c) for c in place], *[c for c in found.columns if c != "pid"]), place, how)


def in_any(points: DataFrame, segments: DataFrame) -> DataFrame:
    """The points (pid, x, y) inside some feature."""
    return at_spots(points, point_in_polygon(spots(points), segments).select("pid").distinct(), how="left_semi").select(*points.columns)


def flag_land_lake(points: DataFrame, land: DataFrame | None, lakes: DataFrame, elev: str = "elev") -> DataFrame:
    """``points`` (pid, x, y ...) with water and lake.

    Water is what lies outside all land, or where no land layer is given what
    has no elevation above 0; only what is no water can be in a lake.
    """
    if land is None:
        wet = points.withColumn("water", F.coalesce(F.col(elev) <= 0, F.lit(True)))
    else:
        dry = in_any(points, land).select("pid", F.lit(True).alias("_dry"))
        wet = points.join(dry, "pid", "left").withColumn("water", F.col("_dry").isNull()).drop("_dry")
    inside = in_any(points, lakes).select("pid", F.lit(True).alias("_in"))
    return wet.join(inside, "pid", "left").withColumn("lake", ~F.col("water") & F.col("_in").isNotNull()).drop("_in")


def smallest_cover(points: DataFrame, segments: DataFrame, features: DataFrame) -> DataFrame:
    """pid, kind of the least-area feature (fid, area, kind) over each point; ties by kind.

    Points at one place ask once.  Where features lie so dense that they cover
    each place more than ``DENSE`` times, the least ones are asked for first, and
    only places that these leave open go on to larger ones; no feature that
    comes later is smaller, so pairs grow with the places and not with both sides.
    """
    todo, found = spots(points), None
    limits = _area_limits(todo, features)
    for low, high in zip([None, *limits], [*limits, None], strict=True):
        some = features
        if low is not None:
            some = some.filter(F.col("area") >= low)
        if high is not None:
            some = some.filter(F.col("area") < high)
        held = segments.join(some.select("fid"), "fid", "left_semi") if limits else segments
        least = point_in_polygon(todo, held).join(some, "fid").groupBy("pid").agg(F.min(F.struct("area", "kind")).alias("m"))
        if limits:
            least = written(least, "least")
            todo = written(todo.join(least, "pid", "left_anti"), "open")
        found = least if found is None else found.union(least)
        if limits and todo.isEmpty():
            break
    return at_spots(points, found, how="inner").select("pid", F.col("m.kind").alias("kind"))


def _area_limits(places: DataFrame, features: DataFrame) -> list[float]:
    """Areas that part features into those that cover a place about ``DENSE`` times, ``STEP`` times as often, and so on; none where all do so seldom."""
    x0, x1, y0, y1 = places.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    extent = (x1 - x0) * (y1 - y0) if x0 is not None else 0.0
    if not 0 < extent < float("inf"):
        return []
    level = F.floor(F.log2("area") * 8).alias("level")
    sizes = features.filter("area > 0 and area < double('infinity')").groupBy(level).agg(F.min("area").alias("low"), F.sum("area").alias("total")).orderBy("level").collect()
    limits, covered, most = [], 0.0, DENSE
    for r in sizes:
        if covered > most * extent:
            limits.append(r["low"])
            most *= STEP
        covered += r["total"]
    return limits


def covered_counts(points: DataFrame, segments: DataFrame) -> DataFrame:
    """fid, n: how many points each feature covers, of those that cover some; points at one place ask once, with their number."""
    number = written(points.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")), "numbers")
    over = point_in_polygon(number.withColumn("pid", F.struct("x", "y", "n")), segments)
    return over.groupBy("fid").agg(F.sum("pid.n").alias("n"))


def cover_or_snap(points: DataFrame, segments: DataFrame, codes: DataFrame, snap: float, cell: float = 0.1, same: str | None = None) -> DataFrame:
    """pid, code: the least code that covers a point, else the nearest feature's under ``snap``, else ''.

    With ``same``, a column of points and segments, only features that agree in
    it count.  Points at one place ask once.  For the snap a segment stands in the cells near its parts of one
    cell's length, so in cells by its length and not by its envelope.
    """
    places = spots(points, *([same] if same else []))
    inside = point_in_polygon(places, segments, same).join(codes, "fid").groupBy("pid").agg(F.min("code").alias("inside"))
    left = places.join(inside, "pid", "left_anti")
    keys, ends = ["fid", *([same] if same else [])], ["x1", "y1", "x2", "y2"]
    parts = F.greatest(F.lit(1), F.ceil(F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1"))) / cell)).cast("int")
    cut = segments.select(*keys, *ends, parts.alias("_n")).select("*", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_k"))
    to = lambda a, b, k: F.col(a) + (F.col(b) - F.col(a)) * k / F.col("_n")
    span = lambda a, b: F.explode(F.sequence(*[F.floor((f(to(a, b, F.col("_k")), to(a, b, F.col("_k") + 1)) + d) / cell) for f, d in ((F.least, -snap), (F.greatest, snap))]))
    placed = cut.select("*", span("x1", "x2").alias("i")).select(*keys, *ends, "i", span("y1", "y2").alias("j"))
    here = left.select("pid", "x", "y", *([same] if same else []), F.floor(F.col("x") / cell).alias("i"), F.floor(F.col("y") / cell).alias("j"))
    near = here.join(placed, ["i", "j", *([same] if same else [])]).groupBy("pid", "fid").agg(F.min(geo.segment_distance(F.col("x"), F.col("y"))).alias("d")).filter(F.col("d") < snap)
    near = near.join(codes, "fid").groupBy("pid").agg(F.min(F.struct("d", "code")).alias("m")).select("pid", F.col("m.code").alias("code"))
    found = inside.select("pid", F.col("inside").alias("code")).union(near)
    return at_spots(points, found, *([same] if same else [])).select("pid", F.coalesce("code", F.lit("")).alias("code"))


def nearest(points: DataFrame, targets: DataFrame, k: int, cell: float = 0.05) -> DataFrame:
    """pid, rank, tid, d: the ``k`` nearest targets (tid, x, y) by hypot(dy, dx cos y); ties by tid.

    Points at one place ask once, and of targets at one place the ``k`` least
    tids are enough.  Places are compared with the targets of 3 x 3 cells, no
    larger than hold ``k`` targets where these lie evenly; those whose ``k``
    targets may not be the nearest go on with cells twice as wide, so a far
    point takes rounds that grow with the logarithm of its distance.  The
    window keeps ``k`` rows of a point before the shuffle.  Rows without a
    coordinate (null or no number) have no neighbours and are none.
    """
    known = lambda df: df.filter("x is not null and y is not null and not isnan(x) and not isnan(y)")
    todo, alike = spots(points), Window.partitionBy("tx", "ty").orderBy("tid")
    targets = known(targets).select("tid", F.col("x").alias("tx"), F.col("y").alias("ty")).withColumn("_n", F.row_number().over(alike))
    targets = written(targets.filter(F.col("_n") <= k).drop("_n"), "targets")
    total, x0, x1, y0, y1 = targets.agg(F.count(F.lit(1)), F.min("tx"), F.max("tx"), F.min("ty"), F.max("ty")).first()
    if total and max(x1 - x0, y1 - y0) > 0:
        # an even spread, along a line at the least
        cell = min(cell, max(math.sqrt((x1 - x0) * (y1 - y0) * k / total), max(x1 - x0, y1 - y0) * k / total))
    spread, found = F.cos(F.radians(F.col("y"))), None
    around = F.array(*[F.lit(a) for a in (-1, 0, 1)])
    while True:
        at = lambda v: F.floor(v / cell)  # noqa: B023, E731
        each = todo.select("*", F.explode(around).alias("a")).select("*", F.explode(around).alias("b")).select("pid", "x", "y", (at(F.col("x")) + F.col("a")).alias("i"), (at(F.col("y")) + F.col("b")).alias("j"))
        placed = targets.select("*", at(F.col("tx")).alias("i"), at(F.col("ty")).alias("j"))
        d = F.sqrt((F.col("ty") - F.col("y")) ** 2 + ((F.col("tx") - F.col("x")) * spread) ** 2)
        order = Window.partitionBy("pid").orderBy("d", "tid")
        best = each.join(placed, ["i", "j"]).withColumn("d", d).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        last = best.groupBy("pid", "x", "y").agg(F.max("d").alias("far"), F.count(F.lit(1)).alias("n"))
        if total:
            all_seen = (at(F.lit(x0)) >= at(F.col("x")) - 1) & (at(F.lit(x1)) <= at(F.col("x")) + 1) & (at(F.lit(y0)) >= at(F.col("y")) - 1) & (at(F.lit(y1)) <= at(F.col("y")) + 1)
            sure = last.filter(((F.col("n") == k) & (F.col("far") <= cell * spread)) | all_seen).select("pid")
        else:
            sure = last.select("pid")
        got = best.join(sure, "pid", "left_semi").select("pid", "rank", "tid", "d")
        found = got if found is None else found.union(got)
        todo = todo.join(sure, "pid", "left_anti")
        if not total or todo.isEmpty():
            return at_spots(points, found, how="inner").select("pid", "rank", "tid", "d")
        todo, cell = written(todo), cell * 2


def within(points: DataFrame, targets: DataFrame, degrees: float) -> DataFrame:
    """Points (pid, x, y) with some target (x, y) nearer than ``degrees``, dx scaled by cos y; strict."""
    wide = degrees / F.greatest(F.lit(0.01), F.cos(F.radians("y")))
    span = lambda at, by: F.explode(F.sequence(F.floor((F.col(at) - by) / degrees), F.floor((F.col(at) + by) / degrees)))
    each = points.select("pid", "x", "y", span("x", wide).alias("i")).select("*", span("y", F.lit(degrees)).alias("j"))
    placed = targets.select(F.col("x").alias("tx"), F.col("y").alias("ty"), F.floor(F.col("x") / degrees).alias("i"), F.floor(F.col("y") / degrees).alias("j")).distinct()
    d = F.sqrt((F.col("ty") - F.col("y")) ** 2 + ((F.col("tx") - F.col("x")) * F.cos(F.radians("y"))) ** 2)
    hits = each.join(placed, ["i", "j"]).filter(d < degrees).select("pid").distinct()
    return points.join(hits, "pid", "left_semi")

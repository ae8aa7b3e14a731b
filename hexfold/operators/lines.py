"""Lines against hexes: every segment is cut by the three pairs of parallel sides of each hex it may meet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hexfold.functions import geo

# fixed values: unit normals of the three pairs of sides, with the edges towards and against the normal
SIDES = ((3**0.5 / 2, 0.5, 0, 3), (0.0, 1.0, 1, 4), (-(3**0.5) / 2, 0.5, 2, 5))


def segments(points: DataFrame, line: str = "k", order: str = "seq") -> DataFrame:
    """line, x1, y1, x2, y2 of consecutive points (x, y) of each line."""
    w = W.partitionBy(line).orderBy(order)
    return points.select(line, F.col("x").alias("x1"), F.col("y").alias("y1"), F.lead("x").over(w).alias("x2"), F.lead("y").over(w).alias("y2")).filter("x2 is not null")


def _column_range(low: Column, high: Column, pitch: float, reach: float) -> Column:
    return F.explode(F.sequence(F.ceil((low - reach) / pitch).cast("int"), F.floor((high + reach) / pitch).cast("int")))


def clip(parts: DataFrame, size: float) -> DataFrame:
    """``parts`` (segments in the plane) with q, r, metres, enter and leave for every hex that a segment runs through.

    Hexes that a segment only touches are left out, and so are segments
    without length.  ``enter`` and ``leave`` are the edges crossed, null where
    the segment begins or ends inside; through a corner, the lower edge counts.
    Candidates are found by column of hexes, so they grow with a segment's length.
    """
    R, half = geo.radius(size), size / 2
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    dx, dy = x2 - x1, y2 - y1
    columns = parts.withColumn("q", _column_range(F.least(x1, x2), F.greatest(x1, x2), 1.5 * R, R))
    # heights of the part of the segment over its column of hexes
    at = lambda x: F.when(dx != 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - x1) / dx)))
    west, east = F.coalesce(y1 + dy * at(F.col("q") * 1.5 * R - R), y1), F.coalesce(y1 + dy * at(F.col("q") * 1.5 * R + R), y2)
    columns = columns.withColumns({"_a": F.least(west, east), "_b": F.greatest(west, east)})
    up = F.pmod("q", F.lit(2)) * 0.5 * size
    each = columns.withColumn("r", _column_range(F.col("_a") - up, F.col("_b") - up, size, half)).drop("_a", "_b")
    cx, cy = geo.centre(F.col("q"), F.col("r"), size)
    enter, leave = [F.struct(F.lit(0.0).alias("t"), F.lit(1).alias("o"), F.lit(None).cast("int").alias("e"))], [F.struct(F.lit(1.0).alias("t"), F.lit(-1).alias("o"), F.lit(None).cast("int").alias("e"))]
    for nx, ny, ahead, behind in SIDES:
        u, v = (x1 - cx) * nx + (y1 - cy) * ny, dx * nx + dy * ny
        near, far = (-half - u) / F.nullif(v, F.lit(0.0)), (half - u) / F.nullif(v, F.lit(0.0))
        side = lambda t, e: F.struct(t.alias("t"), (-e).alias("o"), e.cast("int").alias("e"))
        outside = F.struct(F.lit(2.0).alias("t"), F.lit(0).alias("o"), F.lit(None).cast("int").alias("e"))
        parallel = F.when(F.abs(u) >= half, outside)
        enter.append(F.when(v > 0, side(near, F.lit(behind))).when(v < 0, side(far, F.lit(ahead))).otherwise(parallel))
        # of equal ends the least struct has the least edge
        last = lambda t, e: F.struct(t.alias("t"), e.alias("o"), e.cast("int").alias("e"))
        leave.append(F.when(v > 0, last(far, F.lit(ahead))).when(v < 0, last(near, F.lit(behind))))
    each = each.withColumns({"_in": F.greatest(*enter), "_out": F.least(*leave)}).filter((F.col("_in.t") < F.col("_out.t")) & (F.hypot(dx, dy) > 0))
    run = (F.col("_out.t") - F.col("_in.t")) * F.hypot(dx, dy)
    return each.select(*parts.columns, "q", "r", run.alias("metres"), F.col("_in.e").alias("enter"), F.col("_out.e").alias("leave"))


def best_level(clipped: DataFrame, level: str, order: list[str]) -> DataFrame:
    """q, r and the level that comes first in ``order`` among the lines through each hex; other levels count as none."""
    rank = reduce(lambda c, x: c.when(F.col(level) == x[1], x[0]), enumerate(order), F.when(F.col(level).isNull(), None))
    best = clipped.withColumn("_rank", rank).filter("_rank is not null").groupBy("q", "r").agg(F.min("_rank").alias("_rank"))
    return best.select("q", "r", F.array(*map(F.lit, order))[F.col("_rank")].alias(level))


def rivers_of_hexes(clipped: DataFrame, line: str = "k", name: str = "name") -> DataFrame:
    """q, r, river_name, river_edges: name of the line with the longest run in each hex, and all edges crossed.

    Of equal runs (to a millimetre) the least name counts; lines without a
    name give edges only, and a hex of such lines has an empty name.
    """
    # the edges of a row as bits of a number, so that groups hold numbers and no sets
    bit = lambda e: F.coalesce(F.call_function("shiftleft", F.lit(1), F.col(e)), F.lit(0))
    runs = clipped.groupBy("q", "r", line).agg(F.round(F.sum("metres"), 3).alias("m"), F.min(name).alias("name"), F.bit_or(bit("enter").bitwiseOR(bit("leave"))).alias("edges"))
    best = F.min(F.when(F.coalesce("name", F.lit("")) != "", F.struct((-F.col("m")).alias("m"), "name")))
    hexes = runs.groupBy("q", "r").agg(best.alias("best"), F.bit_or("edges").alias("edges"))
    crossed = F.array_compact(F.array(*[F.when(F.col("edges").bitwiseAND(F.lit(1 << i)) != 0, F.lit(i)) for i in range(6)]))
    return hexes.select("q", "r", F.coalesce("best.name", F.lit("")).alias("river_name"), crossed.alias("river_edges"))


def ranked_rivers(ways: DataFrame, most: int) -> DataFrame:
    """Named ways of a scalerank up to ``most``."""
    return ways.filter((F.col("scalerank") <= most) & (F.trim("name") != ""))


def selected_waterways(layer: DataFrame, parts: DataFrame, most: int, least: float) -> DataFrame:
    """The rivers of ``layer`` (osm_id, waterway_type, name, scalerank ...) of a scalerank up to ``most``, and the canals of long names.

    ``parts``: their segments (osm_id, x1, y1, x2, y2) in metres, of which
    those of canals are enough; the canals of one name add up, each way once,
    to more than ``least``.
    """
    canals = layer.filter("waterway_type = 'canal'").dropDuplicates(["osm_id"])
    metres = parts.groupBy("osm_id").agg(F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))).alias("metres")).join(canals.select("osm_id", "name"), "osm_id")
    long = metres.groupBy("name").agg(F.sum("metres").alias("metres")).filter(F.col("metres") > least).select("name")
    return ranked_rivers(layer.filter("waterway_type = 'river'"), most).unionByName(canals.join(long, "name", "left_semi").select(*layer.columns))


def shore_hexes(outlines: DataFrame, size: float) -> DataFrame:
    """q, r of hexes that an outline runs through: they meet what it bounds and are not inside it."""
    return clip(outlines, size).select("q", "r").distinct()

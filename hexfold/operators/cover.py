"""Outlines as adaptive quadtrees: cells inside, and cells on the border with their own segments.

Cells are numbered (level, i, j); one of level l has sides of 2**-l.  A feature
starts in the few cells that its envelope meets, cells with more segments than
``CAPACITY`` are split, and what a split leaves without segments is inside or
outside as a whole.  So a feature has cells in proportion to its outline, not
to its area, and no cell has many segments but where many meet in a point.

Every cell has an anchor and the anchor's parity (1: inside).  A point in the
cell has the same parity if the way to it, along x = anchor and then along
y = point, crosses an even number of segments; all of the way is in the cell,
so the cell's own segments decide.  Both parts of the way use the half-open
rules of a ray to the east, so results are those of ``geo.crosses`` over all
segments of a closed outline.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexfold.operators.scratch import written

CAPACITY = 64  #: segments of a cell, and of a list
STEP = 2  #: levels of a split: four by four cells
DEPTH = 16  #: levels below a feature's first cells at which cells are split no further
DEEPEST = 40  #: the level of the first cells of a feature without extent
ACROSS, UP = 0.3819660112501051, 0.6180339887498949  #: place of the anchor in its cell, on no round coordinate
ENDS = ("x1", "y1", "x2", "y2")
BOX = ("bx0", "by0", "bx1", "by1")


def side(level: Column) -> Column:
    return F.pow(F.lit(2.0), -level)


def number(at: Column, level: Column) -> Column:
    return F.floor(at * F.pow(F.lit(2.0), level))


def anchor(level: Column, i: Column, j: Column) -> tuple[Column, Column]:
    return (i + ACROSS) * side(level), (j + UP) * side(level)


def crossed(ax: Column, ay: Column, x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """1 where the way from (ax, ay) along x = ax and then y = y to (x, y) crosses the segment once, else 0."""
    height = y1 + (ax - x1) * (y2 - y1) / (x2 - x1)
    upright = F.when((x1 > ax) != (x2 > ax), ((height <= y) != (height <= ay)).cast("int")).otherwise(0)
    at = (x2 - x1) * (y - y1) / (y2 - y1) + x1
    level = F.when((y1 > y) != (y2 > y), ((ax < at) != (x < at)).cast("int")).otherwise(0)
    return (upright + level) % 2


def touches(level: Column, i: Column, j: Column) -> Column:
    """The segment x1, y1, x2, y2 meets the cell, or all but does."""
    x1, y1, x2, y2 = map(F.col, ENDS)
    a, b, c, d = i * side(level), j * side(level), (i + 1) * side(level), (j + 1) * side(level)
    near = (F.least(x1, x2) <= c) & (F.greatest(x1, x2) >= a) & (F.least(y1, y2) <= d) & (F.greatest(y1, y2) >= b)
    off = [(x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) for x in (a, c) for y in (b, d)]
    slack = (F.abs(x2 - x1) + F.abs(y2 - y1)) * (1 + F.abs(x1) + F.abs(y1)) * 1e-12
    return near & (F.least(*off) <= slack) & (F.greatest(*off) >= -slack)


def _boxes(segments: DataFrame, keys: list[str]) -> DataFrame:
    """Envelopes of features, the level whose cells are half as wide at least, and how many segments they have."""
    lo, hi = lambda a, b: F.min(F.least(a, b)), lambda a, b: F.max(F.greatest(a, b))
    boxes = segments.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), lo("x1", "x2").alias("bx0"), lo("y1", "y2").alias("by0"), hi("x1", "x2").alias("bx1"), hi("y1", "y2").alias("by1"))
    wide = F.greatest(F.col("bx1") - F.col("bx0"), F.col("by1") - F.col("by0"), F.lit(2.0**-DEEPEST))
    return boxes.withColumn("level", F.least(F.floor(F.log2(2 / wide)), F.lit(DEEPEST)).cast("int"))


def _roots(boxes: DataFrame) -> DataFrame:
    over = lambda a, b: F.explode(F.sequence(number(F.col(a), F.col("level")), number(F.col(b), F.col("level"))))
    return boxes.select("*", over("bx0", "bx1").alias("i")).select("*", over("by0", "by1").alias("j"))


def _ray(ax: Column, ay: Column, s) -> Column:
    return (((s("y1") > ay) != (s("y2") > ay)) & (ax < (s("x2") - s("x1")) * (ay - s("y1")) / (s("y2") - s("y1")) + s("x1"))).cast("int")


def _whole(segments: DataFrame, boxes: DataFrame, keys: list[str]) -> DataFrame:
    """Cells of features with up to ``CAPACITY`` segments: their roots, each with all of them."""
    lists = segments.join(boxes.select(*keys), keys, "left_semi").groupBy(*keys).agg(F.collect_list(F.struct(*ENDS)).alias("segments"))
    cells = _roots(lists.join(boxes, keys))
    ax, ay = anchor(F.col("level"), F.col("i"), F.col("j"))
    inside = F.aggregate("segments", F.lit(0), lambda n, s: n + _ray(F.col("ax"), F.col("ay"), lambda c: s[c])) % 2
    cells = cells.withColumns({"ax": ax, "ay": ay}).withColumn("inside", inside)
    return cells.select(*keys, "level", "i", "j", "inside", "segments", F.lit(1).alias("lists"), F.lit(0).alias("list"), *BOX)


def _split(segments: DataFrame, boxes: DataFrame, keys: list[str], capacity: int) -> list[DataFrame]:
    """Cells of the other features, level by level."""
    cell, c = [*keys, "level", "i", "j"], F.col
    ax, ay = anchor(c("level"), c("i"), c("j"))
    rooted = segments.join(_roots(boxes).select(*cell), keys)
    inside = rooted.groupBy(*cell).agg((F.sum(_ray(ax, ay, c)) % 2).cast("int").alias("inside"))
    inside = written(inside, "anchors")
    active = written(rooted.filter(touches(c("level"), c("i"), c("j"))).join(inside, cell), "cells")
    made = [inside.join(active.select(*cell).distinct(), cell, "left_anti")]
    made = [made[0].filter("inside = 1").select(*cell, "inside", F.array().cast(active.select(F.array(F.struct(*ENDS))).schema[0].dataType).alias("segments"), F.lit(1).alias("lists"), F.lit(0).alias("list"))]
    depth = 0
    while True:
        counts = written(active.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")), "counts")
        more = (c("n") > capacity) & F.lit(depth < DEPTH)
        kept = active.join(counts.filter(~more), cell).withColumn("lists", F.ceil(c("n") / capacity).cast("int"))
        kept = kept.withColumn("list", F.pmod(F.xxhash64(*ENDS), c("lists")).cast("int"))
        made.append(kept.groupBy(*cell, "inside", "lists", "list").agg(F.collect_list(F.struct(*ENDS)).alias("segments")).select(*cell, "inside", "segments", "lists", "list"))
        full = counts.filter(more)
        if full.isEmpty():
            return made
        depth += STEP
        parents = active.join(full.select(*cell), cell, "left_semi")
        # a row for each of a segment's four by four children
        spot = F.explode(F.sequence(F.lit(0), F.lit((1 << 2 * STEP) - 1)))
        each = parents.select("*", ax.alias("ax"), ay.alias("ay"), spot.alias("_k")).withColumn("level", (c("level") + STEP).cast("int"))
        each = each.withColumns({"i": c("i") * (1 << STEP) + (c("_k") % (1 << STEP)), "j": c("j") * (1 << STEP) + F.shiftright("_k", STEP)})
        way = crossed(c("ax"), c("ay"), *anchor(c("level"), c("i"), c("j")), *map(c, ENDS))
        kids = written(each.groupBy(*cell, "inside").agg(F.sum(way).alias("n")).select(*cell, ((c("inside") + c("n")) % 2).cast("int").alias("inside")), "anchors")
        sent = each.filter(touches(c("level"), c("i"), c("j"))).select(*cell, *ENDS)
        active = written(sent.join(kids, cell), "cells")
        empty = kids.filter("inside = 1").join(active.select(*cell).distinct(), cell, "left_anti")
        made.append(empty.select(*cell, "inside", F.array().cast(made[0].schema["segments"].dataType).alias("segments"), F.lit(1).alias("lists"), F.lit(0).alias("list")))


def cover(segments: DataFrame, same: str | None = None, capacity: int = CAPACITY) -> tuple[DataFrame, list[int], bool]:
    """Cells (fid, level, i, j, inside, segments, lists, list, bx0, by0, bx1, by1) of outlines (fid, x1, y1, x2, y2), the levels in use, and whether a cell has several lists.

    A cell's segments are one list, or where many meet in a point ``lists`` of
    them.  A feature that is not split has its envelope in every cell.
    Outlines are closed; segments without a coordinate are left out.
    """
    keys = ["fid", *([same] if same else [])]
    known = segments.select(*keys, *[F.col(e).cast("double").alias(e) for e in ENDS]).filter(" and ".join(f"{e} is not null and not isnan({e})" for e in ENDS))
    boxes = _boxes(known, keys)
    levels = sorted((r["level"], r["most"]) for r in boxes.groupBy("level").agg(F.max("n").alias("most")).collect())
    if all(most <= capacity for _, most in levels):
        return _whole(known, boxes, keys), [level for level, _ in levels], False
    boxes = written(boxes, "boxes")
    split = [c.withColumns({b: F.lit(None).cast("double") for b in BOX}) for c in _split(known, boxes.filter(F.col("n") > capacity), keys, capacity)]
    cells = reduce(DataFrame.union, [_whole(known, boxes.filter(F.col("n") <= capacity), keys), *split])
    cells = written(cells, "cover")
    used = cells.groupBy("level").agg(F.max("lists").alias("lists")).collect()
    return cells, sorted(r["level"] for r in used), any(r["lists"] > 1 for r in used)


def point_in_polygon(points: DataFrame, segments: DataFrame, same: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """pid, fid of points (pid, x, y) inside the even-odd bag of ring segments of a feature.

    A point asks for its cell of every level in use, meets the features that
    have it, and if it is in their envelope crosses the segments of that cell
    alone; with ``same``, a
    column of both sides, only features that agree in it.  Points without a
    coordinate (null or no number) are in nothing.
    """
    cells, levels, several = cover(segments, same, capacity)
    at = points.filter("x is not null and y is not null and not isnan(x) and not isnan(y)").select("pid", "x", "y", *([same] if same else []), F.explode(F.array(*map(F.lit, levels)).cast("array<int>")).alias("level"))
    at = at.withColumns({"i": number(F.col("x"), F.col("level")), "j": number(F.col("y"), F.col("level"))})
    ax, ay = anchor(F.col("level"), F.col("i"), F.col("j"))
    hits = at.join(cells, ["level", "i", "j", *([same] if same else [])])
    slack = lambda v: (1 + F.abs(F.col(v))) * 1e-12
    off = reduce(Column.__or__, [(F.col(v) < F.col(f"b{v}0") - slack(v)) | (F.col(v) > F.col(f"b{v}1") + slack(v)) for v in ("x", "y")])
    hits = hits.filter(~F.coalesce(off, F.lit(False))).withColumns({"ax": ax, "ay": ay})
    start = F.when(F.col("list") == 0, F.col("inside")).otherwise(0)
    odd = F.aggregate("segments", start, lambda n, s: n + crossed(F.col("ax"), F.col("ay"), F.col("x"), F.col("y"), *[s[e] for e in ENDS])) % 2
    hits = hits.select("pid", "fid", "lists", odd.alias("odd"))
    one = hits.filter("lists = 1 and odd = 1").select("pid", "fid")
    if not several:
        return one
    return one.union(hits.filter("lists > 1").groupBy("pid", "fid").agg(F.sum("odd").alias("odd")).filter("odd % 2 = 1").select("pid", "fid"))

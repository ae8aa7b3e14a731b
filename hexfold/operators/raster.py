"""Raster operators on blocks: one row holds a square of pixels as an array.

``blocks`` makes them from a table of pixels (px_row, px_col, elev) and
``store`` keeps them as a table that is partitioned by tile and bucketed by
block.  A stencil reads its own block from its bucket, where it lies, and is
sent the strips of its four neighbours that it can reach: only borders are
shuffled.  In a block's ``pixels`` a void is null and a pixel that the raster
does not have is NaN; results have a value, or null, for the raster's own pixels.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexfold.operators.scratch import new_folder, new_table, written

VOID = -32768  #: fixed value: missing elevation
BLOCK = 128  #: pixels on a side of a block
TILE = 16  #: blocks on a side of a tile, the partition of a stored raster
BUCKETS = 16
SHARE = 1 << 20  #: pixels that the windows of one copy of a block take from it, about
PASS = 16  #: blocks that one numpy pass works on
KEYS = ["block_row", "block_col"]
SIDES = ("west", "east", "north", "south")
PART = 0.9  #: fixed value: the percentile of zones


def mask_void(dem: DataFrame) -> DataFrame:
    return dem.withColumn("elev", F.nullif(F.col("elev").cast("double"), F.lit(float(VOID))))


def blocks(dem: DataFrame, block: int = BLOCK) -> DataFrame:
    """block_row, block_col, size, pixels of a table of pixels; a pixel given twice is its highest, one that is no number void."""
    at = lambda c: F.floor(F.col(c) / block).cast("int")
    place = F.pmod("px_row", F.lit(block)) * block + F.pmod("px_col", F.lit(block))
    known = F.when(F.col("elev").isNotNull() & ~F.isnan("elev"), F.col("elev"))
    rows = mask_void(dem).select(at("px_row").alias("block_row"), at("px_col").alias("block_col"), place.cast("int").alias("place"), known.alias("elev"))

    def fill(table: pa.Table) -> pa.Table:
        place, elev = table.column("place").to_numpy(), table.column("elev").to_numpy().astype(float)
        pixels, there = np.full(block * block, -np.inf), np.zeros(block * block, bool)
        there[place] = True
        np.maximum.at(pixels, place, np.where(np.isnan(elev), -np.inf, elev))
        return pa.table([*[table.column(k)[:1] for k in KEYS], pa.array([block], pa.int32()), _lists(np.where(np.isinf(pixels), np.nan, pixels)[None], there[None])], names=[*KEYS, "size", "pixels"])

    return rows.groupBy(*KEYS).applyInArrow(fill, "block_row int, block_col int, size int, pixels array<double>")


def store(made: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The blocks as a table partitioned by tile (tile_row, tile_col) and bucketed by block."""
    spark = made.sparkSession
    name = new_table("raster")
    tiled = made.withColumns({f"tile_{x}": F.floor(F.col(f"block_{x}") / TILE).cast("int") for x in ("row", "col")})
    spread = tiled.repartition(buckets, *KEYS)  # as buckets are dealt: one file for each of a tile's
    spread.write.format("parquet").option("path", new_folder(spark, "raster")).partitionBy("tile_row", "tile_col").bucketBy(buckets, *KEYS).saveAsTable(name)
    return spark.table(name)


def _lists(values: np.ndarray, there: np.ndarray) -> pa.Array:
    """Rows of values as lists: NaN is null where the raster has the pixel, else NaN."""
    flat, has = values.ravel(), there.ravel()
    made = pa.array(np.where(has, flat, np.nan), mask=np.isnan(flat) & has)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * (values.size // max(len(values), 1))), made)


def _arrays(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Values (NaN: void or none) and which pixels there are, as (rows, size, size)."""
    flat = column.flatten()
    values, valid = flat.to_numpy(zero_copy_only=False), flat.is_valid().to_numpy(zero_copy_only=False)
    return values.reshape(-1, size, size), (~(valid & np.isnan(values))).reshape(-1, size, size)


def _passes(batches):
    """The rows of batches, few at a time: a batch may hold hundreds of blocks, and each step of a pass as many arrays."""
    for batch in batches:
        for at in range(0, batch.num_rows, PASS):
            yield batch.slice(at, PASS)


def strips(stored: DataFrame, k: int) -> DataFrame:
    """block_row, block_col and, for each side, the strip of ``k`` pixels that the neighbour there has along it."""
    source = stored.select(*KEYS, "size", "pixels")

    def cut(batches):
        for batch in _passes(batches):
            size = batch.column("size")[0].as_py()
            values, there = _arrays(batch.column("pixels"), size)
            row, col = (batch.column(c).to_numpy() for c in KEYS)
            for side, dr, dc, part in (("west", 0, 1, np.s_[:, :, -k:]), ("east", 0, -1, np.s_[:, :, :k]), ("north", 1, 0, np.s_[:, -k:, :]), ("south", -1, 0, np.s_[:, :k, :])):
                v, t = (np.ascontiguousarray(x[part]).reshape(len(row), -1) for x in (values, there))
                yield pa.RecordBatch.from_arrays([pa.array(row + np.int32(dr)), pa.array(col + np.int32(dc)), pa.array([side] * len(row)), _lists(v, t)], names=[*KEYS, "side", "strip"])

    sent = source.mapInArrow(cut, "block_row int, block_col int, side string, strip array<double>")
    # dealt as the buckets are, so that the join moves them no further
    return sent.repartition(BUCKETS, *KEYS).groupBy(*KEYS).agg(*[F.first(F.when(F.col("side") == s, F.col("strip")), ignorenulls=True).alias(s) for s in SIDES])


def stencil(stored: DataFrame, k: int, value) -> DataFrame:
    """block_row, block_col, size, pixels: what ``value`` makes of elevations and those ``k`` pixels to the west, east, north and south.

    ``value`` takes five arrays (rows, size, size), NaN where there is none,
    and the pixel rows' numbers (rows, size, 1).
    """
    own = stored.select(*KEYS, "size", "pixels")
    both = own.join(strips(stored, k), KEYS, "left")

    def run(batches):
        for batch in _passes(batches):
            size = batch.column("size")[0].as_py()
            if k > size:
                raise ValueError(f"a stencil of {k} pixels reaches over blocks of {size}")
            mid, there = _arrays(batch.column("pixels"), size)
            wide = np.full((len(mid), size + 2 * k, size + 2 * k), np.nan)
            wide[:, k : k + size, k : k + size] = mid
            for side, part, shape in (("west", np.s_[k : k + size, :k], (size, k)), ("east", np.s_[k : k + size, k + size :], (size, k)), ("north", np.s_[:k, k : k + size], (k, size)), ("south", np.s_[k + size :, k : k + size], (k, size))):
                column = batch.column(side)
                has = column.is_valid().to_numpy(zero_copy_only=False)
                wide[(has, *part)] = column.filter(pa.array(has)).flatten().to_numpy(zero_copy_only=False).reshape(-1, *shape)
            at = lambda r, c: wide[:, k + r : k + r + size, k + c : k + c + size]  # noqa: B023, E731
            rows = batch.column("block_row").to_numpy().astype(np.int64)[:, None, None] * size + np.arange(size)[None, :, None]
            with np.errstate(invalid="ignore"):
                made = value(mid, at(0, -k), at(0, k), at(-k, 0), at(k, 0), rows)
            yield pa.RecordBatch.from_arrays([batch.column("block_row"), batch.column("block_col"), batch.column("size"), _lists(made.reshape(len(mid), -1), there.reshape(len(mid), -1))], names=[*KEYS, "size", "pixels"])

    return both.mapInArrow(run, "block_row int, block_col int, size int, pixels array<double>")


def pixels(made: DataFrame, name: str) -> DataFrame:
    """px_row, px_col and the value of every pixel of the raster."""
    each = made.select(*KEYS, "size", F.posexplode("pixels").alias("p", name)).filter(F.col(name).isNull() | ~F.isnan(name))
    row = F.col("block_row") * F.col("size") + F.floor(F.col("p") / F.col("size")).cast("int")
    return each.select(row.alias("px_row"), (F.col("block_col") * F.col("size") + F.col("p") % F.col("size")).alias("px_col"), name)


def slope_deg(stored: DataFrame, step_x: float, step_y: float, top: float, scale_m: float = 90.0) -> DataFrame:
    """Blocks of slopes in degrees, by central differences over k pixels; null in the outer k and beside voids.

    ``step_x``, ``step_y``: degrees a pixel; ``top``: latitude of the upper edge.
    """
    k = max(1, round(scale_m / (abs(step_y) * 111_320)))

    def slope(mid, west, east, north, south, rows):
        lat = top - (rows + 0.5) * abs(step_y)
        dx = (east - west) / (2 * k * step_x * 111_320 * np.cos(np.radians(lat)))
        dy = (south - north) / (2 * k * abs(step_y) * 111_320)
        return np.degrees(np.arctan(np.hypot(dx, dy)))

    return stencil(stored, k, slope)


def _pixel(points: DataFrame, left: float, top: float, step_x: float, step_y: float) -> DataFrame:
    return points.withColumns({"_col": F.rint((F.col("x") - left) / step_x).cast("long"), "_row": F.rint((F.lit(top) - F.col("y")) / abs(step_y)).cast("long")})


def sample(points: DataFrame, stored: DataFrame, left: float, top: float, step_x: float, step_y: float, block: int = BLOCK) -> DataFrame:
    """``points`` (x, y) with elev of the rounded pixel; void and outside are 0."""
    at = _pixel(points, left, top, step_x, step_y)
    at = at.withColumns({"block_row": F.floor(F.col("_row") / block).cast("int"), "block_col": F.floor(F.col("_col") / block).cast("int")})
    at = at.withColumn("_place", (F.pmod("_row", F.lit(block)) * block + F.pmod("_col", F.lit(block))).cast("int"))
    elev = F.get("pixels", F.col("_place"))
    found = at.join(stored.select(*KEYS, "pixels"), KEYS, "left")
    return found.withColumn("elev", F.when(elev.isNotNull() & ~F.isnan(elev), elev).otherwise(0.0)).drop("_row", "_col", "_place", "pixels", *KEYS)


def hillshade(stored: DataFrame, azimuth: float = 315.0, altitude: float = 45.0, exaggeration: float = 2.0) -> DataFrame:
    """Blocks of shade from 0 to 1, stretched over the raster; 0.5 where the raster is flat, null on voids."""
    a, h = math.radians(90 - azimuth), math.radians(altitude)
    light = (math.cos(a) * math.cos(h), math.sin(a) * math.cos(h), math.sin(h))

    def lit(mid, west, east, north, south, rows):
        at = lambda side: np.where(np.isnan(side), mid, side)
        gx, gy = (at(east) - at(west)) / 2 * exaggeration, (at(north) - at(south)) / 2 * exaggeration
        return np.where(np.isnan(mid), np.nan, (light[2] - gx * light[0] - gy * light[1]) / np.sqrt(1 + gx * gx + gy * gy))

    made = written(stencil(stored, 1, lit), "light")
    known = F.filter("pixels", lambda v: v.isNotNull() & ~F.isnan(v))
    low, high = made.agg(F.min(F.array_min(known))).scalar(), made.agg(F.max(F.array_max(known))).scalar()
    made = made.withColumns({"_low": low, "_high": high})
    shade = lambda v: F.when(v.isNull() | F.isnan(v), v).when(F.col("_high") > F.col("_low"), (v - F.col("_low")) / (F.col("_high") - F.col("_low"))).otherwise(0.5)
    return made.select(*KEYS, "size", F.transform("pixels", shade).alias("pixels"))


def window(stored: DataFrame, box: tuple[float, float, float, float], left: float, top: float, step_x: float, step_y: float, block: int = BLOCK) -> tuple[DataFrame, float, float]:
    """The pixels (px_row, px_col, elev) of a lon/lat box, renumbered, and the window's left and top; only its tiles are read."""
    x0, y0, x1, y1 = box
    c0, c1 = math.floor((x0 - left) / step_x), math.ceil((x1 - left) / step_x) - 1
    r0, r1 = math.floor((top - y1) / abs(step_y)), math.ceil((top - y0) / abs(step_y)) - 1
    side = block * TILE
    near = F.col("tile_col").between(c0 // side, c1 // side) & F.col("tile_row").between(r0 // side, r1 // side)
    near &= F.col("block_col").between(c0 // block, c1 // block) & F.col("block_row").between(r0 // block, r1 // block)
    held = pixels(stored.filter(near), "elev").filter(F.col("px_col").between(c0, c1) & F.col("px_row").between(r0, r1))
    c0, r0 = max(c0, 0), max(r0, 0)
    return held.select((F.col("px_row") - r0).alias("px_row"), (F.col("px_col") - c0).alias("px_col"), "elev"), left + c0 * step_x, top - r0 * abs(step_y)


def zonal_p90(boxes: DataFrame, slopes: DataFrame, left: float, top: float, step_x: float, step_y: float, block: int = BLOCK) -> DataFrame:
    """zid, p90 of the slopes (blocks) in each box (zid, x0, y0, x1, y1); 0 where there is none.

    The window is floor to ceil of the box in pixels, ends included; the
    percentile is exact and interpolated.  Boxes with one window ask once: it
    is sent to the blocks that it meets.  A block is there once for every
    ``SHARE`` pixels that are asked of it, and meets its windows in a group:
    joined to them, it would be written, and held, once a window.
    """
    down = abs(step_y)
    frame = boxes.select(
        "zid",
        F.floor((F.col("x0") - left) / step_x).alias("c0"),
        F.ceil((F.col("x1") - left) / step_x).alias("c1"),
        F.floor((F.lit(top) - F.col("y1")) / down).alias("r0"),
        F.ceil((F.lit(top) - F.col("y0")) / down).alias("r1"),
    )
    over = lambda low, high: F.explode(F.sequence(F.floor(F.col(low) / block), F.floor(F.col(high) / block)).cast("array<int>"))
    window = ["c0", "c1", "r0", "r1"]
    asked = written(frame.select(*window).filter("c0 <= c1 and r0 <= r1").distinct(), "windows")
    each = asked.select("*", over("c0", "c1").alias("block_col")).select("*", over("r0", "r1").alias("block_row"))
    inside: dict[str, Column] = {}
    for axis, at in (("r", "block_row"), ("c", "block_col")):
        inside |= {f"{axis}a": F.greatest(F.col(f"{axis}0") - F.col(at) * block, F.lit(0)), f"{axis}b": F.least(F.col(f"{axis}1") - F.col(at) * block, F.lit(block - 1))}
    each = each.withColumns(inside)
    taken = (F.col("rb") - F.col("ra") + 1) * (F.col("cb") - F.col("ca") + 1) + 32  # a window alone has its weight too
    shares = each.groupBy(*KEYS).agg(F.ceil(F.sum(taken) / SHARE).cast("int").alias("_shares"))
    met = slopes.select(*KEYS, "pixels").join(shares.select(*KEYS), KEYS, "left_semi")
    # merged, blocks to the right: a broadcast of the shares would hold all copies of a block at once
    copies = shares.select(*KEYS, F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)).alias("_share")).join(met.hint("merge"), KEYS)
    share = F.pmod(F.xxhash64(*window), F.col("_shares")).cast("int").alias("_share")
    each = each.join(shares, KEYS).select(*window, *inside, F.col("block_row").alias("_row"), F.col("block_col").alias("_col"), share)

    def cut(asked: pa.Table, met: pa.Table) -> pa.Table:
        asked = asked if met.num_rows else asked.slice(0, 0)
        values = _arrays(met.column("pixels").combine_chunks(), block)[0].reshape(-1, block)
        c0, c1, r0, r1 = (asked.column(c).to_numpy().astype(float) for c in window)
        most = _most((c1 - c0 + 1) * (r1 - r0 + 1))
        counts, tops = np.zeros(len(most), np.int64), [np.zeros(0)]
        for i, (ra, rb, ca, cb, k) in enumerate(zip(*(asked.column(c).to_numpy() for c in ("ra", "rb", "ca", "cb")), most, strict=True)):
            part = values[ra : rb + 1, ca : cb + 1]
            part = part[~np.isnan(part)]
            counts[i] = n = len(part)
            tops.append(np.partition(part, n - int(k))[n - int(k) :] if k < n else part)
        ends = np.cumsum([len(t) for t in tops]).astype(np.int32)
        return pa.table([*(asked.column(c) for c in window), pa.array(counts), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(tops)))], names=[*window, "n", "top"])

    pieces = each.groupBy("_row", "_col", "_share").cogroup(copies.groupBy(*KEYS, "_share")).applyInArrow(cut, "c0 long, c1 long, r0 long, r1 long, n long, top array<double>")
    held = pieces.filter("n > 0").groupBy(*window).agg(F.sum("n").alias("n"), F.sort_array(F.flatten(F.collect_list("top"))).alias("top"))
    place = (F.col("n") - 1) * PART
    low, high = F.floor(place), F.ceil(place)
    value = lambda rank: F.element_at("top", (rank - F.col("n")).cast("int"))
    between = (high - place) * value(low) + (place - low) * value(high)
    p90 = held.select(*window, F.when((low == high) | (value(low) == value(high)), value(low)).otherwise(between).alias("p90"))
    return frame.join(p90, window, "left").select("zid", F.coalesce("p90", F.lit(0.0)).alias("p90"))


def _most(area: np.ndarray) -> np.ndarray:
    """The number of greatest values of a window of ``area`` pixels, and so of each of its parts, that its percentile can be between."""
    return area - np.floor(PART * (area - 1)) + 1

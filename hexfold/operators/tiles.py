"""Passes over neighbours, tile by tile: the same as over the whole map.

``islands`` sends every hex to its own tile and, as margin, to tiles within
reach, and moves each tile's hexes apart from all others by whole columns.
Operators that know hexes by neighbours and distances then treat all tiles in
one job as maps of their own, and ``home`` takes what each tile says of its own
hexes.  That is right for what a hex's surroundings within reach decide; chains
have no reach, and are found in two levels instead.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexfold.functions import geo
from hexfold.operators import hexes as plain
from hexfold.operators.scratch import written


def tile_of(at: Column, side: int) -> Column:
    return F.floor(at / side).cast("long")


def islands(hexes: DataFrame, side: int, reach: int) -> DataFrame:
    """``hexes`` with q and r as in a map where every tile is apart, _q and _r (their own) and _own (not of the margin).

    Tiles are ``side`` (even) columns and rows; the margin is ``reach`` of each.
    """
    if side % 2:
        raise ValueError("a tile has an even number of columns, so that parity stays")
    over = lambda c: F.explode(F.sequence(tile_of(F.col(c) - reach, side), tile_of(F.col(c) + reach, side)))
    q0, r0, r1 = hexes.agg(F.min(tile_of(F.col("q"), side)), F.min(tile_of(F.col("r"), side)), F.max(tile_of(F.col("r"), side))).first()
    q0, r0, rows = (q0 or 0) - 1, (r0 or 0) - 1, (r1 or 0) - (r0 or 0) + 3  # tiles of the margin too
    wide = side + 2 * (reach // 2 * 2 + 2)
    sent = hexes.withColumnsRenamed({"q": "_q", "r": "_r"}).withColumns({"q": F.col("_q"), "r": F.col("_r")})
    sent = sent.select("*", over("q").alias("_tq")).select("*", over("r").alias("_tr"))
    number = (F.col("_tq") - q0) * rows + (F.col("_tr") - r0)
    own = (F.col("_tq") == tile_of(F.col("q"), side)) & (F.col("_tr") == tile_of(F.col("r"), side))
    moved = {"q": number * wide + F.col("q") - F.col("_tq") * side, "r": F.col("r") - F.col("_tr") * side, "_own": own}
    # a tile that holds margin alone has nothing to say
    lived = hexes.select(tile_of(F.col("q"), side).alias("_tq"), tile_of(F.col("r"), side).alias("_tr")).distinct()
    return sent.join(lived, ["_tq", "_tr"], "left_semi").withColumns(moved).drop("_tq", "_tr")


def home(rows: DataFrame) -> DataFrame:
    """The rows of ``islands`` that are their tile's own, where they were."""
    return rows.filter("_own").withColumns({"q": F.col("_q"), "r": F.col("_r")}).drop("_q", "_r", "_own")


def reach_of(kilometres: float, size: float) -> int:
    """Columns or rows within which all hexes of twice a distance lie: a footprint's way to a hex stays so near to it."""
    return math.ceil(2000 * kilometres / min(size, 1.5 * geo.radius(size))) + 1


def _local(group: pd.DataFrame) -> pd.DataFrame:
    """The least (q, r) of each hex's chain inside one tile."""
    cells = set(zip(group["q"], group["r"], strict=True))
    root: dict[tuple[int, int], tuple[int, int]] = {}
    for start in sorted(cells):
        if start in root:
            continue
        root[start], todo = start, [start]
        while todo:
            q, r = todo.pop()
            up = q % 2
            for at in ((q, r + 1), (q, r - 1), (q + 1, r + up), (q + 1, r + up - 1), (q - 1, r + up), (q - 1, r + up - 1)):
                if at in cells and at not in root:
                    root[at] = start
                    todo.append(at)
    return pd.DataFrame([(*at, *to) for at, to in root.items()], columns=["q", "r", "lq", "lr"])


def chains(hexes: DataFrame, side: int) -> DataFrame:
    """q, r and the least (root_q, root_r) of each hex's chain, as ``hexes.chains`` has them.

    A tile finds the chains of its own hexes, of which it has ``side`` squared
    at most.  What is left is a graph of these, with a link for each pair of
    them that touch across a seam: least labels go round in it, in rounds that
    do not depend on the hexes inside a tile.
    """
    tile = [tile_of(F.col("q"), side).alias("_tq"), tile_of(F.col("r"), side).alias("_tr")]
    cells = hexes.select(F.col("q").cast("long").alias("q"), F.col("r").cast("long").alias("r")).distinct()
    local = written(cells.groupBy(*tile).applyInPandas(_local, "q long, r long, lq long, lr long"), "chains")
    edge = lambda c: F.pmod(c, F.lit(side)).isin(0, side - 1)
    border = local.filter(edge(F.col("q")) | edge(F.col("r")))
    steps = border.select("q", "r", "lq", "lr", F.explode(geo.neighbour_steps(F.col("q"))).alias("s"))
    steps = steps.select("q", "r", "lq", "lr", (F.col("q") + F.col("s.dq")).alias("nq"), (F.col("r") + F.col("s.dr")).alias("nr"))
    seam = steps.filter((tile_of(F.col("q"), side) != tile_of(F.col("nq"), side)) | (tile_of(F.col("r"), side) != tile_of(F.col("nr"), side)))
    there = border.select(F.col("q").alias("nq"), F.col("r").alias("nr"), F.struct("lq", "lr").alias("b"))
    links = written(seam.join(there, ["nq", "nr"]).select(F.struct("lq", "lr").alias("a"), "b").distinct(), "seams")
    label = links.select(F.col("a").alias("n"), F.col("a").alias("l")).distinct()
    while True:
        near = links.join(label.select(F.col("n").alias("b"), "l"), "b").groupBy("a").agg(F.min("l").alias("m"))
        low = label.join(near, label["n"] == near["a"]).select("n", "l", F.least("l", "m").alias("m"))
        jump = label.select(F.col("n").alias("m"), F.col("l").alias("j"))
        new = written(low.join(jump, "m").select("n", F.least("m", "j").alias("l"), (F.least("m", "j") < F.col("l")).alias("moved")), "labels")
        label = new.select("n", "l")
        if new.filter("moved").isEmpty():
            break
    whole = local.join(label.select(F.col("n.lq").alias("lq"), F.col("n.lr").alias("lr"), "l"), ["lq", "lr"], "left")
    return whole.select(F.col("q").cast("int").alias("q"), F.col("r").cast("int").alias("r"), F.coalesce("l.lq", "lq").cast("int").alias("root_q"), F.coalesce("l.lr", "lr").cast("int").alias("root_r"))


def passes(hexes: DataFrame, size: float) -> DataFrame:
    """``hexes`` after coast and footprints.

    ``hexes``: q, r, water, kind, name, population, landuse, built, open,
    anthrome, population_class and a seed's radius_km, 0 for others.
    """
    h = plain.coastal(hexes)
    seeds = h.filter("radius_km > 0").select("q", "r", "radius_km")
    return plain.footprint(h, plain.sprawl(h.select("q", "r", "built", "open"), seeds, size))


def passes_by_tile(hexes: DataFrame, size: float, side: int, most_km: float = 14.0) -> DataFrame:
    """The same by tiles of ``side`` columns and rows; no radius is larger than ``most_km``."""
    return home(passes(islands(hexes, side, reach_of(most_km, size)), size))

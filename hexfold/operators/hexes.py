"""Hex grids, neighbours, and the passes over them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexfold.functions import geo
from hexfold.operators.scratch import written


def hex_grid(spark: SparkSession, box: tuple[float, float, float, float], size: float, projection: tuple | None = None) -> DataFrame:
    """q, r, col, row, cx, cy, lon, lat of the hexes whose centres lie in a lon/lat box and its margin.

    The projection is that of the box's extent unless given.
    """
    x0, y0, x1, y1 = box
    projection, R = projection or geo.select_projection(*box), geo.radius(size)
    side = [(x0 + (x1 - x0) * i / 32, y0 + (y1 - y0) * j / 32) for i in range(33) for j in range(33) if i in (0, 32) or j in (0, 32)]
    edge = geo.project(spark.createDataFrame(side, "lon double, lat double"), projection)
    a, b, c, d = edge.agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first()
    q0, q1 = math.floor((a - R) / (1.5 * R)), math.ceil((c + R) / (1.5 * R))
    q0 -= (q0 + 1) % 2  # odd, so that column and q have one parity
    r0, r1 = math.floor((b - R) / size) - 1, math.ceil((d + R) / size)
    rows = r1 - r0 + 1
    cells = spark.range((q1 - q0 + 1) * rows).select((F.floor(F.col("id") / rows) + q0).cast("int").alias("q"), (F.col("id") % rows + r0).cast("int").alias("r"))
    cx, cy = geo.centre(F.col("q"), F.col("r"), size)
    cells = geo.unproject(cells.select("q", "r", cx.alias("cx"), cy.alias("cy")), projection, "cx", "cy")
    margin = R / 111_000
    wide = margin / max(0.2, math.cos(math.radians(y1)))
    cells = cells.filter(F.col("lon").between(x0 - wide, x1 + wide) & F.col("lat").between(y0 - margin, y1 + margin))
    return cells.select("q", "r", (F.col("q") - q0 + 1).alias("col"), (F.col("r") - r0 + 1).alias("row"), "cx", "cy", "lon", "lat")


def with_hex(points: DataFrame, size: float, meridian: float, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """``points`` with x, y, q and r of the hex that holds each."""
    return geo.place_in_hex(geo.project(points, ("utm", (meridian,)), lon, lat), size)


def distances(pairs: DataFrame, hexes: DataFrame) -> DataFrame:
    """``pairs`` (q, r, nq, nr) with metres between the centres (cx, cy) of ``hexes``; infinite where one is absent."""
    a = hexes.select("q", "r", F.col("cx").alias("_ax"), F.col("cy").alias("_ay"))
    b = hexes.select(F.col("q").alias("nq"), F.col("r").alias("nr"), F.col("cx").alias("_bx"), F.col("cy").alias("_by"))
    both = pairs.join(a, ["q", "r"], "left").join(b, ["nq", "nr"], "left")
    metres = F.coalesce(F.hypot(F.col("_ax") - F.col("_bx"), F.col("_ay") - F.col("_by")), F.lit(float("inf")))
    return both.select(*pairs.columns, metres.alias("metres"))


def neighbors(hexes: DataFrame) -> DataFrame:
    """q, r, edge, nq, nr: pairs of hexes of the table that share an edge."""
    each = hexes.select("q", "r", F.explode(geo.neighbour_steps(F.col("q"))).alias("s"))
    each = each.select("q", "r", F.col("s.edge").alias("edge"), (F.col("q") + F.col("s.dq")).alias("nq"), (F.col("r") + F.col("s.dr")).alias("nr"))
    return each.join(hexes.select(F.col("q").alias("nq"), F.col("r").alias("nr")), ["nq", "nr"], "left_semi").select("q", "r", "edge", "nq", "nr")


def coastal(hexes: DataFrame) -> DataFrame:
    """``hexes`` (q, r, water) with coastal: land beside at least one water hex."""
    wet = neighbors(hexes).join(hexes.filter("water").select(F.col("q").alias("nq"), F.col("r").alias("nr")), ["nq", "nr"], "left_semi").select("q", "r").distinct()
    return hexes.join(wet.withColumn("_beside", F.lit(True)), ["q", "r"], "left").select(*hexes.columns, (~F.col("water") & F.coalesce("_beside", F.lit(False))).alias("coastal"))


def beaches(hexes: DataFrame) -> DataFrame:
    """``hexes`` (coastal, biome, landuse ...) with coastal plains of beach land use as beach; nothing else changes."""
    return hexes.withColumn("biome", F.when(F.col("coastal") & (F.col("biome") == "plains") & (F.col("landuse") == "beach"), "beach").otherwise(F.col("biome")))


def chains(hexes: DataFrame) -> DataFrame:
    """q, r and the least (root_q, root_r) reachable through neighbours of the table.

    Least labels of neighbours, then the label's own label, until none moves.
    """
    links = written(neighbors(hexes).select("q", "r", "nq", "nr"))
    label = hexes.select("q", "r", F.struct("q", "r").alias("l")).distinct()
    while True:
        near = links.join(label.select(F.col("q").alias("nq"), F.col("r").alias("nr"), "l"), ["nq", "nr"]).groupBy("q", "r").agg(F.min("l").alias("m"))
        low = label.join(near, ["q", "r"], "left").select("q", "r", "l", F.least("l", "m").alias("m"))
        jump = label.select(F.struct("q", "r").alias("m"), F.col("l").alias("j"))
        new = written(low.join(jump, "m").select("q", "r", F.least("m", "j").alias("l"), (F.least("m", "j") < F.col("l")).alias("moved")))
        label = new.select("q", "r", "l")
        if new.filter("moved").isEmpty():
            return label.select("q", "r", F.col("l.q").alias("root_q"), F.col("l.r").alias("root_r"))


def chain_sizes(hexes: DataFrame, grid: DataFrame) -> DataFrame:
    """root_q, root_r, n, isolated, interior of the chains of ``hexes``.

    A chain of one hex is isolated, and interior too where all six of its
    neighbours are in ``grid``.
    """
    return sizes_of(chains(hexes), grid)


def sizes_of(labels: DataFrame, grid: DataFrame) -> DataFrame:
    """The same of chains that are found already (q, r, root_q, root_r)."""
    n = labels.groupBy("root_q", "root_r").agg(F.count(F.lit(1)).alias("n"))
    one = n.filter("n = 1").select(F.col("root_q").alias("q"), F.col("root_r").alias("r"))
    steps = one.select("q", "r", F.explode(geo.neighbour_steps(F.col("q"))).alias("s")).select("q", "r", (F.col("q") + F.col("s.dq")).alias("nq"), (F.col("r") + F.col("s.dr")).alias("nr"))
    there = grid.select(F.col("q").alias("nq"), F.col("r").alias("nr")).distinct()
    around = steps.join(there, ["nq", "nr"]).groupBy(F.col("q").alias("root_q"), F.col("r").alias("root_r")).agg(F.count(F.lit(1)).alias("_around"))
    return n.join(around, ["root_q", "root_r"], "left").select("root_q", "root_r", "n", (F.col("n") == 1).alias("isolated"), F.coalesce(F.col("_around") == 6, F.lit(False)).alias("interior"))


def sprawl(hexes: DataFrame, seeds: DataFrame, size: float, near_km: float = 11.0) -> DataFrame:
    """q, r, sq, sr, km: the nearest seed whose footprint reaches each hex.

    ``hexes``: q, r, built (urban or built-up) and open (plains or steppe);
    ``seeds``: q, r, radius_km.  A footprint grows from its seed over touching
    hexes within the radius that are built, or open and within ``near_km``.
    Ties go to the least (q, r) of the seed.
    """
    reach = math.ceil(seeds.agg(F.max("radius_km")).first()[0] or 0) * 1000
    dq, dr = math.ceil(reach / (1.5 * geo.radius(size))), math.ceil(reach / size) + 1
    grid = F.explode(F.sequence(F.col("q") - dq, F.col("q") + dq)).alias("hq")
    around = seeds.select(F.col("q").alias("sq"), F.col("r").alias("sr"), "radius_km", grid).select("*", F.explode(F.sequence(F.col("sr") - dr, F.col("sr") + dr)).alias("hr"))
    # of whole steps, so that equal distances are equal numbers
    dx = (F.col("hq") - F.col("sq")) * (1.5 * geo.radius(size))
    dy = ((F.col("hr") - F.col("sr")) + (F.pmod("hq", F.lit(2)) - F.pmod("sq", F.lit(2))) * 0.5) * size
    around = around.withColumn("km", F.sqrt(dx * dx + dy * dy) / 1000).filter("km <= radius_km")
    able = around.join(hexes.select(F.col("q").alias("hq"), F.col("r").alias("hr"), "built", "open"), ["hq", "hr"])
    able = written(able.filter(F.col("built") | (F.col("open") & (F.col("km") <= near_km)) | ((F.col("hq") == F.col("sq")) & (F.col("hr") == F.col("sr")))).select("sq", "sr", F.col("hq").alias("q"), F.col("hr").alias("r"), "km"))
    front = reached = able.filter("q = sq and r = sr")
    while not front.isEmpty():
        step = front.select("sq", "sr", "q", "r", F.explode(geo.neighbour_steps(F.col("q"))).alias("s")).select("sq", "sr", (F.col("q") + F.col("s.dq")).alias("q"), (F.col("r") + F.col("s.dr")).alias("r")).distinct()
        front = written(able.join(step, ["sq", "sr", "q", "r"], "left_semi").join(reached, ["sq", "sr", "q", "r"], "left_anti"))
        reached = written(reached.union(front))
    return reached.groupBy("q", "r").agg(F.min(F.struct("km", "sq", "sr")).alias("m")).select("q", "r", "m.sq", "m.sr", "m.km")


def footprint(hexes: DataFrame, claims: DataFrame) -> DataFrame:
    """``hexes`` with parent_city, km and the anthrome, kind and class of a footprint.

    ``hexes``: q, r, kind, name, landuse, anthrome, population_class; ``claims``
    as ``sprawl`` makes them.  Industrial land use is industrial at any
    distance, else under 3 km metro, residential land use residential, others
    outskirts.  Hexes other than the seed that are no city become suburbs, of
    class 3 under 6 km and 2 beyond.
    """
    seeds = hexes.select(F.col("q").alias("sq"), F.col("r").alias("sr"), F.col("name").alias("_parent"))
    held = claims.join(seeds, ["sq", "sr"]).select("q", "r", "_parent", F.col("km").alias("_km"), ((F.col("q") == F.col("sq")) & (F.col("r") == F.col("sr"))).alias("_seed"))
    ring = F.col("_km").isNotNull() & ~F.col("_seed") & ~F.col("kind").isin("city", "metropolis")
    anthrome = F.when(F.col("_km").isNull(), F.col("anthrome")).when(F.col("landuse") == "industrial", "industrial").when(F.col("_km") < 3, "metro").when(F.col("landuse") == "residential", "residential").otherwise("outskirts")
    return (
        hexes.join(held, ["q", "r"], "left")
        .withColumns({
            "anthrome": anthrome,
            "parent_city": F.coalesce("_parent", F.lit("")),
            "km": F.bround("_km", 1),
            "population_class": F.when(ring, F.when(F.col("_km") < 6, 3).otherwise(2)).otherwise(F.col("population_class")),
            "kind": F.when(ring, "suburb").otherwise(F.col("kind")),
        })
        .select(*hexes.columns, "parent_city", "km")
    )

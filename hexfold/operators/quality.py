"""Gates over records of hexes: one row (name, ok, detail) a check.

Every gate is an aggregate of the records; gates over one table share a pass.
``detail`` is the number that the gate compares, as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexfold.functions import classify
from hexfold.operators import hexes, tables
from hexfold.operators.scratch import written

FOOTPRINT = ["metro", "industrial", "residential", "outskirts"]  #: fixed values: anthromes of a footprint


def gate(name: str, value: Column, ok) -> tuple[str, Column, object]:
    """A value over all rows (an aggregate), and what has to hold of it."""
    return name, value, ok


def band(low: float, high: float):
    return lambda v: v.between(low, high)


def at_least(n: float):
    return lambda v: v >= n


def none(v: Column) -> Column:
    return v == 0


def checks(rows: DataFrame, gates: list) -> DataFrame:
    """name, ok, detail of gates over ``rows``, in one pass; a value of no rows (null) holds nothing."""
    one = rows.agg(*[value.cast("double").alias(f"_{i}") for i, (_, value, _) in enumerate(gates)])
    each = [F.struct(F.lit(name).alias("name"), F.coalesce(ok(F.col(f"_{i}")), F.lit(False)).alias("ok"), F.col(f"_{i}").alias("detail")) for i, (name, _, ok) in enumerate(gates)]
    return one.select(F.explode(F.array(*each)).alias("e")).select("e.*")


def count(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def record_gates(expect: dict) -> list:
    """Gates on one record at a time: schema, ids, bands, inert fields, rivers, settlements, footprints, resources, provinces.

    ``expect``: schema, hex_count, countries {code: (low, high)}, water_min,
    biome_bands {biome: (pct or count, low, high)}, river_hexes, cities_min,
    sprawl {name part: least}, resources {kind: least}, and if wanted
    industrial {name part, '' for any: least} of industrial footprint hexes.
    """
    c = F.col
    land, river, settled = ~classify.is_water(c("biome")), c("has_river"), c("kind") != "none"
    share = lambda part, whole: part / F.greatest(whole, F.lit(1))
    gates = [
        gate("schema version", count(c("schema") != expect["schema"]), none),
        gate("ids", count(c("id") != F.concat_ws("_", c("col").cast("string"), c("row").cast("string"))), none),
        gate("hex count", F.count(F.lit(1)), band(*expect["hex_count"])),
        gate("water minimum", count(~land), at_least(expect["water_min"])),
        gate("land without country", share(count(land & (c("country") == "")), count(land)), lambda v: v <= 0.01),
        gate("land elevation", count(land & ~c("elev").between(-120, 4900)), none),
        gate("no void shipped", count(c("elev") <= -32767), none),
        gate("slope", count(~c("slope").between(0, 60)), none),
        gate("inert fields", count(c("port") | c("airfield") | (c("fortification") != "none")), none),
        gate("river hexes", count(river), band(*expect["river_hexes"])),
        gate("river names", count(river != (c("river_name") != "")), none),
        gate("river edges", count(F.exists("river_edges", lambda e: ~e.between(0, 5))), none),
        gate("settled share", share(count(settled), F.count(F.lit(1))), lambda v: v <= 0.4),
        gate("cities", count(c("kind").isin("city", "metropolis")), at_least(expect["cities_min"])),
        gate("bridges", share(count(c("bridge")), count(river)), at_least(0.5)),
        gate("footprint anthromes", count((c("parent_city") != "") & ~c("anthrome").isin(FOOTPRINT)), none),
        gate("suburbs have a parent", count((c("kind") == "suburb") & (c("parent_city") == "")), none),
        gate("province country", count((c("province") != "") & (c("country") != "") & (F.split(c("province"), "_")[0] != c("country"))), none),
        gate("province without country", count((c("province") != "") & (c("country") == "")), none),
        gate("settled tiers", count((c("province") != "") & settled & ~c("tier").isin("capital", "sub_capital", "urban")), none),
        gate("rural names", count((c("tier") == "rural") & (c("name") != "")), none),
    ]
    gates += [gate(f"country {code}", count(c("country") == code), band(*b)) for code, b in expect["countries"].items()]
    gates += [gate(f"biome {b}", 100 * share(count(c("biome") == b), count(land)) if kind == "pct" else count(c("biome") == b), band(low, high)) for b, (kind, low, high) in expect["biome_bands"].items()]
    gates += [gate(f"footprint {part}", count(F.contains(F.lower("parent_city"), F.lit(part.lower()))), at_least(n)) for part, n in expect["sprawl"].items()]
    industrial = (c("parent_city") != "") & (c("anthrome") == "industrial")
    gates += [gate(f"industrial {part or 'footprints'}", count(industrial & F.contains(F.lower("parent_city"), F.lit(part.lower()))), at_least(n)) for part, n in expect.get("industrial", {}).items()]
    return gates + [gate(f"resource {kind}", count(c(kind)), at_least(n)) for kind, n in expect["resources"].items()]


def group_gates(rows: DataFrame, expect: dict) -> DataFrame:
    """Gates over groups of records: duplicates, shares of biomes, capitals, coverage of countries, major rivers.

    ``expect`` has provinces_min, partial_countries and covered_countries too.
    """
    c = F.col
    land = ~classify.is_water(c("biome"))
    place = rows.groupBy("col", "row").agg(F.count(F.lit(1)).alias("n"))
    biomes = rows.groupBy("biome").agg(F.count(F.lit(1)).alias("n"))
    capitals = rows.filter("province <> ''").groupBy("province").agg(F.count_if(c("tier") == "capital").alias("n"))
    covered = rows.filter(land & c("country").isin(expect["covered_countries"]) & ~c("country").isin(expect["partial_countries"]))
    rivers = rows.filter("has_river and river_name <> ''").groupBy("river_name").agg(F.count(F.lit(1)).alias("n"))
    made = [
        checks(place, [gate("duplicates", count(c("n") > 1), none)]),
        checks(biomes, [gate("largest biome share", F.max("n") / F.sum("n"), lambda v: v <= 0.6)]),
        checks(capitals, [gate("provinces", F.count(F.lit(1)), at_least(expect["provinces_min"])), gate("several capitals", count(c("n") > 1), none)]),
        checks(covered, [gate("province coverage", 1 - F.count_if(c("province") == "") / F.greatest(F.count(F.lit(1)), F.lit(1)), at_least(0.98))]),
        checks(rivers, [gate("major rivers", count(c("n") >= 10), at_least(2)), gate("generic river names", count(F.lower("river_name").isin("river", "canal", "stream")), none)]),
    ]
    out = made[0]
    for more in made[1:]:
        out = out.union(more)
    return out


def slope_gate(rows: DataFrame, low: float, high: float) -> DataFrame:
    """Whether the slope of the lower nearest rank at 0.9 among land is in a band; without land it is 0."""
    p90 = tables.order_statistic(rows.filter(~classify.is_water(F.col("biome"))), "slope", 0.9) or 0.0
    return checks(rows.limit(1), [gate("land slope p90", F.coalesce(F.max(F.lit(p90)), F.lit(0.0)), band(low, high))])


def chain_gates(rows: DataFrame, points: DataFrame, near: DataFrame, least: int = 3, share: float = 0.03) -> DataFrame:
    """Gates on chains of river hexes: none alone inside the map, few alone at all, and long ones at given points.

    ``rows``: col, row (of one parity with q and r) and has_river; ``points``:
    pid, name; ``near``: pid, col, row of the hex that is nearest to each.
    """
    river = rows.filter("has_river").select(F.col("col").alias("q"), F.col("row").alias("r"))
    labels = written(hexes.chains(river), "chains")
    sizes = hexes.sizes_of(labels, rows.select(F.col("col").alias("q"), F.col("row").alias("r")))
    isolated = F.count_if("isolated") / F.greatest(F.sum("n"), F.lit(1))
    alone = checks(sizes, [gate("interior isolated rivers", F.count_if(F.col("isolated") & F.col("interior")), none), gate("isolated river share", F.coalesce(isolated, F.lit(0.0)), lambda v: v <= share)])
    long = labels.join(sizes.select("root_q", "root_r", "n"), ["root_q", "root_r"]).select(F.col("q").alias("col"), F.col("r").alias("row"), "n")
    at = points.join(near.select("pid", "col", "row"), "pid", "left").join(long, ["col", "row"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return alone.union(at.select(F.concat(F.lit("river chain at "), "name").alias("name"), (F.col("n") >= least).alias("ok"), F.col("n").cast("double").alias("detail")))


def total_gates(rows: DataFrame, authored: DataFrame) -> DataFrame:
    """Whether each country has the provinces that its layer has: ``authored`` is country, province; a country without any hex is left out."""
    made = rows.filter("province <> ''").select("country", "province").distinct().groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    there = rows.filter("country <> ''").select("country").distinct()
    want = authored.select("country", "province").distinct().groupBy("country").agg(F.count(F.lit(1)).alias("want")).join(there, "country")
    both = want.join(made, "country", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return both.select(F.concat(F.lit("provinces of "), "country").alias("name"), (F.col("n") == F.col("want")).alias("ok"), F.col("n").cast("double").alias("detail"))


def order_gate(rows: DataFrame, position: str) -> DataFrame:
    """Whether the rows stand by (col, row) in the order of ``position``: rows whose successor comes before them.

    Neighbours in the order are matched by their rank among all rows, which is
    given by the position (0, 1, 2 ...).
    """
    after = rows.select((F.col(position) - 1).alias(position), F.struct("col", "row").alias("_next"))
    pairs = rows.select(position, F.struct("col", "row").alias("_here")).join(after, position)
    return checks(pairs, [gate("order", count(F.col("_next") <= F.col("_here")), none)])


def spot_gates(points: DataFrame, near: DataFrame, found: Column, most_km: float | None = None) -> DataFrame:
    """name, ok, detail of points (pid, name): whether any of their nearest rows (``near``: pid, d in degrees ...) has what is ``found``.

    With ``most_km`` a point whose nearest row is farther holds, as it lies outside.
    """
    hit = near.groupBy("pid").agg(F.bool_or(F.coalesce(found, F.lit(False))).alias("_hit"), F.min("d").alias("_d"))
    ok = F.coalesce("_hit", F.lit(False))
    if most_km is not None:
        ok = ok | (F.col("_d") * 111.32 > most_km) | F.col("_d").isNull()
    return points.join(hit, "pid", "left").select("name", ok.alias("ok"), F.col("_d").alias("detail"))

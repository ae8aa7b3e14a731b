"""Provinces, their capitals, resources and coverage of hexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexfold.functions import classify
from hexfold.operators import spatial
from hexfold.operators.scratch import written

RESOURCES = ["coal", "steel", "iron", "oil"]  #: fixed values: the types that count


def assign_province(points: DataFrame, outlines: DataFrame, snap: float, cell: float = 0.1) -> DataFrame:
    """pid, province of points (pid, x, y, country) by outlines (fid, country, segments), in the point's own country.

    A point without a country has none; a snap never crosses a border.
    """
    codes = outlines.select("fid", F.col("fid").alias("code")).distinct()
    found = spatial.cover_or_snap(points.filter("country <> ''"), outlines, codes, snap, cell, same="country")
    return points.select("pid").join(found, "pid", "left").select("pid", F.coalesce("code", F.lit("")).alias("province"))


def best_score(name: Column, names: Column) -> Column:
    """The best match of a name among several; both normalised."""
    return F.coalesce(F.array_max(F.transform(names, lambda n: classify.match_score(name, n))), F.lit(0))


def designate_capitals(nodes: DataFrame, meta: DataFrame) -> DataFrame:
    """province, rank, q, r, name, population of the hex that each rank of a province (0: the capital) takes.

    ``nodes``: province, q, r, name, population; ``meta``: province, rank,
    names.  Ranks choose in turn, each the best by score, population and
    (q, r) among the hexes that its province has left; a score of 0 is no
    match.  There are as many rounds as ranks, which are few.
    """
    known = meta.select("province", "rank", F.transform("names", classify.norm_name).alias("names"))
    nodes = nodes.withColumns({"population": F.coalesce("population", F.lit(0)), "_name": classify.norm_name(F.col("name"))})
    scored = nodes.join(known, "province").withColumn("score", best_score(F.col("_name"), F.col("names"))).filter("score > 0")
    scored = written(scored.select("province", "rank", "score", "population", "q", "r", "name"))
    taken = None
    for (rank,) in meta.select("rank").distinct().orderBy("rank").collect():
        free = scored.filter(F.col("rank") == rank)
        if taken is not None:
            free = free.join(taken, ["province", "q", "r"], "left_anti")
        best = free.groupBy("province", "rank").agg(F.max(F.struct("score", "population", "q", "r", "name")).alias("m")).select("province", "rank", "m.q", "m.r", "m.name", "m.population")
        taken = written(best if taken is None else taken.union(best))
    return scored.limit(0).select("province", "rank", "q", "r", "name", "population") if taken is None else taken


def with_capitals(hexes: DataFrame, capitals: DataFrame) -> DataFrame:
    """``hexes`` (q, r, province, tier, kind, name, first_population, anthrome ...) with their designation.

    Tier becomes capital or subcapital.  A hex without a settlement becomes a
    city if its first node has 50,000 people, else a town; a blank name is
    filled, and no anthrome becomes residential.
    """
    claimed = capitals.select("province", "q", "r", F.col("rank").alias("_rank"), F.col("name").alias("_name"))
    bare = F.col("_rank").isNotNull() & (F.col("kind") == "none")
    return (
        hexes.join(claimed, ["province", "q", "r"], "left")
        .withColumns({
            "tier": F.when(F.col("_rank") == 0, "capital").when(F.col("_rank") > 0, "subcapital").otherwise(F.col("tier")),
            "name": F.when(F.col("_rank").isNotNull() & (F.trim(F.coalesce("name", F.lit(""))) == ""), F.col("_name")).otherwise(F.col("name")),
            "anthrome": F.when(bare & (F.col("anthrome") == "none"), "residential").otherwise(F.col("anthrome")),
            "kind": F.when(bare & (F.col("first_population") >= 50_000), "city").when(bare, "town").otherwise(F.col("kind")),
        })
        .select(*hexes.columns)
    )


def resources_of_hexes(centres: DataFrame, outlines: DataFrame, kinds: DataFrame, spots: DataFrame) -> DataFrame:
    """q, r and a boolean for each resource: polygons (fid, segments; kinds fid, kind) over the centre (q, r, x, y), points (q, r, kind) in the hex."""
    placed = centres.withColumn("pid", F.struct("q", "r"))
    over = spatial.point_in_polygon(placed, outlines).join(kinds, "fid").select("pid.q", "pid.r", "kind")
    held = over.union(spots.select("q", "r", "kind")).withColumn("kind", F.lower("kind")).filter(F.col("kind").isin(RESOURCES)).groupBy("q", "r").agg(F.collect_set("kind").alias("held"))
    found = centres.select("q", "r").join(held, ["q", "r"], "left")
    return found.select("q", "r", *[F.coalesce(F.array_contains("held", x), F.lit(False)).alias(x) for x in RESOURCES])


def coverage(hexes: DataFrame) -> DataFrame:
    """country, n, covered, share: hexes (country, province) of a country and those with a province."""
    has = F.count_if(F.coalesce("province", F.lit("")) != "")
    return hexes.filter("country <> ''").groupBy("country").agg(F.count(F.lit(1)).alias("n"), has.alias("covered")).withColumn("share", F.round(F.col("covered") / F.col("n"), 6))


def overlaps(covers: DataFrame) -> DataFrame:
    """a, b, n: places (pid) that two codes cover, by pair; few outlines cover one place, so a place's list is short."""
    lists = covers.distinct().groupBy("pid").agg(F.array_sort(F.collect_list("code")).alias("codes")).filter(F.size("codes") > 1)
    first = lists.select("codes", F.posexplode("codes").alias("i", "a"))
    return first.select("a", F.explode(F.slice("codes", F.col("i") + 2, F.size("codes"))).alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))

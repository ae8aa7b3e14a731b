"""Terrain, settlement and naming rules as Column expressions; null landuse means none."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(key: Column, values: dict, default) -> Column:
    pairs = [F.lit(x) for k, v in values.items() for x in (k, v)]
    return F.coalesce(F.create_map(*pairs)[key], F.lit(default))


def _rules(rules, default) -> Column:
    out = None
    for condition, value in rules:
        hit = F.coalesce(condition, F.lit(False))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(default)


# The rules of has_tree_cover, biome, vegetation, moisture, elevation_tier, settlement_type,
# sprawl_radius_km and anthrome are fixed values: names, thresholds and their order.


def has_tree_cover(elev: Column, lat: Column) -> Column:
    return (elev <= 1800) & (lat <= 68)


def biome(water, lake, coastal, landuse, elev, slope, lat, lon, place) -> Column:
    """First rule that holds, in the order of the blueprint."""
    return _rules(
        [
            (water & coastal, "coastal_water"),
            (water, "water"),
            (lake, "lake"),
            (landuse == "glacier", "glacier"),
            ((elev > 2800) & (slope < 10), "glacier"),
            ((landuse == "beach") & coastal, "beach"),
            (place.isin("city", "town"), "urban"),
            (landuse == "industrial", "urban"),
            ((landuse == "wetland") & has_tree_cover(elev, lat), "swamp"),
            (landuse == "wetland", "marsh"),
            (landuse == "forest", "forest"),
            (slope >= 20, "mountain"),
            ((elev >= 800) & (slope >= 5), "mountain"),
            (slope >= 8, "hill"),
            ((elev >= 1500) & (slope < 3), "highland_plateau"),
            ((elev >= 1800) & (lat >= 55), "tundra"),
            ((lat >= 65) & (landuse.isNull() | landuse.isin("grass", "heath", "scrub")), "tundra"),
            (landuse == "sand", "desert"),
            ((lat < 32) & (lon > -5) & (elev < 500) & (slope < 5), "desert"),
            (landuse.isin("heath", "scrub"), "steppe"),
            ((lon > 25) & (elev < 300) & (slope < 5), "steppe"),
        ],
        "plains",
    )


def vegetation(landuse: Column, biome: Column) -> Column:
    return _rules(
        [
            (biome.isin("water", "coastal_water", "lake", "glacier", "desert", "beach"), "bare"),
            (biome.isin("forest", "swamp", "jungle", "rainforest", "taiga", "mangrove"), "dense"),
            (landuse.isin("forest", "wetland"), "dense"),
            (landuse.isin("farmland", "grass", "residential", "industrial"), "light"),
            (landuse.isin("heath", "scrub", "sand"), "sparse"),
            (biome.isin("tundra", "steppe", "badlands"), "sparse"),
            (biome == "urban", "bare"),
        ],
        "light",
    )


def moisture(biome, landuse, elev, lat, lon) -> Column:
    return _rules(
        [
            (biome.isin("marsh", "swamp", "mangrove"), "flooded"),
            (landuse == "wetland", "flooded"),
            (biome == "desert", "arid"),
            (biome.isin("steppe", "tundra"), "dry"),
            ((lat < 30) & (lon > -5), "arid"),
            (elev > 600, "wet"),
            ((lon < 5) & (lat > 45), "wet"),
        ],
        "temperate",
    )


def elevation_tier(elev: Column, slope: Column) -> Column:
    return _rules([((slope < 3) & (elev > 1500), "highland_plateau"), (slope < 3, "flat"), (slope < 10, "hilly"), (slope < 20, "mountainous")], "rugged")


def settlement_type(place: Column, population: Column) -> Column:
    pop = F.coalesce(population, F.lit(0))
    return _rules([(pop > 300_000, "metropolis"), (pop >= 50_000, "city"), (pop >= 2_000, "town"), (pop > 0, "village"), (place == "city", "city"), (place == "town", "town")], "village")


def population_class(kind: Column) -> Column:
    return _table(kind, {"none": 0, "village": 1, "town": 2, "city": 3, "metropolis": 5}, 0)


def sprawl_radius_km(kind: Column, population: Column) -> Column:
    return _rules([(kind == "metropolis", F.lit(14)), ((kind == "city") & (population >= 150_000), F.lit(11)), (kind == "city", F.lit(8))], F.lit(0))


def anthrome(biome, landuse, kind) -> Column:
    wild = (biome != "urban") & (kind == "none")
    return _rules(
        [
            (wild & (landuse == "farmland"), "cropland"),
            (wild & (landuse == "military"), "fortified"),
            (wild & (landuse == "quarry"), "mining"),
            (wild, "none"),
            (landuse == "industrial", "industrial"),
            (kind.isin("metropolis", "city"), "metro"),
            (kind == "town", "residential"),
        ],
        "none",
    )


def is_water(biome: Column) -> Column:
    return biome.isin("water", "coastal_water", "lake")


def is_impassable(biome: Column) -> Column:
    return is_water(biome) | (biome == "glacier")


# fixed values: base movement cost (99: impassable), base defence and class of eight of each biome
BIOMES = {
    "plains": (1, 0, "clear"),
    "steppe": (1, 0, "clear"),
    "forest": (2, 1, "forest"),
    "jungle": (3, 2, "forest"),
    "rainforest": (4, 2, "forest"),
    "desert": (2, 0, "desert"),
    "badlands": (2, 1, "rough"),
    "savanna": (1, 0, "clear"),
    "hill": (2, 1, "rough"),
    "mountain": (3, 2, "mountain"),
    "highland_plateau": (2, 1, "rough"),
    "glacier": (99, 0, "mountain"),
    "tundra": (2, 0, "rough"),
    "taiga": (3, 1, "forest"),
    "marsh": (3, 0, "marsh"),
    "swamp": (3, 1, "marsh"),
    "mangrove": (3, 1, "marsh"),
    "beach": (1, 0, "clear"),
    "atoll": (1, 0, "clear"),
    "volcanic_island": (3, 1, "rough"),
    "water": (99, 0, "water"),
    "coastal_water": (99, 0, "water"),
    "lake": (99, 0, "water"),
    "urban": (1, 2, "urban"),
}
# fixed values: movement cost of a class in the class block
CLASS_COST = {"water": 99, "clear": 1, "rough": 2, "forest": 2, "mountain": 3, "marsh": 3, "desert": 2, "urban": 1}


# fixed values: the biome of a class, where only the class is known
CLASS_BIOME = {"clear": "plains", "rough": "hill", "forest": "forest", "mountain": "mountain", "marsh": "marsh", "desert": "desert", "urban": "urban", "water": "water"}


def resolve_biome(raw: Column, strict: bool = False) -> Column:
    """A biome's name, or that of a class; others and null are plains, or an error where ``strict`` (which takes biomes only)."""
    known = F.when(raw.isin(*BIOMES), raw)
    if strict:
        return F.coalesce(known, F.raise_error(F.concat(F.lit("unknown biome: "), F.coalesce(raw, F.lit("null")))).cast("string"))
    return F.coalesce(known, _table(raw, CLASS_BIOME, "plains"))


def base_cost(biome: Column) -> Column:
    """Null for an unknown biome."""
    return F.create_map(*[F.lit(x) for name, (cost, _, _) in BIOMES.items() for x in (name, cost)])[biome]


def base_defense(biome: Column) -> Column:
    """Null for an unknown biome."""
    return F.create_map(*[F.lit(x) for name, (_, defense, _) in BIOMES.items() for x in (name, defense)])[biome]


def terrain_class(biome: Column) -> Column:
    """One of eight classes; plains-like and unknown biomes are clear."""
    return _table(biome, {name: kind for name, (_, _, kind) in BIOMES.items()}, "clear")


def class_block(biome: Column) -> Column:
    """struct(terrain, cost, defense, blocks_los); the defence of this block is always 0."""
    kind = terrain_class(biome)
    return F.struct(kind.alias("terrain"), _table(kind, CLASS_COST, 99).alias("cost"), F.lit(0).alias("defense"), kind.isin("forest", "mountain", "urban").alias("blocks_los"))


# fixed values: movement cost, defence, whether sight is blocked, and description of the eight classes
EFFECTS = {
    "water": (99, 0, False, "ships alone cross it"),
    "clear": (1, 0, False, "nothing stands in the way"),
    "rough": (2, 1, False, "broken ground slows"),
    "forest": (2, 1, True, "trees hide what is behind"),
    "mountain": (3, 2, True, "steep and high"),
    "marsh": (3, 0, False, "soft ground, slow going"),
    "desert": (2, 0, False, "dry ground"),
    "urban": (1, 2, True, "houses give cover"),
}


def terrain_effects(spark: SparkSession) -> DataFrame:
    """terrain, cost, defense, blocks_los and note of the eight classes."""
    return spark.createDataFrame([(k, *v) for k, v in EFFECTS.items()], "terrain string, cost int, defense int, blocks_los boolean, note string")


def admin_tier(water: Column, country: Column, province: Column, settled: Column) -> Column:
    """none on water or outside every country or province, else urban where settled, else rural."""
    nowhere = water | (F.coalesce(country, F.lit("")) == "") | (F.coalesce(province, F.lit("")) == "")
    return _rules([(nowhere, "none"), (settled, "urban")], "rural")


def admin_tier_default(water: Column, country: Column, kind: Column) -> Column:
    """The tier where no provinces are known: none on water or without a country, urban where settled, else rural."""
    return _rules([(water | (F.coalesce(country, F.lit("")) == ""), "none"), (~F.coalesce(kind, F.lit("none")).isin("none", ""), "urban")], "rural")


# fixed values: land use by the natural tag, which goes first, and by the landuse tag
NATURAL = {"wood": "forest", "wetland": "wetland", "heath": "heath", "scrub": "scrub", "grassland": "grass", "sand": "sand", "bare_rock": "sand", "glacier": "glacier", "beach": "beach", "water": "water"}
LANDUSE = {
    "forest": "forest", "farmland": "farmland", "farmyard": "farmland", "meadow": "grass", "grass": "grass", "village_green": "grass", "allotments": "farmland",
    "residential": "residential", "industrial": "industrial", "commercial": "residential", "retail": "residential", "military": "military", "quarry": "quarry", "wetland": "wetland",
}


def landuse_tag(tags: Column) -> Column:
    """Land use of a map of tags; null where neither tag is known."""
    known = lambda names, tag: F.create_map(*[F.lit(x) for e in names.items() for x in e])[F.coalesce(tags[tag], F.lit(""))]
    return F.coalesce(known(NATURAL, "natural"), known(LANDUSE, "landuse"))


def _folded() -> tuple[dict[str, str], dict[str, str]]:
    """Characters whose compatibility decomposition, without combining marks, is one other character, and those whose is several.

    Syllables of Hangul are left whole, as they are on both sides of a match.
    """
    one, several = {}, {}
    for c in map(chr, (*range(0xA0, 0xAC00), *range(0xF900, 0x10000))):
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if unicodedata.category(x) != "Mn")
        if plain and plain != c:
            (one if len(plain) == 1 else several)[c] = plain
    return one, several


ONE, SEVERAL = _folded()
LONGEST = sorted(SEVERAL, key=lambda c: -len(SEVERAL[c]))  # those that have an n-th character come first


def _spelled(name: Column) -> Column:
    """``name`` with ligatures and other signs that stand for several characters written out."""
    signs = "".join(LONGEST)
    nth = ["".join(SEVERAL[c][n] for c in LONGEST if len(SEVERAL[c]) > n) for n in range(len(SEVERAL[LONGEST[0]]))]
    out = lambda c: F.concat(*[F.translate(c, signs, x) for x in nth])
    each = F.transform(F.split(name, ""), lambda c: F.when((c != "") & F.lit(signs).contains(c), out(c)).otherwise(c))
    return F.when(name.rlike("[" + signs + "]"), F.array_join(each, "")).otherwise(name)


def norm_name(name: Column) -> Column:
    """Small letters without accents (as single characters or combining marks) or ligatures, punctuation as spaces."""
    plain = F.translate(_spelled(F.replace(name, F.lit("ß"), F.lit("ss"))), "".join(ONE), "".join(ONE.values()))
    plain = F.lower(F.when(name.rlike(r"[^\x00-\x7F]"), F.regexp_replace(plain, r"\p{Mn}", "")).otherwise(name))  # ASCII has none of these signs
    return F.trim(F.regexp_replace(F.regexp_replace(plain, r"[^\p{L}\p{N} ]", " "), " +", " "))


def match_score(a: Column, b: Column) -> Column:
    """100 equal, 70 one name is a token of the other, 50 a shared token of four letters, else 0."""
    x, y = F.split(a, " "), F.split(b, " ")
    long = lambda t: F.filter(t, lambda w: F.length(w) >= 4)
    return _rules([((a == "") | (b == ""), F.lit(0)), (a == b, F.lit(100)), (F.array_contains(x, b) | F.array_contains(y, a), F.lit(70)), (F.arrays_overlap(long(x), long(y)), F.lit(50))], F.lit(0))

"""Boundary files: feature collections as outlines, and the metadata of provinces."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

RINGS = "array<array<array<double>>>"


MARK = r'\{\s*"type"\s*:\s*"Feature"'  # how a feature begins, however it is spaced


def _texts(spark: SparkSession, path: str) -> DataFrame | None:
    """feature: the text of each feature of collections, in several tasks a file; None where a feature does not begin with its type.

    A file is cut by how its features begin, as lines are by their ends: an
    exact text, taken from the file, which no string in it can hold, as quotes
    in strings are escaped.  A task reads the features that begin in its bytes.
    What another spacing leaves in one piece is cut inside it.
    """
    read = lambda mark: spark.read.option("lineSep", mark).text(path)
    head = read('"Feature"').limit(1).collect()
    begins = re.search(r"""\{\s*"type"\s*:\s*$""", head[0].value) if head else None
    if not begins:
        return None
    mark = begins[0] + '"Feature"'
    parts = read(mark).select(F.split("value", MARK).alias("parts"))
    # what stands before a file's first feature is the collection itself
    goes_on = F.ltrim(F.col("parts")[0]).substr(1, 1).isin(",", "}")
    each = parts.select(F.explode(F.when(goes_on, F.col("parts")).otherwise(F.slice("parts", F.lit(2), F.size("parts")))).alias("part"))
    stray = F.col("part").rlike(r"""[^\\]"type"\s*:\s*"Feature\"""")
    return each.select(F.concat(F.lit(mark), F.when(stray, F.raise_error(F.lit("a feature does not begin with its type"))).otherwise(F.col("part"))).alias("feature"))


def read_geojson(spark: SparkSession, path: str, properties: str, optional: bool = False) -> DataFrame:
    """The ``properties`` (name type, ...), kind, rings and lon, lat of every feature of one file or a folder of them.

    Rings are those of all parts of a polygon, as pairs of lon and lat; a point
    has lon and lat.  Coordinates nest to a depth that depends on the kind, so
    they are read as text first.  A missing file fails, or is an empty table
    where it is ``optional``.  Files whose features begin with their type are
    read by ranges of bytes, others by one task each.
    """
    feature = f"properties: struct<{', '.join(': '.join(p.split()) for p in properties.split(','))}>, geometry: struct<type: string, coordinates: string>"
    try:
        texts = _texts(spark, path)
        if texts is None:
            read = spark.read.schema(f"features array<struct<{feature}>>").option("multiLine", True).json(path).select(F.explode("features").alias("f"))
        else:
            read = texts.select(F.from_json("feature", f"struct<{feature}>").alias("f"))
    except AnalysisException as e:
        if not optional or e.getCondition() != "PATH_NOT_FOUND":
            raise
        read = spark.createDataFrame([], f"f struct<{feature}>")
    each = read.select("f.properties.*", F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("_c"))
    rings = F.when(F.col("kind") == "Polygon", F.from_json("_c", RINGS)).when(F.col("kind") == "MultiPolygon", F.flatten(F.from_json("_c", f"array<{RINGS}>")))
    at = F.when(F.col("kind") == "Point", F.from_json("_c", "array<double>"))
    return each.withColumns({"rings": rings, "lon": at[0], "lat": at[1]}).drop("_c")


def outlines(features: DataFrame, fid: str, *keep: str) -> DataFrame:
    """fid, ``keep``, x1, y1, x2, y2: the segments of all rings; a ring that is not closed is closed."""
    ring = features.select(F.col(fid).alias("fid"), *keep, F.explode("rings").alias("ring"))
    ring = ring.withColumn("ring", F.when(F.col("ring")[0] == F.element_at("ring", -1), F.col("ring")).otherwise(F.concat("ring", F.slice("ring", 1, 1))))
    pairs = F.arrays_zip(F.slice("ring", F.lit(1), F.size("ring") - 1).alias("a"), F.slice("ring", F.lit(2), F.size("ring") - 1).alias("b"))
    e = ring.select("fid", *keep, F.explode(pairs).alias("e"))
    return e.select("fid", *keep, F.col("e.a")[0].alias("x1"), F.col("e.a")[1].alias("y1"), F.col("e.b")[0].alias("x2"), F.col("e.b")[1].alias("y2"))


def read_province_metadata(spark: SparkSession, path: str) -> DataFrame:
    """province, country, rank (0: the capital), city_name, names (the city's own name first) of every ranked city."""
    city = "struct<city_name: string, match_names: array<string>>"
    read = spark.read.schema(f"provinces array<struct<province_id: string, country: string, capital: {city}, sub_capitals: array<{city}>>>").option("multiLine", True).json(path)
    each = read.select(F.explode("provinces").alias("p"))
    ranked = F.concat(F.array("p.capital"), F.coalesce("p.sub_capitals", F.array().cast(f"array<{city}>")))
    each = each.select(F.col("p.province_id").alias("province"), F.coalesce("p.country", F.split("p.province_id", "_")[0]).alias("country"), F.posexplode(ranked).alias("rank", "c")).filter("c.city_name is not null")
    return each.select("province", "country", "rank", "c.city_name", F.array_distinct(F.concat(F.array("c.city_name"), F.coalesce("c.match_names", F.array().cast("array<string>")))).alias("names"))


def remapped(units: DataFrame, names: DataFrame) -> DataFrame:
    """``units`` (country, name, lon, lat ...) with province, the id that their place belongs to; others drop out.

    ``names``: country, name, province, axis, cut, upper.  A name without an
    axis belongs to one province; one with an axis (lon or lat) is split at
    ``cut``, to the province with ``upper`` beyond it and to the other up to it.
    """
    at = F.when(F.col("axis") == "lon", F.col("lon")).when(F.col("axis") == "lat", F.col("lat"))
    side = F.col("axis").isNull() | ((at > F.col("cut")) == F.col("upper"))
    return units.join(names, ["country", "name"]).filter(side).select(*units.columns, "province")

"""Incremental ingest of staged map elements with Structured Streaming, and of what is derived from them by tile."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexfold.functions import classify, geo
from hexfold.operators import hexes, tiles
from hexfold.sources import elements, layers

TILE = ["tile_q", "tile_r"]
SHARES = 4  #: files of a tile and batch
MERGE = 1 << 16  #: rows of a partition that are compared at once


def _least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least text of each id among the rows of a partition."""
    held, loose, rows = pa.table({"osm_id": pa.array([], pa.string()), "value": pa.array([], pa.string())}), [], 0
    fewest = lambda: pa.concat_tables([held, pa.Table.from_batches(loose).rename_columns(held.column_names).cast(held.schema)]).group_by("osm_id").aggregate([("value", "min")]).rename_columns(held.column_names)
    for batch in batches:
        loose.append(batch)
        rows += batch.num_rows
        if rows > max(MERGE, held.num_rows):
            held, loose, rows = fewest(), [], 0
    yield from (fewest() if rows else held).to_batches()


def arrivals(spark: SparkSession, parts: str) -> DataFrame:
    """A stream of the elements (value: JSON text) of newly landed part files, once per osm_id.

    Which ids have been seen is the stream's keyed state, which holds ids and no
    texts, so a batch asks for its own ids and reads no table.  Of elements with
    one osm_id in one batch the one whose text is least stays; between batches
    the earliest.  The texts of a batch are dealt by id and compared there, so
    the state is asked once for each id, and Python is called once for many.
    """
    lines = spark.readStream.option("ignoreCorruptFiles", "false").text(parts)
    known = layers.parse_osm_elements(lines.withColumn("given", F.col("value")), "value", "given").select("osm_id", F.col("given").alias("value"))
    once = known.repartition("osm_id").mapInArrow(_least, "osm_id string, value string")
    return once.dropDuplicates(["osm_id"]).select("value")


def run(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Take in what has landed, batch by batch."""
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ingest(spark: SparkSession, parts: str, table: str, checkpoint: str) -> None:
    """Append the elements of newly landed part files (one JSON element a line) to a layer table, once per osm_id.

    The table is partitioned by batch.  A batch that is run again after a
    failure has the state of the batch before it and replaces its own
    partition, so every element is kept exactly once.
    """

    def append(batch: DataFrame, number: int) -> None:
        fresh = layers.parse_osm_elements(batch, "value")
        lon, lat = geo.tile(F.col("points")[0]["lon"], F.col("points")[0]["lat"])
        fresh.select("*", lon.alias("tile_lon"), lat.alias("tile_lat")).write.mode("overwrite").parquet(f"{table}/batch={number}")

    run(arrivals(spark, parts), append, checkpoint)


def tiled(rows: DataFrame, side: int) -> DataFrame:
    return rows.withColumns({"tile_q": tiles.tile_of(F.col("q"), side), "tile_r": tiles.tile_of(F.col("r"), side)})


def around(rows: DataFrame, side: int, reach: int) -> DataFrame:
    """tile_q, tile_r of all tiles within ``reach`` hexes of ``rows`` (q, r)."""
    over = lambda c: F.explode(F.sequence(tiles.tile_of(F.col(c) - reach, side), tiles.tile_of(F.col(c) + reach, side)))
    return rows.select("r", over("q").alias("tile_q")).select("tile_q", over("r").alias("tile_r")).distinct()


def records(places: DataFrame, side: int) -> DataFrame:
    """q, r, name, kind, n, people, crowd and tile of every hex with settlements.

    ``places``: q, r, osm_id, name, kind, population.  Name and kind are those
    of the largest, ties by least osm_id; crowd is the settlements of the hex
    and of the six around it.
    """
    order = F.struct((-F.col("population")).alias("p"), "osm_id")
    held = places.groupBy("q", "r").agg(F.min_by(F.struct("name", "kind"), order).alias("s"), F.count(F.lit(1)).alias("n"), F.sum("population").alias("people"))
    beside = hexes.neighbors(held).join(held.select(F.col("q").alias("nq"), F.col("r").alias("nr"), F.col("n").alias("_n")), ["nq", "nr"]).groupBy("q", "r").agg(F.sum("_n").alias("_n"))
    out = held.join(beside, ["q", "r"], "left").select("q", "r", "s.name", "s.kind", "n", "people", (F.col("n") + F.coalesce("_n", F.lit(0))).alias("crowd"))
    return tiled(out, side)


def ingest_settlements(spark: SparkSession, parts: str, layer: str, out: str, checkpoint: str, size: float, meridian: float, side: int = 16) -> None:
    """Keep the records of settled hexes up with newly landed elements.

    ``layer`` is partitioned by tile and batch, ``out`` by tile.  A batch adds
    its places to their tiles, and then makes anew the records of the tiles
    within one hex of them, from the places of these and of the tiles around:
    partitions that the batch does not reach are neither read nor written, and
    a batch that is run again writes the same.
    """

    def change(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        made = elements.settlement_layer(layers.parse_osm_elements(batch, "value"))
        made = tiled(hexes.with_hex(made, size, meridian), side)
        made = made.select("osm_id", "name", classify.settlement_type(F.col("place_type"), F.col("population")).alias("kind"), "population", "q", "r", *TILE, F.lit(number).cast("long").alias("batch"))
        write = lambda df, path, *by: df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
        # dealt by tile, in shares, so that a tile has few files and none of them is all of a dense one
        write(made.repartition(*TILE, F.pmod(F.xxhash64("osm_id"), F.lit(SHARES))), layer, *TILE, "batch")
        held = session.read.schema(made.schema).parquet(layer)
        touched = around(held.filter(F.col("batch") == number), side, 1)
        near = touched.select(F.explode(F.sequence(F.col("tile_q") - 1, F.col("tile_q") + 1)).alias("tile_q"), "tile_r").select("tile_q", F.explode(F.sequence(F.col("tile_r") - 1, F.col("tile_r") + 1)).alias("tile_r")).distinct()
        # the tiles of a batch prune the layer's partitions
        whole = records(held.join(near, TILE, "left_semi"), side)
        write(whole.join(touched, TILE, "left_semi").repartition(*TILE), out, *TILE)

    run(arrivals(spark, parts), change, checkpoint)


def touched_tiles(spark: SparkSession, table: str, since: int) -> DataFrame:
    """tile_lon, tile_lat of elements that batches from ``since`` on added."""
    return spark.read.parquet(table).filter(F.col("batch") >= since).select("tile_lon", "tile_lat").distinct()


def require_parts(expected: DataFrame, landed: DataFrame, key: str = "part") -> None:
    """Fail when an expected part has not landed."""
    missing = [r[0] for r in expected.select(key).distinct().join(landed.select(key), key, "left_anti").orderBy(key).limit(5).collect()]
    if missing:
        raise FileNotFoundError(f"parts that have not landed, such as {missing}")

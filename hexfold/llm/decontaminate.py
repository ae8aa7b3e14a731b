"""Benchmark decontamination: size-partitioned MinHash containment search, Spark expressions only.

Texts are lower-cased and split at anything but letters and digits; a set is
that of the five-word shingles.  An item of n shingles is contained in a
document that holds at least ``percent`` of them, so such a document holds one
of the item's ``n - ceil(percent n) + 1`` least-hashed shingles: these are its
sketch, and no contained item is missed.  Items are partitioned by size (powers
of two).  A document asks only the partitions whose items it is long enough to
contain, and asks each of them only for its shingles under the largest sketch
value of that partition: long items have narrow sketches, so few shingles are
looked up there, whatever short items need.  Candidates are then verified on
the shingles themselves.

The sketch table is broadcast when it has at most ``BROADCAST_ROWS`` rows (24
bytes each), else joined by shuffle; there are at most 32 partitions.  Items of fewer than five words have no
shingle and are found nowhere; null texts are empty; documents and items
without an id are left out; rows that repeat an id and text count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexfold.llm.common import written

SHINGLE = 5
PERCENT = 80
BROADCAST_ROWS = 1_000_000
SPLIT = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SPLIT), "")


def _each(words: Column, make) -> Column:
    """``make(first word's number)`` for every shingle of an array of words; none if it is too short."""
    return F.transform(F.slice(F.sequence(F.lit(0), F.size(words)), F.lit(1), F.greatest(F.lit(0), F.size(words) - SHINGLE + 1)), make)


def hashes(words: Column) -> Column:
    return _each(words, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]))


def shingles(words: Column) -> Column:
    return F.array_distinct(_each(words, lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(SHINGLE)])))


def sketch(items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """h, item_id, part: the least hashes of each item (columns item_id, words)."""
    values = items.select("item_id", F.array_sort(F.array_distinct(hashes(F.col("words")))).alias("all")).filter(F.size("all") > 0)
    n = F.size("all")
    return values.select("item_id", F.floor(F.log2(n)).cast("int").alias("part"), F.explode(F.slice("all", F.lit(1), (n - F.ceil(n * percent / 100) + 1).cast("int"))).alias("h"))


def contained(docs: DataFrame, items: DataFrame, percent: int = PERCENT, text: str = "text") -> DataFrame:
    """doc_id, item_id, n_item, n_shared, containment of each item that a document contains.

    ``items`` has item_id and text.
    """
    docs = docs.select("doc_id", F.col(text).alias("text")).filter("doc_id is not null")
    items = items.filter("item_id is not null").select("item_id", words(F.col("text")).alias("words"))
    table = written(sketch(items, percent), "sketch")
    parts = sorted(tuple(r) for r in table.groupBy("part").agg(F.max("h").alias("bound"), F.count(F.lit(1)).alias("rows")).collect())
    if not parts:
        parts = [(0, -(1 << 63), 0)]
    small = F.broadcast if sum(rows for _, _, rows in parts) <= BROADCAST_ROWS else (lambda df: df)
    # a part is asked for shingles up to its bound, by documents that hold the least of its items
    each = docs.select("doc_id", words(F.col("text")).alias("w"))
    each = each.select("doc_id", (F.size("w") - SHINGLE + 1).alias("n"), F.explode(hashes(F.col("w"))).alias("h"))
    each = each.filter(F.col("h") <= max(bound for _, bound, _ in parts))
    asked = [F.when((F.col("h") <= bound) & (F.col("n") >= -(-(1 << p) * percent // 100)), p) for p, bound, _ in parts]
    each = each.select("doc_id", "h", F.explode(F.array(*asked)).alias("part")).filter("part is not null")
    found = written(each.join(small(table.select("part", "h", "item_id")), ["part", "h"]).select("doc_id", "item_id").distinct(), "candidates")
    held = docs.join(found.select("doc_id").distinct(), "doc_id", "left_semi")
    held = held.select("doc_id", words(F.col("text")).alias("w")).select("doc_id", shingles(F.col("w")).alias("ds"))
    # written, so that its own bytes decide how it is joined
    wanted = written(items.select("item_id", shingles(F.col("words")).alias("qs")), "items")
    both = held.join(found, "doc_id").join(wanted, "item_id")
    shared = F.size(F.array_intersect("ds", "qs")).cast("long")
    out = both.select("doc_id", "item_id", F.size("qs").cast("long").alias("n_item"), shared.alias("n_shared"))
    out = out.filter(F.col("n_shared") * 100 >= F.col("n_item") * percent).distinct()
    return out.select("*", F.round(F.col("n_shared") / F.col("n_item"), 6).alias("containment"))


ORACLE_SQL = r"""
WITH dw AS (
  SELECT DISTINCT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents WHERE doc_id IS NOT NULL),
iw AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark WHERE item_id IS NOT NULL),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM dw),
qs AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM iw),
n AS (SELECT item_id, count(*) AS n_item FROM qs GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN qs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_shared, round(n_shared / n_item, 6) AS containment
FROM m JOIN n USING (item_id) WHERE n_shared * 100 >= n_item * 80
"""

"""Table operators: diffs, fingerprints, gates, precedence, selections."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def diff(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """field, n: rows only in a, only in b, and differences by column of rows in both."""
    fields = [c for c in a.columns if c not in keys]
    pick = lambda df, s: df.select(*keys, F.lit(True).alias(f"_{s}"), *[F.col(c).alias(f"{s}_{c}") for c in fields])
    both = pick(a, "a").join(pick(b, "b"), keys, "full_outer")
    there = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    sums = [("only_a", F.col("_b").isNull()), ("only_b", F.col("_a").isNull()), *[(c, there & ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))) for c in fields]]
    one = both.agg(*[F.count_if(c).alias(n) for n, c in sums])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("n")) for n, _ in sums])).alias("e")).select("e.field", "e.n")


def first_differences(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """field, n, ``keys``: every column in which rows of both differ, how often, and the least key of them."""
    fields = [c for c in a.columns if c not in keys]
    pick = lambda df, s: df.select(*keys, *[F.col(c).alias(f"{s}_{c}") for c in fields])
    both = pick(a, "a").join(pick(b, "b"), keys)
    changed = F.filter(F.array(*[F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), F.lit(c)) for c in fields]), lambda c: c.isNotNull())
    each = both.select(F.struct(*keys).alias("_key"), F.explode(changed).alias("field"))
    return each.groupBy("field").agg(F.count(F.lit(1)).alias("n"), F.min("_key").alias("_key")).select("field", "n", "_key.*")


def leaves(df: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, path, value: every leaf of every row, as text, null as null.

    Fields of structs are named with dots, places of arrays and keys of maps in
    brackets; an empty array or map is a leaf too.  The walk is over the
    schema, so one pass makes all leaves.
    """
    leaf = lambda path, value: F.array(F.struct(path.alias("path"), value.cast("string").alias("value")))

    def walk(value: Column, kind: T.DataType, path: Column) -> Column:
        if isinstance(kind, T.StructType):
            own = F.concat(*[walk(value[f.name], f.dataType, F.concat(path, F.lit(f".{f.name}"))) for f in kind.fields])
            return F.when(value.isNull(), leaf(path, F.lit(None))).otherwise(own)
        if isinstance(kind, T.ArrayType):
            each = F.flatten(F.transform(value, lambda x, i: walk(x, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))))
            return F.when(F.coalesce(F.size(value) > 0, F.lit(False)), each).otherwise(leaf(path, F.when(value.isNotNull(), "[]")))
        if isinstance(kind, T.MapType):
            each = F.flatten(F.transform(F.map_entries(value), lambda e: walk(e["value"], kind.valueType, F.concat(path, F.lit("["), e["key"].cast("string"), F.lit("]")))))
            return F.when(F.coalesce(F.size(value) > 0, F.lit(False)), each).otherwise(leaf(path, F.when(value.isNotNull(), "{}")))
        return leaf(path, value)

    fields = [f for f in df.schema.fields if f.name not in keys]
    every = F.concat(*[walk(F.col(f"`{f.name}`"), f.dataType, F.lit(f.name)) for f in fields])
    return df.select(*keys, F.explode(every).alias("l")).select(*keys, "l.path", "l.value")


def diff_leaves(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """path, n, ``keys``, a, b: the leaves in which rows of both tables differ, how often, and the first example (least keys).

    Rows that only one table has count under the paths ``only a`` and ``only b``
    once each.  A leaf that only one row has (a longer array, another key) is
    null in the other.
    """
    there = a.select(*keys).withColumn("_a", F.lit(True)).join(b.select(*keys).withColumn("_b", F.lit(True)), keys, "full_outer")
    alone = there.filter("_a is null or _b is null").select(*keys, F.when(F.col("_a").isNull(), "only b").otherwise("only a").alias("path"), F.lit(None).cast("string").alias("va"), F.lit(None).cast("string").alias("vb"))
    side = lambda df, other, name: leaves(df.join(other.select(*keys), keys, "left_semi"), keys).withColumnRenamed("value", name)
    both = side(a, b, "va").join(side(b, a, "vb"), [*keys, "path"], "full_outer").filter("not va <=> vb").select(*keys, "path", "va", "vb")
    return both.union(alone).groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*keys, "va", "vb")).alias("m")).select("path", "n", *[F.col(f"m.{k}").alias(k) for k in keys], F.col("m.va").alias("a"), F.col("m.vb").alias("b"))


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: count and two marks, the same for the same rows in any order and number.

    A row's columns, by name and as text, are written with their lengths before
    them, null as a mark of its own; two parts of 60 bits of the SHA-256 of that
    are added up over all rows, modulo 2**60.  So rows that occur twice count
    twice, and no two ways of dividing a text into columns are alike.
    """
    own = lambda c: F.concat(F.length(c).cast("string"), F.lit(":"), c)
    text = F.concat(F.lit("-"), *[F.coalesce(own(F.col(c).cast("string")), F.lit("-")) for c in sorted(df.columns)])
    part = lambda at: F.conv(F.substring(F.sha2(text, 256), at, 15), 16, 10).cast("decimal(38,0)")
    total = lambda at: F.coalesce(F.sum(part(at)) % F.lit(1 << 60).cast("decimal(38,0)"), F.lit(0)).cast("long")
    return df.agg(F.count(F.lit(1)).alias("n"), total(1).alias("mark_a"), total(16).alias("mark_b"))


def order_statistic(df: DataFrame, value: str, share: float, parts: int = 1024) -> float | None:
    """The value of rank floor(share (n - 1)) in order, nulls and what is no number left out; None where there is none.

    A range of values is counted in ``parts``, and the part that holds the rank
    is the next range, until it is one value; no task sorts and no more than
    ``parts`` rows are sent.  Infinite values are counted beside the ranges.
    """
    inf = float("inf")
    known = df.select(F.col(value).cast("double").alias("v")).filter("v is not null and not isnan(v)").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    finite = (F.col("v") > -inf) & (F.col("v") < inf)
    low, high, n, least, most = known.agg(F.min(F.when(finite, F.col("v"))), F.max(F.when(finite, F.col("v"))), F.sum("n"), *[F.coalesce(F.sum(F.when(F.col("v") == e, F.col("n"))), F.lit(0)) for e in (-inf, inf)]).first()
    if not n:
        return None
    rank = math.floor(share * (n - 1))
    if rank < least or rank >= n - most:
        return -inf if rank < least else inf
    rank -= least
    while low < high:
        part = F.floor((F.col("v") / 2 - low / 2) / (high / 2 - low / 2) * (parts - 1))
        for r in sorted(known.filter(F.col("v").between(low, high)).groupBy(part.alias("p")).agg(F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()):
            if rank < r.n:
                low, high = r.low, r.high
                break
            rank -= r.n
    return low


def gates(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """name, ok, bad: every rule as the number of rows that break it, in one pass."""
    one = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), (F.col(n) == 0).alias("ok"), F.col(n).alias("bad")) for n in rules])).alias("e")).select("e.*")


def precedence(layers: list[DataFrame], keys: list[str], value: str) -> DataFrame:
    """One value per key: of the first layer that has it; ties in a layer by value."""
    ranked = reduce(DataFrame.union, [x.select(*keys, F.lit(i).alias("_i"), F.col(value).alias(value)) for i, x in enumerate(layers)])
    return ranked.groupBy(*keys).agg(F.min(F.struct("_i", value)).alias("m")).select(*keys, F.col(f"m.{value}").alias(value))


def valid_at(df: DataFrame, date, start: str = "start", end: str = "end") -> DataFrame:
    """Rows with start <= date < end; no end is open, no start is an error."""
    checked = F.when(F.col(start).isNull(), F.raise_error(F.lit("a row has no start"))).otherwise(F.col(start))
    return df.filter((checked <= F.lit(date)) & (F.lit(date) < F.coalesce(F.col(end), F.lit("9999-12-31"))))


def long_names(segments: DataFrame, name: str, metres: str, least: float) -> DataFrame:
    """Names whose segments add up to more than ``least`` metres."""
    return segments.groupBy(name).agg(F.sum(metres).alias("metres")).filter(F.col("metres") > least)


def open_ends(segments: DataFrame) -> DataFrame:
    """fid, x, y of endpoints met an odd number of times: rings there do not close."""
    ends = segments.select("fid", F.explode(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))).alias("e"))
    return ends.groupBy("fid", "e.x", "e.y").agg(F.count(F.lit(1)).alias("n")).filter("n % 2 = 1").select("fid", "x", "y")

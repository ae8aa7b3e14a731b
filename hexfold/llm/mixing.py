"""Mixing sources to target weights by entropy balancing.

Every document has a rate, the expected number of times that the mix takes it.
Of all rates up to ``most`` whose words add up to their source's target, those
that are nearest to taking each document once (least relative entropy) are
``min(most, exp(l x))``, where x is a document's size over its source's mean and
l, one number a source, solves the convex dual.  All duals take a Newton step a
round, from sums over a table of distinct sizes, which is the only thing that a
round reads; a bracket keeps each step inside what earlier rounds have shown.
Where a source is cut, long documents go first, so the fewest documents go;
where it is repeated, long ones are repeated first.

Rates become copies by sums over all documents in the order of source and size:
a document is taken as often as the sum of rates passes a whole number on it,
which leaves a source off by no more than its largest documents.  Sources that
are small enough to see that are mended by documents that fit what is left.
Rates are integers of 2**-20 and their sums are exact, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexfold.llm.common import Scratch, kept_name, passes, word_spans, written
from hexfold.llm.ordering import running

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
MADE = ["size", "source_size", "target", "taken", "copies"]
UNIT = 1 << 20  #: of rates
CLOSE = 1e-6  #: relative error of words at which a dual is solved
NEAR = 1e-3  #: relative error of words at which a source is not mended


def sizes(docs: DataFrame, name: str, source: str, text: str) -> DataFrame:
    """_id, _source, _size: the words ``[^\\x20\\x09-\\x0D]+`` of every text; null has none."""
    given = docs.select(F.col(name).alias("_id"), F.col(source).alias("_source"), F.col(text).alias("_text"))

    def count(batches):
        for rows, data, offsets in passes(batches, "_text"):
            yield pa.RecordBatch.from_arrays([rows.column("_id"), rows.column("_source"), pa.array(np.diff(word_spans(data, offsets)[2]).astype(np.int64))], names=["_id", "_source", "_size"])

    kind = lambda c: given.schema[c].dataType.simpleString()
    return given.mapInArrow(count, f"_id {kind('_id')}, _source {kind('_source')}, _size long")


def targets(sources: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sources`` (_words, _weight) with _target: ``share`` of all words by weight, none above ``most`` times its own.

    What is above is shared again by weight, so every source gets its weight
    times one level or its most; the level rises until no more sources reach it.
    """
    top = F.col("_words") * float(most)
    words, weights = sources.agg(F.sum(F.col("_words").cast("decimal(38,0)")), F.sum("_weight")).first()
    whole = float(words or 0) * share
    level = whole / weights if weights else 0.0
    while whole:
        full = top < F.col("_weight") * level
        taken, left = sources.agg(F.sum(F.when(full, F.col("_words").cast("decimal(38,0)"))), F.sum(F.when(~full, F.col("_weight")))).first()
        higher = (whole - float(taken or 0) * most) / left if left else level
        if higher <= level:
            break
        level = higher
    return sources.withColumn("_target", F.least(top, F.col("_weight") * level))


def rate(most: int = MOST) -> Column:
    """A document's rate in units, from its size and its source's _dual and _mean."""
    return F.rint(F.least(F.lit(float(most)), F.exp(F.col("_dual") * F.col("_size") / F.col("_mean"))) * UNIT).cast("long")


def solved(cells: DataFrame, sources: DataFrame, scratch: Scratch, most: int = MOST) -> DataFrame:
    """``sources`` (_s, _words, _docs, _target) with _dual and _mean.

    ``cells``: _s, _size, _n, the documents of each size.  A source whose
    target is all that it can give has a dual that puts every rate at ``most``.
    """
    c = F.col
    mean = F.when(c("_words") > 0, c("_words") / c("_docs")).otherwise(1.0)
    full = (c("_target") >= c("_words") * float(most)) & (c("_words") > 0)
    start = {"_mean": mean, "_dual": F.when(full, 1e9).otherwise(0.0), "_low": F.lit(None).cast("double"), "_high": F.lit(None).cast("double"), "_done": full | (c("_words") == 0)}
    duals = scratch.written(sources.withColumns(start), "duals")
    while not duals.filter("not _done").isEmpty():
        each = cells.join(duals.filter("not _done").select("_s", "_dual", "_mean"), "_s").withColumn("_r", rate(most))
        words = (c("_n") * c("_size")).cast("decimal(20,0)")
        sums = each.groupBy("_s").agg(F.sum(words * c("_r").cast("decimal(10,0)")).alias("_got"), F.sum(F.when(c("_r") < most * UNIT, words * (c("_size") * c("_r")).cast("decimal(18,0)"))).alias("_slope"))
        e = duals.join(sums, "_s", "left")
        e = e.withColumns({"_error": c("_got").cast("double") / UNIT - c("_target"), "_steep": F.coalesce(c("_slope").cast("double"), F.lit(0.0)) / UNIT / c("_mean")})
        e = e.withColumns({"_low": F.when(c("_error") < 0, c("_dual")).otherwise(c("_low")), "_high": F.when(c("_error") >= 0, c("_dual")).otherwise(c("_high"))})
        newton = F.when(c("_steep") > 0, c("_dual") - c("_error") / c("_steep"))
        inside = (newton > F.coalesce("_low", F.lit(float("-inf")))) & (newton < F.coalesce("_high", F.lit(float("inf"))))
        wider = F.when(c("_low").isNull(), c("_high") - 1 - F.abs("_high")).when(c("_high").isNull(), c("_low") + 1 + F.abs("_low")).otherwise((c("_low") + c("_high")) / 2)
        ends = (F.abs("_error") <= CLOSE * c("_target")) | F.coalesce(c("_high") - c("_low") <= 1e-12 * (1 + F.abs("_high")), F.lit(False))
        step = {"_dual": F.when(c("_done") | ends, c("_dual")).when(inside, newton).otherwise(wider), "_done": c("_done") | ends}
        duals = scratch.written(e.withColumns(step).select(*duals.columns), "duals")
    return duals.drop("_low", "_high", "_done")


def mends(taken: DataFrame, sources: DataFrame, most: int = MOST, near: float = NEAR) -> DataFrame:
    """_s, _size, _copies, _more, _m: how many documents of which size take one copy more (or less).

    ``taken``: _s, _size, _copies, _n.  Only sources that are off by more than
    ``near`` are looked at, and only sizes up to what they are off by, which is
    no more than a few of their largest documents: so a group has at most as
    many rows as such a document has words.
    """
    c = F.col
    got = taken.groupBy("_s").agg(F.sum(c("_n") * c("_size") * c("_copies")).alias("_got"))
    off = sources.join(got, "_s").withColumn("_off", F.rint(c("_target") - c("_got")).cast("long")).filter(F.abs("_off") > near * c("_target"))
    fits = taken.join(off.select("_s", "_off"), "_s").filter((c("_size") > 0) & (c("_size") <= F.abs("_off")))
    fits = fits.filter(F.when(c("_off") > 0, c("_copies") < most).otherwise(c("_copies") > 0))

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        off, sign = abs(int(group["_off"].iloc[0])), 1 if group["_off"].iloc[0] > 0 else -1
        group = group.assign(_by=group["_copies"] * sign).sort_values(["_size", "_by"], ascending=[False, True])
        out = []
        for s, size, copies, n in zip(group["_s"], group["_size"], group["_copies"], group["_n"], strict=True):
            m = min(int(n), off // int(size))
            if m:
                out.append((s, size, copies, sign, m))
                off -= m * int(size)
        return pd.DataFrame(out, columns=["_s", "_size", "_copies", "_more", "_m"])

    return fits.groupBy("_s").applyInPandas(fill, "_s long, _size long, _copies long, _more long, _m long")


def mixed(docs: DataFrame, name: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``name``, size, source_size, target, taken, copies of every row of ``docs``.

    Sources in the order of code points, null last, have ``weights`` in turn;
    rows without a source are a source.  Rows that share a name, and rows
    without one, count each; a ``name`` like a made column's is returned as
    ``<name>_in``.  Texts without words (null ones too) take nothing;
    without any words all targets are 0, and no rows give none.
    """
    c = F.col
    with Scratch(docs.sparkSession) as scratch:
        sized = scratch.written(sizes(docs, name, source, text), "sizes")
        found = scratch.written(sized.groupBy("_source", "_size").agg(F.count(F.lit(1)).alias("_n")), "cells")
        sources = found.groupBy("_source").agg(F.sum(c("_n") * c("_size")).alias("_words"), F.sum("_n").alias("_docs")).withColumn("_one", F.lit(1).cast("long"))
        sources = running(sources, [c("_source").isNull(), c("_source")], "_one", scratch, "sources").drop("_one").withColumnRenamed("_before", "_s")
        of = F.array(*[F.lit(float(w)) for w in weights])[F.pmod("_s", F.lit(len(weights))).cast("int")]
        sources = scratch.written(targets(sources.withColumn("_weight", of), share, most), "targets")
        same = lambda a, b: a["_source"].eqNullSafe(b["_source"])
        keys = sources.select(c("_source").alias("_k"), "_s")
        cells = scratch.written(found.join(keys, found["_source"].eqNullSafe(keys["_k"])).select("_s", "_size", "_n"), "cells")
        duals = solved(cells, sources.drop("_source"), scratch, most)
        by_source = sources.select("_source", "_s").join(duals.select("_s", "_words", "_target", "_dual", "_mean"), "_s")
        rated = sized.join(by_source, same(sized, by_source)).select("_id", "_size", "_s", "_words", "_target", rate(most).alias("_r"))
        summed = running(rated, [c("_s"), c("_size"), F.xxhash64("_id"), c("_id")], "_r", scratch, "rates")
        passed = lambda at: F.expr(f"({at} + {UNIT // 2}) div {UNIT}")
        copied = scratch.written(summed.withColumn("_copies", (passed("_before + _r") - passed("_before")).cast("long")), "copies")
        cell = ["_s", "_size", "_copies"]
        more = scratch.written(mends(copied.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")), duals, most), "mends")
        if not more.isEmpty():
            these = copied.join(more, cell).withColumn("_one", F.lit(1).cast("long")).drop("_before")
            these = running(these, [c("_s"), c("_size"), c("_copies"), F.xxhash64("_id"), c("_id")], "_one", scratch, "mended")
            first = these.groupBy(*cell).agg(F.min("_before").alias("_first"))
            these = these.join(first, cell).withColumn("_copies", c("_copies") + F.when(c("_before") - c("_first") < c("_m"), c("_more")).otherwise(0))
            copied = copied.join(more, cell, "left_anti").select(*rated.columns, "_copies").union(these.select(*rated.columns, "_copies"))
        out = copied.select(c("_id").alias(kept_name(name, MADE)), c("_size").alias("size"), c("_words").alias("source_size"), c("_target").alias("target"), (c("_size") * c("_copies")).alias("taken"), c("_copies").cast("int").alias("copies"))
        return written(out, "mix")

"""Near-duplicate documents: bottom-k sketches of one hash, inverted lists, exact checks.

A document's set is that of its distinct word shingles, as 64-bit hashes; its
sketch is the ``K`` least.  Documents with one set form a class and are
compared once.  Two sets of similarity ``percent`` share at least ``o`` values
of their sketches (``o`` is 5.3 deviations below the mean for large sets, the
exact bound for sets that are their own sketch), so under any common order
they share one among the first ``size - o + 1``.  Rarest first, these prefixes
make the inverted lists; a value that many unrelated documents hold is in
hardly any prefix.

No list is expanded into its pairs.  In a round, every list's leader (first
the member whose values are most common, then one by hash) is compared with
the members that are not yet in its component; the estimate from the union's
sketch filters, the full sets decide.  What is still apart in some list then
gets exact prefixes, of the full sets and by their rarest shingles: a variant
with too many words of its own is in no list of these.  There, members outside
their list's largest component are compared with all members of other
components, so no link between components is missed.

A pair that shares several lists is met in the first of them, by the ``EARLY``
values that each member brings along from the lists before.

Empty and null texts have no shingle and no links.  A row without doc_id is
returned with null component and kept false, and links nothing; rows that
share a doc_id are one node, so all classes that a doc_id is in are linked,
and its rows without shingles go with them.  No rows give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexfold.llm.common import LOWER, mixed, passes, prefix_hash, signed, span_hash, word_spans, written
from hexfold.llm.components import components

K = 32
ROUNDS = 3
BITS = 512
EARLY = 64
_MULTIPLIERS = np.random.default_rng(23).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and where each text's begin."""
    starts, ends, first = word_spans(data, offsets)
    words = span_hash(prefix_hash(LOWER[data]), starts, ends)
    number = np.diff(first)
    text = np.repeat(np.arange(len(number)), number)
    left = np.repeat(first[1:], number) - np.arange(len(words))  # words to the text's end
    head = (left >= size) | (np.arange(len(words)) == first[:-1][text])
    at = np.flatnonzero(head)
    hashes = np.minimum(left[at], size).astype(np.uint64) * _MULTIPLIERS[size]
    for k in range(size):
        ok = left[at] > k
        hashes[ok] += words[at[ok] + k] * _MULTIPLIERS[k]
    hashes = mixed(hashes)
    bounds = np.searchsorted(at, first)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        hashes[a:b].sort()
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = hashes[1:] != hashes[:-1]
    fresh[bounds[:-1][bounds[:-1] < len(hashes)]] = True
    kept = np.concatenate(([0], np.cumsum(fresh)))
    return hashes[fresh], kept[bounds]


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(signed(values)))


def _marks(values: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
    """Two sums over each set, which tell sets apart."""
    sums = [np.concatenate(([np.uint64(0)], np.cumsum(v))) for v in (values, mixed(values ^ _MULTIPLIERS[63]))]
    return [pa.array((s[bounds[1:]] - s[bounds[:-1]]).view(np.int64)) for s in sums]


def class_number() -> F.Column:
    """A class's number, of its sums and size."""
    return F.xxhash64("f1", "f2", "n")


def sketches(docs: DataFrame, size: int, text: str = "text", k: int = K) -> DataFrame:
    """doc_id, n, two fingerprints of the set, and the sketch (least values, ascending)."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("_text"))

    def run(batches):
        for batch, data, offsets in passes(batches, "_text"):
            values, bounds = shingle_sets(data, offsets, size)
            n = np.diff(bounds)
            text_of = np.repeat(np.arange(len(n)), n)
            low = np.arange(len(values)) - bounds[:-1][text_of] < k
            cut = np.concatenate(([0], np.cumsum(np.minimum(n, k))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n.astype(np.int64)), *_marks(values, bounds), _lists(values[low], cut)],
                names=["doc_id", "n", "f1", "f2", "sketch"],
            )

    return source.mapInArrow(run, "doc_id long, n long, f1 long, f2 long, sketch array<long>")


def full_sets(docs: DataFrame, size: int, text: str = "text") -> DataFrame:
    """cid (the class), its full set, and a bitmap of which hash remainders occur oddly often in it."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("_text"))

    def run(batches):
        for batch, data, offsets in passes(batches, "_text"):
            values, bounds = shingle_sets(data, offsets, size)
            n = len(bounds) - 1
            text_of = np.repeat(np.arange(n), np.diff(bounds))
            odd = np.bincount(text_of * BITS + (values & np.uint64(BITS - 1)).astype(np.int64), minlength=n * BITS) & 1
            bits = np.packbits(odd.astype(np.uint8).reshape(n, BITS), axis=1).view(np.int64)
            bitmaps = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * (BITS // 64)), pa.array(bits.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.diff(bounds).astype(np.int64)), *_marks(values, bounds), _lists(values, bounds), bitmaps], names=["n", "f1", "f2", "shingles", "bits"])

    return source.mapInArrow(run, "n long, f1 long, f2 long, shingles array<long>, bits array<long>").select(class_number().alias("cid"), "shingles", "bits")


def least_overlap(percent: int, k: int = K) -> tuple[int, int]:
    """Largest set whose partners are all their own sketches; values that larger pairs share."""
    share = percent / 100
    return int(k * share) - 1, max(1, int(k * share - 5.3 * math.sqrt(k * share * (1 - share))))


def prefixes(each: DataFrame, length: F.Column, size: F.Column, early: int = 0) -> DataFrame:
    """v, cid, n, common of the first values of each cid, rarest first; lists of one left out.

    With ``early``, up to so many of the values that come before v, first ones
    first: two cids of a list that have one of them in common meet there too.

    ``each`` has cid, n and v; of the ``size`` values that a cid has, those
    held by no other come first and are counted, not listed.
    """
    shared = each.groupBy("v").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    held = each.join(shared, "v").groupBy("cid", "n").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("h"), F.sum("df").alias("common"))
    left = F.greatest(F.lit(0), length - (size - F.size("h"))).cast("int")
    firsts = [F.transform(F.slice("h", F.lit(1), F.lit(early)), lambda e: e["v"]).alias("firsts")] if early else []
    index = held.select("cid", "n", "common", *firsts, F.posexplode(F.slice("h", F.lit(1), left)).alias("p", "e"))
    before = [F.slice("firsts", F.lit(1), F.least(F.col("p"), F.lit(early))).alias("early")] if early else []
    index = index.select(F.col("e.v").alias("v"), "cid", "n", "common", *before)
    index = written(index, "prefixes")
    lists = index.groupBy("v").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    return written(index.join(lists, "v").select(*index.columns), "index")


def inverted(classes: DataFrame, percent: int, k: int = K) -> DataFrame:
    """The lists of the sketches' prefixes."""
    small, shared = least_overlap(percent, k)
    overlap = F.when(F.col("n") <= small, F.ceil(F.col("n") * percent / 100)).otherwise(shared)
    size = F.least(F.col("n"), F.lit(k))
    return prefixes(classes.select("cid", "n", F.explode("sketch").alias("v")), size - overlap + 1, size)


def exact(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Lists by full sets, of the cids that some list of ``members`` (v, cid, c) has in different components."""
    apart = members.groupBy("v").agg(F.min("c").alias("x"), F.max("c").alias("y")).filter("x <> y").select("v")
    wanted = members.join(apart, "v").select("cid").distinct()
    each = sets.join(wanted, "cid", "left_semi").select("cid", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("v"))
    return prefixes(each, F.col("n") - F.ceil(F.col("n") * percent / 100) + 1, F.col("n"), EARLY)


def verified(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, k: int = K) -> DataFrame:
    """The pairs a, b whose union sketch allows and whose full sets have the similarity."""
    _, shared = least_overlap(percent, k)
    a, b = (classes.select(F.col("cid").alias(x), F.col("sketch").alias(f"s{x}")) for x in "ab")
    near = pairs.join(a, "a").join(b, "b")
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    both = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
    near = written(near.filter(both * k >= F.size(union) * shared).select("a", "b"), "likely")
    a, b = (sets.select(F.col("cid").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab")
    full = near.join(a, "a").join(b, "b")
    inter = F.size(F.array_intersect("sa", "sb"))
    return full.filter(100 * inter >= percent * (F.size("sa") + F.size("sb") - inter)).select("a", "b")


def class_links(docs: DataFrame, classes: DataFrame, size: int, percent: int, given: DataFrame, text: str = "text") -> DataFrame:
    """node, component of the classes (by cid) that are linked with others, or by links ``given``."""
    index = inverted(classes, percent)
    wanted = classes.join(index.select("cid").distinct(), "cid", "left_semi").select("cid", "doc_id")
    sets = full_sets(docs.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi"), size, text)
    sets = written(sets.join(wanted.select("cid"), "cid", "left_semi").dropDuplicates(["cid"]), "sets")
    close = lambda x, y: (100 * F.least(x, y) >= percent * F.greatest(x, y))
    tested, links = None, given
    label = None if given.isEmpty() else components(given)

    def placed(lists: DataFrame) -> DataFrame:
        if label is None:
            return lists.withColumn("c", F.col("cid"))
        return lists.join(label, lists.cid == label.node, "left").select(*lists.columns, F.coalesce("component", "cid").alias("c"))

    for turn in range(ROUNDS + 1):
        members = placed(index)
        if turn < ROUNDS:
            first = -F.col("common") if turn == 0 else F.xxhash64(F.col("cid"), F.lit(turn))
            leaders = members.groupBy("v").agg(F.min(F.struct(first.alias("o"), F.col("cid").alias("x"), F.col("n").alias("xn"), F.col("c").alias("xc"))).alias("l")).select("v", "l.*")
            pairs = members.join(leaders, "v").filter((F.col("c") != F.col("xc")) & close(F.col("n"), F.col("xn")))
        else:
            members = placed(exact(members, sets, percent)).join(sets.select("cid", "bits"), "cid")
            members = written(members, "members")
            sizes = members.groupBy("v", "c").agg(F.count(F.lit(1)).alias("size"))
            main = sizes.groupBy("v").agg(F.max(F.struct("size", "c")).alias("m"), F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("v", F.col("m.c").alias("mc"))
            rest = members.join(main, "v").filter("c <> mc").select("v", F.col("cid").alias("x"), F.col("n").alias("xn"), F.col("c").alias("xc"), F.col("bits").alias("xbits"), F.col("early").alias("xearly"), "mc")
            # two sets differ in at least as many shingles as their bitmaps in bits
            apart = sum((F.bit_count(F.col("bits")[i].bitwiseXOR(F.col("xbits")[i])) for i in range(BITS // 64)), F.lit(0))
            alike = apart * (100 + percent) <= (100 - percent) * (F.col("n") + F.col("xn"))
            # of two members outside the largest component, one direction is enough
            pairs = members.join(rest, "v").filter((F.col("c") != F.col("xc")) & ((F.col("c") == F.col("mc")) | (F.col("cid") < F.col("x"))) & close(F.col("n"), F.col("xn")) & alike & ~F.arrays_overlap("early", "xearly"))
        pairs = pairs.select(F.least("cid", "x").alias("a"), F.greatest("cid", "x").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        found = written(verified(pairs, classes, sets, percent), "found")
        tested = pairs if tested is None else tested.union(pairs)
        links = links.union(found)
        label = components(links)
    return label


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``."""
    made = written(sketches(docs, size, text).withColumn("cid", F.when(F.col("n") > 0, class_number())), "sketches")
    known = made.filter("cid is not null and doc_id is not null")
    classes = written(known.groupBy("cid", "n").agg(F.min("doc_id").alias("doc_id"), F.first("sketch").alias("sketch")), "classes")
    several = known.groupBy("doc_id").agg(F.min("cid").alias("a"), F.max("cid").alias("b")).filter("a <> b").select("doc_id", "a")
    shared = written(known.join(several, "doc_id").filter("cid <> a").select("a", F.col("cid").alias("b")).distinct(), "shared")
    label = class_links(docs, classes, size, percent, shared, text)
    roots = classes.join(label, classes.cid == label.node, "left").select("cid", "doc_id", F.coalesce("component", "cid").alias("c"))
    least = roots.groupBy("c").agg(F.min("doc_id").alias("root"))
    roots = written(roots.join(least, "c").select("cid", "root"), "roots")
    out = made.select("doc_id", "n", "cid").join(roots, "cid", "left")
    # rows without shingles of a doc_id that has others
    empty = made.filter("cid is null and doc_id is not null").select("doc_id").distinct()
    others = known.join(empty, "doc_id", "left_semi").join(roots, "cid").groupBy("doc_id").agg(F.min("root").alias("other"))
    out = out.join(others, "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "other", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))

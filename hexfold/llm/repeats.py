"""Removal of repeated byte strings: sparse suffixes merged by interleave refinement.

Wanted: every byte covered by a string of ``LENGTH`` bytes that also starts
anywhere else.  Each window of that length is represented by its least-hashed
8-byte gram among its first ``REACH`` places; equal windows have equal
representatives at equal places, so only suffixes that begin at
representatives need comparing, about ``2 / REACH`` of all.  Each shard (a
pass over an input partition) lists its suffixes, equal ones as one row with
their places; the merge refines blocks of suffixes that agree to a growing
depth, and suffixes alone in their block retire.  A level names a suffix by

- the bytes common to all windows of a cell of it, its block, and
- the bytes from its first window's start to its last one's end, its context.

Where all of a block agree in context, all their windows are repeated, as they
are for contexts met twice; one suffix per distinct context of a block goes on
to the next level, with smaller ``CELLS`` of windows, down to single windows.
Blocks are named by 64-bit hashes, one at every level.  Counting is by partial
aggregation and equal suffixes of a shard are one row, so a string in a third
of all rows is no large group.  A task holds one pass of texts or one text.

Null texts are empty; texts shorter than ``LENGTH`` keep all; repeated rows
are repeats of each other; no rows give no rows; other columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexfold.llm.common import Scratch, mixed, passes, prefix_hash, prefix_sums, signed, span_hash, word_spans, written

LENGTH = 400
REACH = 256
GRAM = 8
SIZE = 1 << 20  #: bytes of text of a pass: the arrays of one are about 60 times as large
PASSAGE = 51  #: words


@dataclass(frozen=True)
class Unit:
    """What windows are made of, how long they are, and how many places a representative is chosen from."""

    length: int = LENGTH
    reach: int = REACH  #: a power of two; a gram at its last place must end within the window
    words: bool = False
    cells: tuple[int, ...] = (32, 1)  #: windows of a cell at the levels after the first

    def symbols(self, data: np.ndarray, offsets: np.ndarray):
        """Of a pass: where each text's symbols begin, prefix hashes of the symbols, their grams."""
        if not self.words:
            grams = np.ndarray((max(len(data) - GRAM + 1, 0),), "<u8", data.tobytes(), 0, (1,)).copy()
            return offsets, prefix_hash(data), mixed(grams)
        starts, ends, first = word_spans(data, offsets)
        codes = span_hash(prefix_hash(data), starts, ends)
        grams = mixed(codes[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[1:])  # of two words
        return first, prefix_sums(codes), grams

    def spans(self, data: np.ndarray, offsets: np.ndarray, p: np.ndarray, q: np.ndarray, row: np.ndarray):
        """Bytes from the start of each text's window ``p`` to the end of its window ``q``."""
        if not self.words:
            return p + offsets[:-1][row], q + offsets[:-1][row] + self.length
        starts, ends, first = word_spans(data, offsets)
        return (starts[p + first[:-1][row]], ends[q + first[:-1][row] + self.length - 1]) if len(row) else (p, q)


BYTES = Unit()
PASSAGES = Unit(PASSAGE, 32, True, (4, 1))


def representatives(grams: np.ndarray, offsets: np.ndarray, length: int = LENGTH, reach: int = REACH):
    """For each run of windows with one representative: text, first and last window, representative."""
    none = np.zeros(0, np.int64)
    if not len(grams):
        return none, none, none, none
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while step < reach and step < len(least):
        least = np.minimum(least[: len(least) - step], least[step:])
        step *= 2
    sizes = np.maximum(np.diff(offsets) - length + 1, 0)
    text = np.repeat(np.arange(len(sizes)), sizes)
    window = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + offsets[:-1][text]
    if not len(window):
        return none, none, none, none
    at = (least[window] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    fresh = np.ones(len(window), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(fresh)
    last = np.append(head[1:], len(window)) - 1
    return text[head], window[head], window[last], at[head]


def _keyed(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Rows with a key of identity and text; equal rows share it, and share what is found."""
    return docs.select(F.xxhash64(*keep, F.lit(1), text).alias("k"), F.xxhash64(text, *keep, F.lit(2)).alias("d"), F.col(text).alias("_text"), *keep)


PLACE = "k long, d long, at long"


def packed(first: np.ndarray, last: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """First window, further windows and distance to the suffix (under 65536 each) as one number."""
    return first << 32 | (last - first) << 16 | (suffix - first)


def suffixes(keyed: DataFrame, unit: Unit = BYTES) -> DataFrame:
    """name, context, n, one place, and all places if there are more, of a shard's distinct suffixes."""

    def run(batches):
        for batch, data, offsets in passes(batches, "_text", SIZE):
            offsets, prefix, grams = unit.symbols(data, offsets)
            text, first, last, at = representatives(grams, offsets, unit.length, unit.reach)
            name = span_hash(prefix, at, at + (unit.length - unit.reach + 1))
            context = mixed(span_hash(prefix, first, last + unit.length) + (at - first).astype(np.uint64))
            order = np.lexsort((context, name))
            name, context, text = name[order], context[order], text[order]
            fresh = np.ones(len(name), bool)
            fresh[1:] = (name[1:] != name[:-1]) | (context[1:] != context[:-1])
            head = np.flatnonzero(fresh)
            n = np.diff(np.append(head, len(name)))
            base = offsets[:-1][text]
            place = packed(first[order] - base, last[order] - base, at[order] - base)
            rows = pa.array(text)
            k, d, place = batch.column(0).take(rows), batch.column(1).take(rows), pa.array(place)
            many = np.repeat(n > 1, n)
            inner = pa.StructArray.from_arrays([x.filter(pa.array(many)) for x in (k, d, place)], names=["k", "d", "at"])
            bounds = pa.array(np.concatenate(([0], np.cumsum(np.where(n > 1, n, 0)))).astype(np.int32))
            more = pa.ListArray.from_arrays(bounds, inner, mask=pa.array(n <= 1))
            one = pa.array(head)
            yield pa.RecordBatch.from_arrays([pa.array(signed(name[head])), pa.array(signed(context[head])), pa.array(n.astype(np.int64)), k.take(one), d.take(one), place.take(one), more], names=["name", "context", "n", "k", "d", "at", "more"])

    return keyed.select("k", "d", "_text").mapInArrow(run, f"name long, context long, n long, {PLACE}, more array<struct<k: long, d: long, at: long>>")


def cells(keyed: DataFrame, wanted: DataFrame, size: int, unit: Unit = BYTES) -> DataFrame:
    """The wanted suffixes (places and n) as rows of a level: one per cell of ``size`` windows."""
    lists = wanted.groupBy("k", "d").agg(F.collect_list(F.struct("at", "n", "name")).alias("runs"))
    source = keyed.join(lists, ["k", "d"]).dropDuplicates(["k", "d"]).select("k", "d", "runs", "_text")

    def run(batches):
        for batch, data, offsets in passes(batches, "_text", SIZE):
            offsets, prefix, _ = unit.symbols(data, offsets)
            runs = batch.column("runs")
            each = runs.flatten()
            row = np.repeat(np.arange(batch.num_rows), np.asarray(runs.value_lengths()))
            at, n, parent = (each.field(f).to_numpy() for f in ("at", "n", "name"))
            first = (at >> 32) + offsets[:-1][row]
            last, suffix = first + (at >> 16 & 65535), first + (at & 65535)
            low, high = (first - suffix) // size, (last - suffix) // size
            which = np.repeat(np.arange(len(at)), high - low + 1)
            cell = np.arange(len(which)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1) + low[which]
            start = suffix[which] + cell * size  # of the cell's first window, which may be before the run
            p, q = np.maximum(start, first[which]), np.minimum(start + size - 1, last[which])
            name = mixed(span_hash(prefix, start + size - 1, start + unit.length) ^ parent[which].view(np.uint64) * np.uint64(3) + cell.astype(np.uint64))
            context = mixed(span_hash(prefix, p, q + unit.length) + (p - start).astype(np.uint64))
            rows = pa.array(row[which])
            base = offsets[:-1][row[which]]
            yield pa.RecordBatch.from_arrays([pa.array(signed(name)), pa.array(signed(context)), pa.array(n[which]), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(p - base << 32 | (q - p) << 16 | (suffix[which] - p))], names=["name", "context", "n", "k", "d", "at"])

    return source.mapInArrow(run, f"name long, context long, n long, {PLACE}")


def refined(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Rows of which all windows are repeated, and one row per context of blocks that differ in it."""
    blocks = rows.groupBy("name").agg(F.sum("n").alias("total"), F.min("context").alias("x"), F.max("context").alias("y")).filter("total > 1")
    alive = scratch.written(rows.join(blocks.select("name", (F.col("x") != F.col("y")).alias("parted")), "name"), "blocks")
    parted = alive.filter("parted")
    contexts = scratch.written(parted.groupBy("name", "context").agg(F.sum("n").alias("n"), F.min(F.struct("k", "d", "at")).alias("r")).select("name", "context", "n", "r.*"), "contexts")
    same = parted.join(contexts.filter("n > 1").select("name", "context"), ["name", "context"], "left_semi")
    return alive.filter("not parted").drop("parted").union(same.drop("parted").select(*alive.drop("parted").columns)), contexts


def repeated_runs(keyed: DataFrame, unit: Unit = BYTES) -> DataFrame:
    """k, d, p, q: runs of windows that start elsewhere too, as a written table."""
    with Scratch(keyed.sparkSession) as scratch:
        found, contexts = refined(scratch.written(suffixes(keyed, unit), "suffixes"), scratch)
        found = found.select(F.explode(F.coalesce("more", F.array(F.struct("k", "d", "at")))).alias("e")).select("e.*")
        for size in unit.cells:
            # contexts met twice are done, and stay as witnesses for the others
            done, contexts = refined(scratch.written(cells(keyed, contexts.select("k", "d", "at", "n", "name"), size, unit), "cells"), scratch)
            found = found.union(done.filter("n = 1").select("k", "d", "at"))
        p = F.shiftright("at", 32)
        return written(found.select("k", "d", p.alias("p"), (p + F.shiftright("at", 16).bitwiseAND(F.lit(65535))).alias("q")), "runs")


def covered(docs: DataFrame, units: tuple[Unit, ...], text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, kept (bytes outside the first unit's repeats), n_bytes, n_removed, n_spans, n_words_<i>.

    The last are the words that touch the repeats of the units after the first,
    which are counted and not removed.
    """
    keyed = _keyed(docs, text, list(keep))
    runs = reduce(DataFrame.union, [repeated_runs(keyed, unit).select("k", "d", F.lit(u).alias("u"), "p", "q") for u, unit in enumerate(units)])
    # single windows, of which a text can have as many as bytes, as bits of blocks of 64
    base, bit = F.shiftleft(F.shiftright("p", 6), 6), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))
    single = runs.filter("p = q").groupBy("k", "d", "u", base.alias("p")).agg(F.bit_or(bit).alias("bits"))
    runs = runs.filter("p < q").distinct().select("k", "d", F.struct("u", "p", "q", F.lit(0).cast("long").alias("bits")).alias("run")).union(single.select("k", "d", F.struct("u", "p", F.col("p").alias("q"), "bits")))
    runs = runs.groupBy("k", "d").agg(F.collect_list("run").alias("runs"))
    source = keyed.join(runs, ["k", "d"], "left").select("_text", "runs", *keep)
    counts = ["n_bytes", "n_removed", "n_spans", *[f"n_words_{u}" for u in range(1, len(units))]]
    schema = T.StructType([*source.schema.fields[2:], T.StructField("kept", T.BinaryType()), *[T.StructField(x, T.LongType()) for x in counts]])

    def run(batches):
        for batch, data, offsets in passes(batches, "_text", SIZE):
            runs, n = batch.column("runs"), batch.num_rows
            each = runs.flatten()
            row = np.repeat(np.arange(n), np.asarray(runs.value_lengths().fill_null(0)))
            which, p, q, bits = (each.field(f).to_numpy() if len(row) else np.zeros(0, np.int64) for f in ("u", "p", "q", "bits"))
            blocks = np.flatnonzero(bits)
            block, at = np.nonzero(np.unpackbits(np.ascontiguousarray(bits[blocks]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            block, whole = blocks[block], bits == 0
            row, which = (np.concatenate((v[whole], v[block])) for v in (row, which))
            p, q = (np.concatenate((v[whole], v[block] + at)) for v in (p, q))
            totals, kept = [], []
            for u, unit in enumerate(units):
                own = which == u
                start, end = unit.spans(data, offsets, p[own], q[own], row[own])
                change = np.zeros(len(data) + 1, np.int32)
                np.add.at(change, start, 1)
                np.add.at(change, end, -1)
                gone = np.cumsum(change[:-1]) > 0
                if u:
                    starts, _, first = word_spans(data, offsets)
                    totals.append(np.concatenate(([0], np.cumsum(gone[starts])))[first])
                    continue
                left = np.concatenate(([False], gone[:-1])) if len(gone) else gone
                edge = np.zeros(len(data) + 1, bool)
                edge[offsets] = True
                starts = gone & (~left | edge[:-1])
                totals += [np.concatenate(([0], np.cumsum(x)))[offsets] for x in (gone, starts)]
                kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            held = [batch.column(i) for i in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*held, pa.array(kept, pa.binary()), pa.array(np.diff(offsets)), *[pa.array(np.diff(t).astype(np.int64)) for t in totals]], names=schema.names)

    return source.mapInArrow(run, schema)


def cut(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), unit: Unit = BYTES) -> DataFrame:
    """``keep``, kept (the bytes that stay), n_bytes, n_removed, n_spans of every row."""
    return covered(docs, (unit,), text, keep)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's row per document, and the words that passages of over 50 words, met elsewhere too, cover."""
    made = covered(docs, (BYTES, PASSAGES)).withColumnRenamed("n_words_1", "n_passage_words")
    return made.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_passage_words")

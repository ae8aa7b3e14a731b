"""Packing by concatenate and cut: two passes of prefix sums, then fixed windows.

Pass one tokenises and numbers each document inside its input partition and
writes ids with partition-local offsets.  The totals of the partitions, one
number each, are summed up on the driver (8 bytes a partition); pass two adds
them and cuts the stream of all ids into windows, with a record per piece.
Row order is that of the written pass, so a lost executor changes nothing.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexfold.llm.common import held, written

WINDOW = 2048
END_ID = 1
MADE = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
CACHE_WORDS = 1_500_000
_caches: dict[str, Words] = {}


class Words(dict):
    """Ids, as bytes of uint16, of strings without white space, kept as met.

    White space never joins two of this vocabulary's pre-tokens and is dropped,
    so a text's ids are those of its parts between white space.  A part of
    printable ASCII is split by the vocabulary's own pattern and handed to its
    BPE model; any other part goes through the tokenizer whole.
    """

    # fixed value: the vocabulary's split pattern, narrowed to ASCII
    ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
    PRINTABLE = re.compile(r"[!-~]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.parts: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if self.PRINTABLE.fullmatch(word) and "<|" not in word:
            ids = b""
            for part in self.ASCII.findall(word.lower()):
                known = self.parts.get(part)
                if known is None:
                    known = self.parts[part] = np.array([t.id for t in self.model.tokenize(part)], "<u2").tobytes()
                ids += known
        else:
            ids = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u2").tobytes()
        self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        if len(self) > CACHE_WORDS:
            self.clear()
            self.parts.clear()
        if re.search("[\x1c-\x1f]", text):  # white space to Python alone
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()
        return b"".join(map(self.__getitem__, text.split()))


def words(path: str) -> Words:
    """One cache a worker process, kept from task to task."""
    if path not in _caches:
        _caches[path] = Words(path)
    return _caches[path]


def tokenised(docs: DataFrame, text: str, keep: list[str], vocabulary: str) -> DataFrame:
    """Pass one: ``keep`` and _part, _before (ids earlier in the partition), _n, _ids (uint16 bytes, end id included)."""
    source = docs.select(*held(docs, keep, MADE), F.col(text).alias("_text"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("_part", T.IntegerType()), T.StructField("_before", T.LongType()), T.StructField("_n", T.LongType()), T.StructField("_ids", T.BinaryType())])
    end = np.array([END_ID], "<u2").tobytes()

    def tokens(batches):
        known, part, before = words(vocabulary), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = [known.of(x or "") + end for x in batch.column("_text").to_pylist()]
            sizes = np.array([len(x) // 2 for x in ids], np.int64)
            starts = before + np.cumsum(sizes) - sizes
            before += int(sizes.sum())
            own = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(np.full(len(ids), part, np.int32)), pa.array(starts), pa.array(sizes), pa.array(ids, pa.binary())], names=schema.names)

    return source.mapInArrow(tokens, schema)


def pieces(tokens: DataFrame, keep: list[str], window: int = WINDOW) -> DataFrame:
    """Pass two over a written ``tokenised``: one boundary record per piece of a document in a window."""
    totals = sorted(tuple(r) for r in tokens.groupBy("_part").agg(F.max(F.col("_before") + F.col("_n"))).collect())
    ends = np.cumsum([n for _, n in totals], dtype=np.int64)
    base = tokens.sparkSession.sparkContext.broadcast({p: int(e - n) for (p, n), e in zip(totals, ends, strict=True)})
    source = tokens.select(*keep, "_part", "_before", "_n", "_ids")
    schema = T.StructType([*source.schema.fields[:-4], *[T.StructField(x, T.LongType()) for x in MADE]])

    def cut(batches):
        bases = base.value
        for batch in batches:
            parts, befores, sizes = (batch.column(c).to_numpy() for c in ("_part", "_before", "_n"))
            first = befores + np.array([bases[p] for p in parts.tolist()], np.int64)
            row, out = [], []
            for i, (at, n, raw) in enumerate(zip(first.tolist(), sizes.tolist(), batch.column("_ids"), strict=True)):
                wide = np.frombuffer(raw.as_buffer(), "<u2").astype("<u4")
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, window)
                    length = min(n - start, window - offset)
                    out.append((start, length, zlib.crc32(wide[start : start + length]), n, sequence, offset))
                    row.append(i)
                    start += length
            held = [batch.column(i).take(pa.array(row, pa.int64())) for i in range(batch.num_columns - 4)]
            columns = np.array(out, np.int64).reshape(-1, len(MADE))
            yield pa.RecordBatch.from_arrays([*held, *[pa.array(np.ascontiguousarray(columns[:, k])) for k in range(len(MADE))]], names=schema.names)

    return source.mapInArrow(cut, schema)


def packed(docs: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), window: int = WINDOW) -> DataFrame:
    """All documents as one stream of ids, cut every ``window`` ids.

    A null or empty text is its end id alone; equal rows are packed each;
    no rows give no pieces.  Only the last window is short of ``window`` ids.
    """
    tokens = written(tokenised(docs, text, list(keep), vocabulary), "tokens")
    return pieces(tokens, [c for c in tokens.columns if c not in ("_part", "_before", "_n", "_ids")], window)

"""Shared pieces: texts as byte arrays, vectorised hashes, written tables.

Executors work on Arrow batches.  A batch of texts is one byte array with
offsets, so word splitting and hashing are numpy passes over bytes and no
Python string is made per word.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession

#: bytes of text that one numpy pass works on; a longer text is a pass alone
PASS_BYTES = 1 << 19

_rng = np.random.default_rng(20250101)
BYTE_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 & ~7 | 5)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``); one of this machine only in local mode."""
    set_to = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not set_to:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        set_to = tempfile.mkdtemp(prefix="hexfold-")
        spark.sparkContext.setCheckpointDir(set_to)
    return set_to.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder, reread it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/hexfold-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """A folder of written tables that goes when its block ends; what outlives it is ``written`` before."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, f"{shared_dir(spark)}/hexfold-{uuid.uuid4().hex}"

    def __enter__(self) -> Scratch:
        return self

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def held(df: DataFrame, keep: Iterable[str], made: Iterable[str]) -> list[Column]:
    """Columns to keep beside those that an operator makes; one with a made column's name becomes ``<name>_in``."""
    taken = {*made, "_text"}
    return [df[c].alias(f"{c}_in" if c in taken else c) for c in keep]


def kept_name(name: str, made: Iterable[str]) -> str:
    """The name of a kept column beside those that an operator makes."""
    return f"{name}_in" if name in {*made} else name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def passes(batches: Iterator[pa.RecordBatch], column: str, size: int = PASS_BYTES):
    """Yield ``(slice of the batch, bytes, offsets)``; a null text is empty.  The bytes are those of the batch, uncopied."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column)
        if texts.null_count:
            texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        wide = pa.types.is_large_binary(texts.type) or pa.types.is_large_string(texts.type)
        ends = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, "right")) - 1)
            yield batch.slice(at, to - at), raw[ends[at] : ends[to]], ends[at : to + 1] - ends[at]
            at = to
        pa.default_memory_pool().release_unused()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        n = 1 << n.bit_length()
        with np.errstate(over="ignore"):
            _powers[:] = [np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, b, np.uint64)))) for b in (_BASE, _BASE_INV)]
    return _powers[0], _powers[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash of bytes; see ``span_hash``."""
    return prefix_sums(BYTE_CODES[data])


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """The same of any 64-bit codes, which it overwrites."""
    power, _ = powers(len(codes) + 1)
    out = np.zeros(len(codes) + 1, np.uint64)
    codes *= power[: len(codes)]
    np.cumsum(codes, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes ``[start, end)``, equal for equal bytes anywhere."""
    _, inverse = powers(len(prefix))
    return mixed((prefix[end] - prefix[start]) * inverse[start])


def mixed(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and for each text the number of words before it."""
    inside = ~SPACE[data]
    breaks = np.zeros(len(data) + 1, bool)
    breaks[offsets] = True
    before = np.concatenate(([False], inside))
    start = inside & (~before[:-1] | breaks[:-1])
    after = np.concatenate((inside[1:], [False]))
    end = inside & (~after[: len(data)] | breaks[1:])
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def signed(values: np.ndarray) -> np.ndarray:
    """uint64 as the int64 with the same order."""
    return (values ^ np.uint64(1 << 63)).view(np.int64)

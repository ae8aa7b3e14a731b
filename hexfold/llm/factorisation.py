"""Quality classifier: a factorisation machine over hashed words and text statistics.

A document is a sparse vector: hashed lower-cased words (counts on a log
scale, unit length), a dozen statistics of its bytes and words, and its length
as metadata.  The score is
``sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2))``,
the pairwise part in time linear in the non-zero entries.

The model is fitted on the driver from the vectors of at most ``SAMPLE``
labelled rows (those with the smallest hash of doc_id); every document is then
scored over its whole text.  Null texts are empty ones, a null ``n_chars`` is
the text's own length, and without any labelled row all scores are 0.5.
Equal rows get equal scores, a null doc_id is never learned from, no rows give
no rows, and a kept column named score becomes score_in.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexfold.llm.common import LOWER, held, passes, prefix_hash, span_hash, word_spans

SAMPLE = 6000
BUCKETS = 1 << 15
FACTORS = 8
STATISTICS = 14
EPOCHS = 6
RATE = 0.1
RIDGE = 1e-5

#: byte classes whose share of a text is a statistic
_CLASSES = np.zeros((8, 256), np.int32)
_CLASSES[0, 65:91] = 1
_CLASSES[1, 48:58] = 1
_CLASSES[2, [33, 63]] = 1
_CLASSES[3, [44, 46, 58, 59]] = 1
_CLASSES[4, [35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 92, 94, 95, 126]] = 1
_CLASSES[5, 124] = 1
_CLASSES[6, 10] = 1
_CLASSES[7, 128:] = 1


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def vectors(data: np.ndarray, offsets: np.ndarray, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row starts, feature numbers and values of the texts in a byte array."""
    n = len(offsets) - 1
    starts, ends, first = word_spans(data, offsets)
    prefix = prefix_hash(LOWER[data])
    hashes = span_hash(prefix, starts, ends)
    row = np.repeat(np.arange(n), np.diff(first))
    keys, counts = np.unique(row * BUCKETS + (hashes >> np.uint64(49)).astype(np.int64), return_counts=True)
    rows, buckets = keys // BUCKETS, keys % BUCKETS
    values = np.log1p(counts).astype(np.float32)
    length = np.sqrt(np.bincount(rows, values * values, n))
    values /= np.maximum(length, 1e-9)[rows].astype(np.float32)
    size = np.maximum(np.diff(offsets), 1)
    words = np.maximum(np.diff(first), 1)
    stats = np.zeros((n, STATISTICS), np.float32)
    for k, marks in enumerate(_CLASSES):
        total = np.concatenate(([0], np.cumsum(marks[data])))
        stats[:, k] = (total[offsets[1:]] - total[offsets[:-1]]) / size
    stats[:, 8] = np.bincount(row, ends - starts, n) / words / 10
    stats[:, 9] = np.bincount(rows, minlength=n) / words
    stats[:, 10] = np.log1p(words) / 10
    stats[:, 11] = np.bincount(row, (ends - starts) > 15, n) / words
    stats[:, 12] = np.log1p(n_chars) / 10
    stats[:, 13] = np.diff(offsets) == 0
    all_rows = np.concatenate((rows, np.repeat(np.arange(n), STATISTICS)))
    order = np.argsort(all_rows, kind="stable")
    index = np.concatenate((buckets, np.tile(np.arange(BUCKETS, BUCKETS + STATISTICS), n)))[order]
    value = np.concatenate((values, stats.ravel()))[order]
    return np.searchsorted(all_rows[order], np.arange(n + 1)), index, value


def score(model: Machine, starts: np.ndarray, index: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Scores in time linear in the non-zero entries; every row has some."""
    at = starts[:-1]
    vx = model.factors[index] * value[:, None]
    sums = np.add.reduceat(vx, at, axis=0)
    squares = np.add.reduceat((vx * vx).sum(axis=1), at)
    linear = np.add.reduceat(model.weights[index] * value, at)
    margin = model.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares)
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> Machine:
    """Adagrad over logistic loss; a row is (features, values, label)."""
    rng = np.random.default_rng(seed)
    size = BUCKETS + STATISTICS
    model = Machine(0.0, np.zeros(size, np.float32), rng.normal(0, 0.01, (size, FACTORS)).astype(np.float32))
    if not rows:
        model.factors[:] = 0
        return model
    w_sum, v_sum, b_sum = np.full(size, 1e-6, np.float32), np.full((size, FACTORS), 1e-6, np.float32), 1e-6
    positive = sum(y for *_, y in rows)
    weigh = {1: len(rows) / (2 * max(positive, 1)), 0: len(rows) / (2 * max(len(rows) - positive, 1))}
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 64)):
            part = [rows[i] for i in batch]
            starts = np.concatenate(([0], np.cumsum([len(p[0]) for p in part])))
            index, value = np.concatenate([p[0] for p in part]), np.concatenate([p[1] for p in part])
            label = np.array([p[2] for p in part])
            error = (score(model, starts, index, value) - label) * np.array([weigh[y] for y in label.tolist()]) / len(part)
            each = np.repeat(error, np.diff(starts)).astype(np.float32)
            vx = model.factors[index] * value[:, None]
            sums = np.repeat(np.add.reduceat(vx, starts[:-1], axis=0), np.diff(starts), axis=0)
            used, where = np.unique(index, return_inverse=True)
            w_grad = np.bincount(where, each * value, len(used)) + RIDGE * model.weights[used]
            v_each = (each * value)[:, None] * (sums - vx)
            v_grad = np.stack([np.bincount(where, v_each[:, f], len(used)) for f in range(FACTORS)], axis=1) + RIDGE * model.factors[used]
            w_sum[used] += w_grad**2
            v_sum[used] += v_grad**2
            b_sum += error.sum() ** 2
            model.weights[used] -= RATE * w_grad / np.sqrt(w_sum[used])
            model.factors[used] -= RATE * 0.3 * v_grad / np.sqrt(v_sum[used])
            model.bias -= RATE * error.sum() / np.sqrt(b_sum)
    return model


def _batches(batches):
    for batch, data, offsets in passes(batches, "_text"):
        own = pc.utf8_length(batch.column("_text"))
        n_chars = pc.fill_null(pc.coalesce(batch.column("_n_chars"), own.cast(pa.int64())), 0).to_numpy(zero_copy_only=False)
        yield batch, *vectors(data, offsets, np.maximum(n_chars, 0))


def train(docs: DataFrame, labels: DataFrame, text: str = "text") -> Machine:
    """Fit on the labelled rows: ``labels`` has doc_id and label (0 or 1), a bounded sample is read."""
    wanted = labels.filter("label is not null and doc_id is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
    wanted = wanted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    source = docs.select("doc_id", F.col(text).alias("_text"), F.col("n_chars").cast("long").alias("_n_chars")).join(F.broadcast(wanted), "doc_id").select("doc_id", "label", "_text", "_n_chars")

    def encode(batches):
        for batch, starts, index, value in _batches(batches):
            rows = range(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1).cast(pa.int32()), pa.array([index[starts[i] : starts[i + 1]].astype("<i4").tobytes() for i in rows], pa.binary()), pa.array([value[starts[i] : starts[i + 1]].astype("<f4").tobytes() for i in rows], pa.binary())],
                names=["doc_id", "label", "at", "x"],
            )

    got = source.mapInArrow(encode, "doc_id long, label int, at binary, x binary").orderBy("doc_id", F.xxhash64("at", "x")).limit(2 * SAMPLE).collect()
    rows = [(np.frombuffer(r.at, "<i4"), np.frombuffer(r.x, "<f4"), int(r.label)) for r in sorted(got, key=lambda r: (r.doc_id, r.x))]
    return fit(rows)


def scored(docs: DataFrame, model: Machine, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and ``score`` of every row."""
    chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    source = docs.select(*held(docs, keep, ["score", "_n_chars"]), F.col(text).alias("_text"), chars.alias("_n_chars"))
    schema = T.StructType([*source.schema.fields[:-2], T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch, starts, index, value in _batches(batches):
            own = [batch.column(i) for i in range(batch.num_columns - 2)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(score(shared.value, starts, index, value).astype(np.float64))], names=schema.names)

    return source.mapInArrow(run, schema)


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def quality_model(docs: DataFrame, labels: DataFrame) -> Machine:
    """The model of ``labels.quality``, from the rows that are not held out."""
    return train(docs, labels.filter(~held_out()).select("doc_id", F.col("quality").alias("label")))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's row per document."""
    out = scored(docs, quality_model(docs, labels), ["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

"""Exact centroid clustering (Lloyd's rounds) with heap-ordered bounds.

Components become integers, so sums, distances and ties are exact.  A vector
needs to be compared with all centroids again only when its own centroid and
the others have together moved by more than the gap between its distances to
the nearest and the second nearest one.  Every cluster keeps a heap of these
gaps: a vector's key is its gap plus the drift that its cluster had
accumulated when the gap was measured, so keys are never updated, and the
vectors to look at are those that stand before the cluster's drift.

The heap of all clusters is a table, written in the order of (cluster, key):
popping is reading the ranges of keys that the drift has passed since the round
before, which Parquet skips to by its statistics.  Popped vectors are compared
with all centroids, exactly, and written once more under their new keys as the
next generation of the heap; what is still ahead of the drift is not read,
sent or written.  Only ``k`` centroids, their sums and drifts are on the driver.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexfold.llm.common import Scratch, kept_name, written

CLUSTERS, COMPONENTS, ROUNDS, SCALE = 16, 64, 3, 64
MADE = ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
LIMIT = 1 << 27  #: larger integers are held to it, so that squared distances stay below 2**63
SLACK = 1e-3  #: of gaps, far above the rounding of square roots: ties are always compared again
CHUNK = 8192


def integers(vectors: DataFrame, name: str, vector: str, size: int, scale: int) -> DataFrame:
    """_id, _x of the vectors with ``size`` components, none null or non-finite: floor(scale * component)."""
    v, inf = F.col(vector), F.lit(float("inf"))
    whole = (F.size(v) == size) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < inf))
    held = lambda c: F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT))))
    return vectors.filter(F.coalesce(whole, F.lit(False))).select(F.col(name).alias("_id"), F.transform(v, held).alias("_x"))


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances as exact int64; through floating products where every step is below 2**53."""
    wide = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if wide * wide * x.shape[1] * 4 < 1 << 52:
        a, c = x.astype(np.float64), centroids.astype(np.float64)
    else:
        a, c = x, centroids
    return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)).astype(np.int64)


def placed(x: np.ndarray, centroids: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid (ties: the smaller number) and the key of each vector."""
    cluster, key = np.zeros(len(x), np.int32), np.full(len(x), np.inf)
    for at in range(0, len(x), CHUNK):
        d = distances(x[at : at + CHUNK], centroids)
        best = d.argmin(1)
        cluster[at : at + CHUNK] = best
        if d.shape[1] > 1:
            two = np.sqrt(np.partition(d, 1, axis=1)[:, :2].astype(np.float64))
            key[at : at + CHUNK] = two[:, 1] - two[:, 0] + drift[best]
    return cluster, key


def _rows(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, size).astype(np.int64)


def measured(source: DataFrame, centroids: np.ndarray, drift: np.ndarray) -> DataFrame:
    """_id, _was, _c, _key, _x of vectors compared with all centroids, in the order of the heap.

    ``source``: _id, _was (the cluster before, null at first), _x as a list or
    as the bytes that this returns.
    """
    size, first = centroids.shape[1], source.schema["_x"].dataType.typeName() == "array"
    schema = f"_id {source.schema['_id'].dataType.simpleString()}, _was int, _c int, _key double, _x binary"

    def compare(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column("_x")
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size) if first else _rows(column, size)
            cluster, key = placed(x, centroids, drift)
            raw = np.ascontiguousarray(x, "<i4").tobytes()
            ends = np.arange(len(x) + 1, dtype=np.int32) * (4 * size)
            held = column if not first else pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_was"), pa.array(cluster), pa.array(key), held], names=["_id", "_was", "_c", "_key", "_x"])

    return source.mapInArrow(compare, schema).sortWithinPartitions("_c", "_key")


def changes(generation: DataFrame, k: int, size: int) -> tuple[np.ndarray, list[int]]:
    """Sums (k x size) and counts that a generation adds to clusters; what it takes from those it left is negative.

    A task adds up its own vectors; ``k`` times ``size`` numbers reach the driver.
    """

    def add(batches):
        sums, n = np.zeros((k, size + 1), np.int64), 0
        for batch in batches:
            x = _rows(batch.column("_x"), size)
            x = np.concatenate((x, np.ones((len(x), 1), np.int64)), axis=1)
            n += len(x)
            np.add.at(sums, batch.column("_c").to_numpy(), x)
            was = batch.column("_was")
            left = was.is_valid().to_numpy(zero_copy_only=False)
            np.subtract.at(sums, was.fill_null(0).to_numpy()[left], x[left])
        if n:
            cluster, part = np.divmod(np.arange(sums.size), size + 1)
            yield pa.RecordBatch.from_arrays([pa.array(cluster.astype(np.int32)), pa.array(part.astype(np.int32)), pa.array(sums.ravel())], names=["c", "p", "s"])

    out = np.zeros((k, size + 1), object)
    moved = generation.filter("_was is null or _was <> _c").select("_was", "_c", "_x")
    for c, p, s in moved.mapInArrow(add, "c int, p int, s long").groupBy("c", "p").agg(F.sum(F.col("s").cast("decimal(38,0)"))).collect():
        out[c, p] = int(s)
    return out[:, :size], [int(n) for n in out[:, size]]


def between(low: np.ndarray | None, high: np.ndarray) -> Column:
    """Rows of the heaps whose keys the drift has passed: above ``low`` and up to ``high``."""
    each = [(F.col("_c") == c) & (F.col("_key") <= float(h) + SLACK) & (F.lit(True) if low is None else F.col("_key") > float(low[c]) + SLACK) for c, h in enumerate(high)]
    return reduce(Column.__or__, each)


def ahead(drift: np.ndarray) -> Column:
    """Rows of the heaps that the drift has not reached."""
    return reduce(Column.__or__, [(F.col("_c") == c) & (F.col("_key") > float(d) + SLACK) for c, d in enumerate(drift)])


def clustered(vectors: DataFrame, name: str = "vec_id", vector: str = "embedding", k: int = CLUSTERS, size: int = COMPONENTS, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``name``, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector of ``size`` finite components.

    The first centroids are the ``k`` vectors with the least SHA-256 of
    ``1:<name>``, fewer where there are fewer vectors; rows without a name come
    last among them and rows of one name by their components.  Each round
    assigns all vectors and moves every centroid that has some to the floor of
    their mean; then they are assigned once more.  Repeated rows count each.
    Vectors of another size, with a null or a number that is not finite, and
    null vectors give no row; no vectors give none.  A ``name`` like a made
    column's is returned as ``<name>_in``.
    """
    spark, to = vectors.sparkSession, kept_name(name, MADE)
    source = integers(vectors, name, vector, size, scale)
    order = F.sha2(F.concat(F.lit("1:"), F.col("_id").cast("string")), 256).asc_nulls_last()
    seeds = source.orderBy(order, F.col("_id").asc_nulls_last(), "_x").limit(k).collect()
    kind = source.schema["_id"].dataType.simpleString()
    made = f"`{to}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not seeds:
        return spark.createDataFrame([], made)
    centroids = np.array([r["_x"] for r in seeds], np.int64)
    k, drift = len(seeds), np.zeros(len(seeds))
    with Scratch(spark) as scratch:
        heap = scratch.written(measured(source.select("_id", F.lit(None).cast("int").alias("_was"), "_x"), centroids, drift), "heap")
        generations, (sums, counts) = [heap], changes(heap, k, size)
        for turn in range(rounds):
            moved = centroids.copy()
            for c, n in enumerate(counts):
                if n:
                    moved[c] = np.array([s // n for s in sums[c]], np.int64)
            step = np.sqrt(((moved - centroids) ** 2).sum(1).astype(np.float64))
            others = np.array([np.delete(step, c).max(initial=0.0) for c in range(k)])
            before, drift, centroids = drift, drift + step + others, moved
            # the newest generation was compared in the round before, so all of it is still in the heaps
            older = [g.filter(between(before, drift)) for g in generations[:-1]]
            popped = reduce(DataFrame.union, [g.select("_id", F.col("_c").alias("_was"), "_x") for g in [*older, generations[-1].filter(between(None, drift))]])
            heap = scratch.written(measured(popped, centroids, drift), "heap")
            generations.append(heap)
            if turn + 1 < rounds:
                more, less = changes(heap, k, size)
                sums, counts = sums + more, [a + b for a, b in zip(counts, less, strict=True)]

        def exact(batches):
            for batch in batches:
                x, c = _rows(batch.column("_x"), size), batch.column("_c").to_numpy()
                yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_c"), pa.array(((x - centroids[c]) ** 2).sum(1))], names=["_id", "_c", "_d"])

        live = reduce(DataFrame.union, [g.select("_id", "_c", "_x") for g in [*[g.filter(ahead(drift)) for g in generations[:-1]], generations[-1]]])
        found = written(live.mapInArrow(exact, f"_id {kind}, _c int, _d long"), "clusters")
    marks = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    inertia = {c: int(d) for c, d in found.groupBy("_c").agg(F.sum(F.col("_d").cast("decimal(38,0)"))).collect()}
    of = lambda values: F.array(*map(F.lit, values))[F.col("_c")]
    own = of([inertia.get(c, 0) for c in range(k)]).cast("long")
    return found.select(F.col("_id").alias(to), F.col("_c").alias("cluster"), F.col("_d").alias("distance"), own.alias("cluster_inertia"), F.lit(sum(inertia.values())).cast("long").alias("inertia"), of(marks).alias("centroid_sha256"))


def _sql() -> str:
    """The same rounds in SQL: every vector against every centroid each time."""
    parts = [f"""WITH v AS (SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda c: CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
 WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = {COMPONENTS}),
 c0 AS (SELECT row_number() OVER (ORDER BY sha256(concat('1:', vec_id)), vec_id, x) - 1 AS c, x AS m FROM v ORDER BY 1 LIMIT {CLUSTERS})"""]
    for t in range(ROUNDS + 1):
        parts.append(f"""a{t} AS (SELECT i, min((list_sum(list_transform(list_zip(x, m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, c)) AS a FROM v CROSS JOIN c{t} GROUP BY i)""")
        if t < ROUNDS:
            parts.append(f"""s{t} AS (SELECT a[2] AS c, j, sum(x[j])::BIGINT AS s, count(*) AS n FROM a{t} JOIN v USING (i) CROSS JOIN (SELECT unnest(range(1, {COMPONENTS + 1})) AS j) GROUP BY 1, 2),
 c{t + 1} AS (SELECT c, coalesce(n.m, o.m) AS m FROM c{t} o LEFT JOIN (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS m FROM s{t} GROUP BY c) n USING (c))""")
    last = ROUNDS
    return ",\n ".join(parts) + f"""
 SELECT vec_id, CAST(a[2] AS INT) AS cluster, CAST(a[1] AS BIGINT) AS distance, CAST(sum(a[1]) OVER (PARTITION BY a[2]) AS BIGINT) AS cluster_inertia, CAST(sum(a[1]) OVER () AS BIGINT) AS inertia,
 sha256(array_to_string(m, ',')) AS centroid_sha256 FROM a{last} JOIN v USING (i) JOIN c{last} ON c{last}.c = a[2]"""


SQL = _sql()

import hashlib

import duckdb
import numpy as np

from hexfold.llm import clusters

SCHEMA = "vec_id long, embedding array<float>, label int"


def lloyd(rows, k=16, rounds=3):
    """Every vector against every centroid in every round."""
    x = np.array([[int(np.floor(64 * float(c))) for c in v] for _, v in rows], object)
    order = sorted(range(len(rows)), key=lambda i: (hashlib.sha256(f"1:{rows[i][0]}".encode()).hexdigest(), list(x[i])))
    centroids = [list(x[i]) for i in order[:k]]
    assign = lambda: [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids)) for v in x]
    for _ in range(rounds):
        at = assign()
        for j in range(len(centroids)):
            own = [v for v, (_, c) in zip(x, at, strict=True) if c == j]
            if own:
                centroids[j] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    at = assign()
    inertia = [sum(d for d, c in at if c == j) for j in range(len(centroids))]
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((i, c, d, inertia[c], sum(inertia), marks[c]) for (i, _), (d, c) in zip(rows, at, strict=True))


def test_equals_plain_rounds(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1, (20, 64))
    rows = [(i, [float(np.float32(c)) for c in centres[i % 20] * (i % 3) / 2 + rng.normal(0, 0.2, 64)]) for i in range(500)]
    rows += [(i, [0.0] * 64) for i in range(500, 540)] + rows[:30]  # ties and repeated rows
    got = clusters.clustered(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(6))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect())) == lloyd(rows)


def test_only_expired_vectors_are_compared_again(spark, monkeypatch):
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 5, (16, 64))
    rows = [(i, [float(np.float32(c)) for c in centres[i % 16] + rng.normal(0, 0.05, 64)], 0) for i in range(2000)]
    seen = []
    measured = clusters.measured
    monkeypatch.setattr(clusters, "measured", lambda source, *a: seen.append(source.count()) or measured(source, *a))
    got = clusters.clustered(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, got.collect())) == lloyd([r[:2] for r in rows])
    assert seen[0] == 2000 and seen[-1] < 1000


def test_edge_cases(spark):
    none = clusters.clustered(spark.createDataFrame([], SCHEMA))
    assert none.collect() == [] and len(none.columns) == 6
    nan, inf = float("nan"), float("inf")
    bad = [(1, [0.5] * 63, 0), (2, [0.5] * 63 + [None], 0), (3, [0.5] * 63 + [nan], 0), (4, [0.5] * 63 + [inf], 0), (5, None, 0), (6, [], 0), (7, [1.0] * 65, 0)]
    assert clusters.clustered(spark.createDataFrame(bad, SCHEMA)).collect() == []
    few = [(1, [0.5] * 64), (2, [-0.01] * 64), (2, [0.25] * 64), (None, [3.0] * 64)]
    got = clusters.clustered(spark.createDataFrame([(*r, 1) for r in few] + bad, SCHEMA)).collect()
    assert len(got) == 4 and all(r["distance"] == 0 for r in got)
    huge = clusters.clustered(spark.createDataFrame([(1, [1e30] * 64, 0), (2, [-1e30] * 64, 0), (3, [0.0] * 64, 0)], SCHEMA), k=1).collect()
    assert sorted(r["distance"] for r in huge)[0] >= 0 and max(r["distance"] for r in huge) < 2**63


def test_sql_agrees(spark, tmp_path):
    rng = np.random.default_rng(8)
    rows = [(i % 280, [float(np.float32(c)) for c in rng.normal(0, 1, 64)], 0) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    df.write.parquet(str(tmp_path / "e"))
    with duckdb.connect() as con:
        con.sql(f"create view embeddings as select * from '{tmp_path}/e/*.parquet'")
        want = con.sql(f"select vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 from ({clusters.SQL})").fetchall()
    assert sorted(map(tuple, clusters.clustered(df).collect())) == sorted(want)

import numpy as np

from hexfold.llm import factorisation as fm


def test_linear_time_identity():
    rng = np.random.default_rng(0)
    size = fm.BUCKETS + fm.STATISTICS
    model = fm.Machine(0.3, rng.normal(size=size), rng.normal(0, 0.2, (size, fm.FACTORS)))
    starts, index, value = np.array([0, 5, 6, 18]), rng.integers(0, size, 18), rng.normal(size=18)
    got = fm.score(model, starts, index, value)
    for k in range(3):
        at, x = index[starts[k] : starts[k + 1]], value[starts[k] : starts[k + 1]]
        z = model.bias + model.weights[at] @ x + sum(model.factors[at[i]] @ model.factors[at[j]] * x[i] * x[j] for i in range(len(at)) for j in range(i))
        assert np.isclose(got[k], 1 / (1 + np.exp(-z)))


def test_vectors_of_texts():
    raw = [b"The the THE cat", b"", b"a|b!! 12"]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    starts, index, value = fm.vectors(np.frombuffer(b"".join(raw), np.uint8), offsets, np.array([15, 0, 8]))
    hashed = [index[a:b] < fm.BUCKETS for a, b in zip(starts[:-1], starts[1:], strict=True)]
    assert [int(h.sum()) for h in hashed] == [2, 0, 2]
    assert np.isclose((value[starts[0] : starts[1]][hashed[0]] ** 2).sum(), 1, atol=1e-5)


def test_edge_rows(spark, docs_of):
    docs = docs_of(["good words here"] * 3 + [None, "", "x " * 60_000])
    labels = spark.createDataFrame([(0, 1, 0), (2, 0, 0), (2, None, 0), (None, 1, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")
    rows = sorted(fm.quality(docs, labels).collect())
    assert len(rows) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert rows[0].score == rows[1].score == rows[2].score and rows[3].score == rows[4].score
    assert {r.score for r in fm.quality(docs, labels.limit(0)).collect()} == {0.5}
    assert fm.quality(docs_of([]), labels).count() == 0


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = fm.quality(docs, labels).join(labels, "doc_id").filter("held_out").selectExpr("avg(cast(predicted = quality as int)) a").first().a
    assert got > 0.95

import itertools

import numpy as np

from hexfold.llm import language
from hexfold.llm.common import prefix_hash, span_hash


def field(n=3, seed=0):
    rng = np.random.default_rng(seed)
    return language.Field([f"l{i}" for i in range(n)], rng.normal(size=(language.BUCKETS, n)).astype(np.float32), np.zeros(0, np.uint64), np.zeros((0, n), np.float32), 0.0, rng.normal(size=(n, n)).astype(np.float32))


def test_forward_backward_is_the_sum_over_all_paths():
    rng = np.random.default_rng(1)
    model, chains = field(), np.array([0, 4, 5])
    emission = rng.normal(size=(10, 3))
    got, _ = language.posteriors(model, emission, chains)
    for a, b in ((0, 4), (4, 5), (5, 10)):
        want = np.zeros((b - a, 3))
        for path in itertools.product(range(3), repeat=b - a):
            weight = np.exp(sum(emission[a + t, y] for t, y in enumerate(path)) + sum(model.transitions[x, y] for x, y in itertools.pairwise(path)))
            for t, y in enumerate(path):
                want[t, y] += weight
        assert np.allclose(got[a:b], want / want.sum(axis=1, keepdims=True), atol=1e-5)


def test_words_and_features():
    texts = ["Où es-tu, Élan? Ça va", "", "x1y " + "w " * 300]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    data = np.frombuffer(b"".join(raw), np.uint8)
    low, starts, ends, chains, first = language.words(data, offsets)
    got = [bytes(low[a:b]).decode() for a, b in zip(starts, ends, strict=True)]
    assert got[:6] == ["où", "es", "tu", "élan", "ça", "va"] and first.tolist() == [0, 6, 6, 308]
    assert chains.tolist() == [0, 4, 6, 134, 262]
    index, at = language.features(low, starts, ends)
    one = [language.features(low[a:b], np.array([0]), np.array([b - a]))[0] for a, b in zip(starts, ends, strict=True)]
    for i, want in enumerate(one):
        have = index[at[i] : at[i + 1]] if i + 1 < len(at) else index[at[i] :]
        assert sorted(have.tolist()) == sorted(want.tolist())
    assert len(span_hash(prefix_hash(low), starts, ends)) == 308


def test_code_switched_words_and_edge_rows(spark, docs_of):
    train = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(train.filter(~language.held_out()))
    by = {r.lang: r.text for r in train.filter("n_chars between 2000 and 3000").collect()}
    mixed = by["en"][:1200].rsplit(" ", 1)[0] + " " + by["fr"][:900]
    rows = sorted(language.labelled(docs_of([mixed, None, "", "123 !! 45", "—", by["de"], by["de"]]), model, ["doc_id"]).collect())
    assert rows[0].lang_pred == "en" and 0.4 < rows[0].score < 0.8 and rows[0].n_switches >= 1
    assert [(r.lang_pred, r.score) for r in rows[1:5]] == [("und", 0.0)] * 4
    assert rows[5].lang_pred == "de" and rows[5][1:] == rows[6][1:]


def test_nothing_to_learn_from(docs_of):
    docs = docs_of(["some words", None])
    assert {r.lang_pred for r in language.languages(docs).collect()} == {"und"}
    assert language.languages(docs_of([])).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").selectExpr("avg(cast(lang_pred = lang as int)) a").first().a
    assert got > 0.98

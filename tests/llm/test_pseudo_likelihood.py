import numpy as np
from pyspark.sql import functions as F

from hexfold.llm import pseudo_likelihood as pl


def test_probabilities_sum_to_one_and_equal_the_plain_formula():
    net = pl.Network()
    net.flat += np.random.default_rng(0).normal(0, 0.3, len(net.flat)).astype(np.float32)
    context = np.array([[1, 2, 3, pl.PAD]])
    every = np.arange(pl.WORDS)
    got = pl.log_probabilities(net, np.repeat(context, pl.WORDS, axis=0), every)
    assert np.isclose(np.exp(got.astype(float)).sum(), 1, atol=1e-3)
    hidden = np.append(np.tanh(sum(net.embed[k][context[0, k]] for k in range(4))), 1)
    for w in (0, 77, 4095):
        top, low = hidden @ net.top, hidden @ net.low[w // 64]
        assert np.isclose(got[w], top[w // 64] - np.log(np.exp(top).sum()) + low[w % 64] - np.log(np.exp(low).sum()), atol=1e-4)


def test_step_follows_the_numeric_gradient():
    rng = np.random.default_rng(2)
    context, word = rng.integers(0, 300, (40, 4)), rng.integers(0, 300, 40)
    net = pl.Network()
    before = pl.log_probabilities(net, context, word).mean()
    squares = pl.Network(np.zeros_like(net.flat))
    for _ in range(30):
        pl.step(net, squares, context, word)
    assert pl.log_probabilities(net, context, word).mean() > before + 1


def test_step_is_the_gradient_of_the_loss():
    """One step moves every parameter by RATE against the sign of its numeric gradient (Adagrad's first step)."""
    rng = np.random.default_rng(4)
    context, word = rng.integers(0, 300, (50, 4)), rng.integers(0, 300, 50)
    net = pl.Network()
    net.flat += rng.normal(0, 0.3, len(net.flat)).astype(np.float32)
    loss = lambda flat: -pl.log_probabilities(pl.Network(flat), context, word).astype(float).mean()
    before = net.flat.copy()
    squares = pl.Network(np.zeros_like(net.flat))
    pl.step(net, squares, context, word)
    gradient = np.sqrt(squares.flat) * np.sign(before - net.flat)
    for k in rng.choice(np.flatnonzero(np.abs(gradient) > 2e-3), 25, replace=False).tolist():
        up, down = before.copy(), before.copy()
        up[k] += 1e-2
        down[k] -= 1e-2
        assert np.isclose((loss(up) - loss(down)) / 2e-2, gradient[k], rtol=0.05, atol=2e-4)


def test_commonest(spark):
    rng = np.random.default_rng(8)
    rows = [(int(w), int(n)) for w, n in enumerate(rng.integers(1, 90, 3000))]
    counts = spark.createDataFrame(rows, "w long, n long").repartition(5)
    for most in (1, 100, 2999, 5000):
        assert [tuple(r) for r in pl.commonest(counts, most)] == sorted(rows, key=lambda r: (-r[1], r[0]))[:most]
    assert pl.commonest(counts.limit(0), 5) == []


def test_a_documents_score_by_brute_force(spark, docs_of):
    """Sum over its words of the plain softmax of the network, times the share of a bucket's word."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    known, net = pl.trained(docs)
    counts = {r.w: r.n for r in known[2].collect()}
    number = {int(w): int(v) for w, v in zip(known[0], known[1], strict=True)}
    text = "The and of thre UNSEENWORD ingly the " + docs.filter("length(text) > 200").orderBy("doc_id").first().text[:400]
    raw = np.frombuffer(text.encode(), np.uint8)
    hashes, _ = pl.word_hashes(raw, np.array([0, len(raw)]))
    words = [number.get(int(h), pl.WORDS - pl.CLASSES + ((int(h) & (1 << 64) - 1) >> 58)) for h in hashes]
    total = 0.0
    for i, w in enumerate(words):
        around = [words[i + s] if 0 <= i + s < len(words) else pl.PAD for s in pl.SIDES]
        hidden = np.append(np.tanh(sum(net.embed[k][c].astype(float) for k, c in enumerate(around))), 1)
        for logit, at in ((hidden @ net.top, w // pl.CLASSES), (hidden @ net.low[w // pl.CLASSES], w % pl.CLASSES)):
            total += logit[at] - np.log(np.exp(logit).sum())
        if w >= pl.WORDS - pl.CLASSES:
            total += np.log(counts.get(int(hashes[i]), 1) / (known[3][w % pl.CLASSES] + 1))
    (row,) = pl.scored(docs_of([text]).withColumn("score", F.lit("own")), (known, net), keep=("doc_id", "score")).collect()
    assert row.score_in == "own" and row.n_words == len(words) and np.isclose(row.log_likelihood, total, rtol=1e-4)


def test_contexts_stay_in_their_text():
    got = pl.contexts(np.array([5, 6, 7, 8]), np.array([0, 3, 3, 4]))
    p = pl.PAD
    assert got.tolist() == [[p, p, 6, 7], [p, 5, 7, p], [5, 6, p, p], [p, p, p, p]]


def test_scores(spark, docs_of):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = pl.trained(docs)
    text = max((r.text for r in docs.collect()), key=len)
    shuffled = " ".join(np.random.default_rng(0).permutation(text.split()))
    rows = sorted(pl.scored(docs_of([text, text, shuffled, "", None]), model).collect())
    assert rows[0][1:] == rows[1][1:] and [tuple(r[1:]) for r in rows[3:]] == [(0, 0.0, 0.0)] * 2
    untrained = sorted(pl.scored(docs_of([text]), (model[0], pl.Network())).collect())
    assert rows[0].score > untrained[0].score + 1
    assert pl.pseudo_likelihood(docs_of([])).count() == 0


def test_every_word_is_a_target_once():
    for n in (0, 1, 37):
        assert sorted(np.concatenate([pl.targets(n, r) for r in range(pl.ROUNDS)]).tolist()) == list(range(n))


def test_words_of_a_bucket_have_their_own_probabilities(spark, docs_of):
    """The bucket's probability times the word's share of its counts; one count is for unseen words."""
    rare = [f"r{i}" for i in range(400)]
    raw = " ".join(rare).encode()
    hashes, _ = pl.word_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    of = hashes.view(np.uint64) >> np.uint64(58)
    one, two, unseen = np.array(rare)[of == of[0]][:3].tolist()
    seen = [w for w in rare if w != unseen] + [two]
    docs = docs_of([" ".join(f"c{i}" for i in range(pl.WORDS - pl.CLASSES)) + " "] * 3 + [" ".join(seen)])
    got = [r.log_likelihood for r in sorted(pl.scored(docs_of([one, two, unseen]), (pl.vocabulary(docs), pl.Network())).collect())]
    total = sum(int(n == of[0]) for n in of) - 1 + 1 + 1  # without the unseen word, one twice, one count kept
    again = [r.log_likelihood for r in sorted(pl.scored(docs_of([one, two, unseen]), (pl.vocabulary(docs), pl.Network()), most=0).collect())]
    assert got == again  # whether shares are broadcast or joined
    net = pl.Network()
    bucket = pl.log_probabilities(net, np.full((1, 4), pl.PAD), np.array([pl.WORDS - pl.CLASSES + int(of[0])]))[0]
    assert np.allclose(got, bucket + np.log(np.array([1, 2, 1]) / total), atol=1e-4)

import string

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F
from test_minhash import brute as near
from test_repeats import covered_words

import corpus_pipeline as pipeline
from hexfold.llm import factorisation
from hexfold.llm.common import table, written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that each stage reads and makes, by its name."""
    docs, out = table(spark, SF, "documents"), {}
    for name, stage in pipeline.STAGES:
        made = written(stage(spark, docs, SF), "test")
        out[name] = docs.collect(), made.collect()
        docs = made
    return out


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_stages_keep_the_columns_of_documents(spark, stages):
    for name, _ in pipeline.STAGES[:-1]:
        assert [f for r in stages[name][1][:1] for f in r.asDict()] == table(spark, SF, "documents").columns


def test_quality(spark, stages):
    before, after = stages["quality classifier"]
    model = factorisation.quality_model(table(spark, SF, "documents"), table(spark, SF, "labels"))
    kept = texts(after)
    for r in before:
        raw = np.frombuffer((r.text or "").encode(), np.uint8)
        _, index, value = factorisation.vectors(raw, np.array([0, len(raw)]), np.array([r.n_chars or 0]))
        x = model.factors[index].astype(float) * value[:, None]
        products = x @ x.T
        margin = model.bias + model.weights[index] @ value + (products.sum() - np.trace(products)) / 2
        if abs(margin) > 1e-3:
            assert (r.doc_id in kept) == (margin > 0)
    assert 0 < len(after) < len(before)


def test_near_duplicates(stages):
    before, after = stages["near-duplicates"]
    assert sorted(r.doc_id for r in after) == sorted(i for i, _, _, kept in near([(r.doc_id, r.text) for r in before], 5, 80) if kept)


def test_repeated_passages(stages):
    before, after = stages["repeated passages"]
    want = {i: kept.decode() for i, _, kept in covered_words([(r.doc_id, r.text) for r in before], 51)}
    assert {r.doc_id: r.text or "" for r in after} == want and len(after) == len(before)
    assert all(r.n_chars == len(r.text) for r in after if r.text is not None)


def test_short_words_are_a_passage(spark, docs_of):
    """51 words of two letters, far below 400 bytes, go from every document; 50 words stay."""
    long, less = ("".join(f" {x}{c}" for c in string.ascii_letters[:n]) for x, n in (("a", 51), ("b", 50)))
    docs = docs_of([f"one{i}{long} two{i}{less} three{i}" for i in range(5)])
    got = {r.doc_id: r.text for r in pipeline.repeated_passages(spark, docs, SF).collect()}
    assert got == {i: f"one{i}  two{i}{less} three{i}" for i in range(5)}


def shingles(text):
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_benchmark_passages(spark, stages):
    before, after = stages["benchmark passages"]
    items = [s for r in table(spark, SF, "benchmark").collect() if (s := shingles(r.text))]
    clean = {r.doc_id for r in before if not any(100 * len(s & shingles(r.text)) >= 80 * len(s) for s in items)}
    assert {r.doc_id: r.text for r in after} == {r.doc_id: r.text for r in before if r.doc_id in clean}


def test_packing(stages):
    before, after = stages["packing"]
    totals = {}
    for r in after:
        totals[r.doc_id] = totals.get(r.doc_id, 0) + r.length
        assert totals[r.doc_id] <= r.doc_tokens and r.offset + r.length <= 2048
    assert set(totals) == {r.doc_id for r in before}
    assert all(totals[r.doc_id] == r.doc_tokens for r in after)


@pytest.mark.parametrize(("name", "stage"), pipeline.STAGES)
def test_edges(spark, name, stage):
    """Nulls, empty and repeated rows, very long texts, and columns with the operators' names."""
    rows = [(None, "a b c d e f", None, None, None), (1, None, None, None, None), (2, "", "en", None, 0), (3, "x", None, "s", 1), (3, "x", None, "s", 1), (4, "long words " * 40_000, "en", "s", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = docs
    for c in ("_text", "score", "kept", "label", "n", "k", "words", "item_id", "length"):
        clash = clash.withColumn(c, F.lit(c))
    made = stage(spark, clash, SF)
    if name != "packing":
        assert made.columns == docs.columns
        assert {r.doc_id for r in made.collect()} <= {r.doc_id for r in docs.collect()}
    else:
        assert {r.doc_id for r in made.collect()} >= {1, 2, 3, 4}
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_repeated_rows_keep_one_copy(spark, docs_of):
    """Equal rows, rows without doc_id and rows that share one leave one text, which the next stage keeps whole."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(150)) for x in "abcd")
    docs = docs_of([(1, a), (1, a), (None, b), (None, b), (None, c), (5, c), (7, d), (7, d + " end"), (8, None), (9, None)])
    made = pipeline.near_duplicates(spark, docs, SF)
    assert sorted((r.doc_id or 0, r.text[:1]) for r in made.filter("text is not null").collect()) == [(0, "b"), (1, "a"), (5, "c"), (7, "d")]
    assert {r.doc_id for r in made.filter("text is null").collect()} == {8, 9}
    left = pipeline.repeated_passages(spark, written(made, "test"), SF)
    assert all(len(r.text) > 400 for r in left.filter("text is not null").collect())


def test_benchmark_texts_without_an_id_go(spark):
    item = next(r.text for r in table(spark, SF, "benchmark").collect() if len(shingles(r.text)) > 5)
    rows = [(None, f"Before. {item} After.", None, None, None), (1, item, None, None, None), (1, "A clean text of the same number.", None, None, None), (None, "Clean too.", None, None, None), (2, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = pipeline.benchmark_passages(spark, docs, SF).collect()
    assert sorted(str(r.text) for r in left) == ["A clean text of the same number.", "Clean too.", "None"]

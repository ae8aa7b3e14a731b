import hashlib
import random
import re

import pytest

from hexfold.llm import repeats


def brute(docs, length):
    seen, out = {}, set()
    raw = [(i, (t or "").encode()) for i, t in docs]
    for k, (_, t) in enumerate(raw):
        for p in range(len(t) - length + 1):
            seen.setdefault(t[p : p + length], []).append((k, p))
    gone = [bytearray(len(t)) for _, t in raw]
    for places in seen.values():
        if len(places) > 1:
            for k, p in places:
                gone[k][p : p + length] = b"\1" * length
    rows = []
    for (i, t), g in zip(raw, gone, strict=True):
        rows.append((i, len(t), sum(g), sum(1 for p in range(len(g)) if g[p] and not (p and g[p - 1])), hashlib.sha256(bytes(c for c, x in zip(t, g, strict=True) if not x)).hexdigest()))
    return sorted(rows, key=str)


def texts(rng, length):
    words = [f"{w}é"[: rng.randrange(1, 9)] for w in "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()]
    make = lambda n: " ".join(rng.choices(words, k=n))
    shared, exact = make(length // 3), make(length)[:length]
    out = [make(rng.randrange(5, length)) + shared + make(rng.randrange(5, length)) for _ in range(12)]
    out += [make(40) + exact + make(40), make(9) + exact, exact[1:] + make(30), exact, exact]
    base = list(make(length))
    for _ in range(10):
        base[rng.randrange(len(base))] = "#"
        out.append("".join(base))
    return [*out, out[0], "a" * (length * 3), "b" * length, "b" * (length + 1), "ab" * length, "", None, "short", make(length * 4)]


@pytest.mark.parametrize(("length", "reach"), [(400, 256), (50, 32)])
def test_against_all_windows(docs_of, length, reach):
    docs = list(enumerate(texts(random.Random(length), length)))
    random.Random(1).shuffle(docs)
    docs += [(None, docs[3][1]), (5, docs[4][1]), (5, docs[4][1])]
    got = repeats.cut(docs_of(docs), unit=repeats.Unit(length, reach)).collect()
    rows = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got), key=str)
    assert rows == brute(docs, length)


def covered_words(docs, length):
    """By text: the words in windows of ``length`` words that start elsewhere too, and the bytes outside them."""
    seen, split = {}, []
    for k, (_, t) in enumerate(docs):
        split.append([m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())])
        words = [(t or "").encode()[a:b] for a, b in split[k]]
        for p in range(len(words) - length + 1):
            seen.setdefault(tuple(words[p : p + length]), []).append((k, p))
    gone, inside = [set() for _ in docs], [set() for _ in docs]
    for places in seen.values():
        if len(places) > 1:
            for k, p in places:
                gone[k].update(range(p, p + length))
                inside[k].update(range(split[k][p][0], split[k][p + length - 1][1]))
    rows = []
    for k, (i, t) in enumerate(docs):
        rows.append((i, len(gone[k]), bytes(c for p, c in enumerate((t or "").encode()) if p not in inside[k])))
    return sorted(rows, key=str)


def passages(rng):
    """Passages of 51 and 50 words, of one letter and of many, in several documents."""
    make = lambda n, size: " ".join("".join(rng.choices("abcdé", k=size)) for _ in range(n))
    short, long, less = make(51, 1), make(51, 9), make(50, 7)
    out = [f"{make(rng.randrange(90), 5)} \n{x}\t{make(rng.randrange(90), 5)}" for x in (short, short, long, long, long, less, less)]
    return [*out, make(400, 6), out[0], "x " * 300, "", None, "one"]


@pytest.mark.parametrize("unit", [repeats.PASSAGES, repeats.Unit(12, 4, True, (2, 1))])
def test_words_against_all_windows(docs_of, unit):
    docs = list(enumerate(passages(random.Random(5)) + texts(random.Random(6), 60)))
    got = repeats.covered(docs_of(docs), (repeats.BYTES, unit)).collect()
    assert sorted(((r.doc_id, r.n_words_1) for r in got), key=str) == [r[:2] for r in covered_words(docs, unit.length)]
    cut = repeats.cut(docs_of(docs), unit=unit).collect()
    assert sorted(((r.doc_id, bytes(r.kept)) for r in cut), key=str) == sorted(((i, kept) for i, _, kept in covered_words(docs, unit.length)), key=str)


def test_no_rows(docs_of):
    assert repeats.digest(docs_of([])).count() == 0


def test_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got, rows = repeats.digest(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(rows, 400)
    assert sorted(((r.doc_id, r.n_passage_words) for r in got), key=str) == [r[:2] for r in covered_words(rows, 51)]

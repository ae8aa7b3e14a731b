import random
import re

from hexfold.llm import minhash
from hexfold.llm.components import components


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(docs, size, percent):
    sets = {i: shingles(t, size) for i, t in docs}
    root = {i: i for i in sets}
    find = lambda i: i if root[i] == i else find(root[i])
    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {(i, len(s), find(i), find(i) == i) for i, s in sets.items()}


def variants(rng):
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for length in (1, 2, 3, 4, 7, 12, 25, 33, 60, 150, 700):
        base = rng.choices(vocabulary, k=length)
        for edits in (0, 0, 1, 1, 2, 3, 5, 9, 20):
            words = list(base)
            for _ in range(edits):
                words[rng.randrange(length)] = rng.choice(vocabulary)
            texts.append("\t".join(words).upper() if edits == 1 else " ".join(words))
    shared = " ".join(rng.choices(vocabulary, k=60))
    texts += [shared + " " + " ".join(rng.choices(vocabulary, k=rng.randrange(5, 120))) for _ in range(60)]
    chain = rng.choices(vocabulary, k=100)
    for _ in range(25):  # neighbours are alike, ends are not
        chain[rng.randrange(100)] = rng.choice(vocabulary)
        texts.append(" ".join(chain))
    return [*texts, "", None, "  \n", "é à", "É à", "é à"]


def test_against_all_pairs(docs_of):
    docs = list(enumerate(variants(random.Random(5))))
    random.Random(6).shuffle(docs)
    for size, percent in ((3, 85), (5, 80)):
        got = {tuple(r) for r in minhash.near_duplicates(docs_of(docs), size, percent).collect()}
        assert got == brute(docs, size, percent)


def test_rows_without_or_with_shared_ids(docs_of):
    docs = [(None, "a b c d"), (1, "a b c d"), (2, "a b c d"), (2, "a b c d"), (3, None)]
    got = sorted(minhash.near_duplicates(docs_of(docs), 3, 85).collect(), key=str)
    assert sorted(map(tuple, got), key=str) == sorted([(None, 2, None, False), (1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (3, 0, 3, True)], key=str)
    assert minhash.near_duplicates(docs_of([]), 3, 85).count() == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(50), rng.randrange(50)) for _ in range(30)] + [(None, 3), (7, 7)]
    root = {}
    find = lambda i: i if root.setdefault(i, i) == i else find(root[i])
    for a, b in links:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(i, find(i)) for i in list(root)}


def test_rows_that_share_an_id_are_one_node(spark, docs_of):
    rng = random.Random(1)
    x, y, z = (" ".join(f"{c}{rng.randrange(999)}" for _ in range(40)) for c in "xyz")
    rows = [(5, x), (5, y), (9, x), (3, y), (7, z), (8, z + " more"), (5, ""), (6, None), (6, ""), (None, x)]
    got = minhash.near_duplicates(docs_of(rows), 3, 85).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id) == [(3, 3), (5, 3), (5, 3), (5, 3), (6, 6), (6, 6), (7, 7), (8, 7), (9, 3)]
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, False)]

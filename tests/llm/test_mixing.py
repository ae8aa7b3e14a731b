import math
import random

from hexfold.llm import mixing

SCHEMA = "doc_id long, source string, text string"


def words(n):
    return " ".join(["w"] * n)


def wanted(totals):
    """Targets by sharing what is above again, one source after the other."""
    whole, left = 1.5 * sum(totals), dict(enumerate(totals))
    target, weights = {}, [(3, 1, 2)[i % 3] for i in range(len(totals))]
    while left:
        level = (whole - sum(target.values())) / sum(weights[i] for i in left)
        over = [i for i, n in left.items() if weights[i] * level > 2 * n]
        if not over:
            target |= {i: weights[i] * level for i in left}
            break
        for i in over:
            target[i] = 2 * left.pop(i)
    return [target[i] for i in range(len(totals))]


def test_targets_are_met_and_reruns_agree(spark):
    rng = random.Random(3)
    rows = []
    for s in range(12):
        for _ in range(rng.choice([5, 40, 200])):
            rows.append((len(rows), f"s{s:02d}", words(int(rng.paretovariate(0.9)) % 4000)))
    rows += [(None, None, words(rng.randrange(30))) for _ in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mixed(docs.repartition(5)).collect()
    again = mixing.mixed(docs.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    names = sorted({r[1] for r in rows if r[1]}) + [None]
    of = {r[0]: r[1] for r in rows}
    size = {n: sum(len(r[2].split()) for r in rows if r[1] == n) for n in names}
    target = dict(zip(names, wanted([size[n] for n in names]), strict=True))
    assert math.isclose(sum(target.values()), 1.5 * sum(size.values()))
    taken = dict.fromkeys(names, 0)
    for r in got:
        n = of[r["doc_id"]]
        assert r["source_size"] == size[n] and math.isclose(r["target"], target[n], rel_tol=1e-9)
        assert r["taken"] == r["size"] * r["copies"] and r["copies"] in (0, 1, 2)
        taken[n] += r["taken"]
    for n in names:
        assert abs(taken[n] - target[n]) <= max(0.01 * target[n], 6), n


def test_rates_are_exponential_in_size(spark):
    """Duals against a bisection, and copies against rates, where sizes are many enough to see them."""
    rows = [(i, "a", words(1 + i % 50)) for i in range(4000)] + [(i, "b", words(20)) for i in range(4000, 4050)]
    got = {r["doc_id"]: r for r in mixing.mixed(spark.createDataFrame(rows, SCHEMA)).collect()}
    sizes, target = [1 + i % 50 for i in range(4000)], got[0]["target"]
    mean, low, high = sum(sizes) / len(sizes), -50.0, 50.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(n * min(2, math.exp(mid * n / mean)) for n in sizes) < target else (low, mid)
    for n in (1, 10, 30, 50):
        copies = [got[i]["copies"] for i in range(4000) if sizes[i] == n]
        assert abs(sum(copies) / len(copies) - min(2, math.exp(low * n / mean))) < 0.03


def test_edge_cases(spark):
    assert mixing.mixed(spark.createDataFrame([], SCHEMA)).collect() == []
    nothing = mixing.mixed(spark.createDataFrame([(1, "a", None), (2, None, ""), (3, None, " \n ")], SCHEMA)).collect()
    assert {(r["doc_id"], r["size"], r["target"], r["taken"]) for r in nothing} == {(1, 0, 0, 0), (2, 0, 0, 0), (3, 0, 0, 0)}
    one = mixing.mixed(spark.createDataFrame([(1, "a", words(10)), (1, "a", words(10)), (2, "a", None)], SCHEMA).withColumnRenamed("doc_id", "size"), name="size")
    assert one.columns[0] == "size_in" and len(one.columns) == 6
    assert sorted(r["taken"] for r in one.toDF("id", *one.columns[1:]).collect()) == [0, 10, 20]
    same = mixing.mixed(spark.createDataFrame([(i, "a" if i < 900 else "b", words(7)) for i in range(1000)], SCHEMA)).collect()
    assert sum(r["taken"] for r in same if r["doc_id"] >= 900) == 1400 == round(same[-1]["target"]) or sum(r["taken"] for r in same) == 10500

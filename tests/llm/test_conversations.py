import hashlib
import random
import zlib

import duckdb

from hexfold.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string"


def every_way(rows, start, ends):
    """The least (cost, audit) by a table of all states after every row."""
    best = {start: (0, "")}
    for place in range(len(rows) + 1):
        for _ in range(3):  # rows inserted here
            for state, (cost, audit) in list(best.items()):
                way = (cost + 5, audit + "I")
                if cv.TURN[state] not in best or way < best[cv.TURN[state]]:
                    best[cv.TURN[state]] = way
        if place == len(rows):
            break
        after = {}
        for state, (cost, audit) in best.items():
            for edit, more, _, then in cv.children(rows, place, state):
                if edit != "I":
                    way = (cost + more, audit + edit)
                    after[then] = min(after.get(then, way), way)
        best = after
    found = [best[e] for e in ends if e in best]
    return min(found) if found else None


def test_search_is_least_and_first():
    rng = random.Random(2)
    for n in range(400):
        rows = [(rng.choice("suuaao"), rng.choice([0, 0, 0, 1, 2])) for _ in range(rng.randrange(0, 9) if n < 300 else rng.randrange(9, 33))]
        assert cv.suffix_bounds(rows)[0] <= every_way(rows, "E", "EA")[0]
        for start in "ESUA":
            for ends in ("EA", "E", "S", "U", "A"):
                assert cv.search(rows, start, ends) == every_way(rows, start, ends), (rows, start, ends)


def test_blocks_join_to_the_whole():
    rng = random.Random(4)
    for _ in range(40):
        rows = [(rng.choice("suuaao"), rng.choice([0, 0, 0, 1, 2])) for _ in range(rng.randrange(20, 60))]
        codes = "".join(chr(65 + cv.INITIALS.index(i) * 3 + f) for i, f in rows)
        cuts = [codes[at : at + 13] for at in range(0, len(codes), 13)]
        parts = [cv.block(x, i == 0, i == len(cuts) - 1)[0] for i, x in enumerate(cuts)]
        ways = cv.joined([cv.joined(parts[:2]), *parts[2:]])
        assert min((c, a) for s, e, c, a in ways if s == "E" and e in "EA") == every_way(rows, "E", "EA")


def test_equals_sql_on_long_and_odd_conversations(spark, tmp_path):
    rng = random.Random(7)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "agent"]
    texts = ["Yes.", "No", "", None, " ", "\n", "A question?", "end! \t", "x" * 3000 + ".", "Déjà.", "cut"]
    rows = [(1, t, ["user", "assistant"][t % 2] if rng.random() < 0.7 else rng.choice(roles), f"Line {rng.randrange(900)}{rng.choice(['.', '.', '?', ''])}") for t in range(2600)]
    for conv in range(2, 90):
        rows += [(conv, t if rng.random() < 0.9 else None, rng.choice(roles), rng.choice(texts)) for t in rng.sample(range(20), rng.randrange(1, 12))]
    rows += [(None, 0, "user", "Lost."), (None, 1, "assistant", "Found.")] + [(500, 3, "user", "Same.")] * 40
    # rows of one turn come in an order of their own: one row a turn here, but for equal ones
    rows = list({(r[0], r[1], r[2], r[3]) if r[0] == 500 or r[1] is None else (r[0], r[1]): r for r in rows}.values())
    rows = [r for r in rows if r[1] is not None] + [(r[0], None, "user", "Null turn.") for r in rows if r[1] is None] + [(500, 3, "user", "Same.")] * 39
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    df.write.parquet(str(tmp_path / "c"))
    with duckdb.connect() as con:
        con.sql(f"create view conversations as select * from '{tmp_path}/c/*.parquet'")
        want = con.sql(f"select conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 from ({cv.SQL})").fetchall()
    got = cv.repairs(df).collect()
    key = lambda r: (r[0] is None, r[0])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_edge_cases(spark):
    assert cv.repairs(spark.createDataFrame([], SCHEMA)).collect() == []
    nothing = hashlib.sha256(b"").hexdigest()
    dropped = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    (row,) = cv.repairs(spark.createDataFrame([(5, dropped, "user", "Hi.")], SCHEMA)).collect()
    assert tuple(row) == (5, 0, 0, 0, 0, 0, 0, "", nothing)
    kept = [t for t in range(1000) if zlib.crc32(f"6:{t}".encode()) % 20 > 4][:2]
    clash = spark.createDataFrame([(6, kept[0], "user", "Hi.", 1), (6, kept[1], "assistant", "Hello.", 1)], f"{SCHEMA}, _i long").withColumnRenamed("conv_id", "cost")
    (row,) = cv.repairs(clash, conv="cost").toDF("id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha").collect()
    assert row["audit"] == "KK" and row["gaps"] == kept[1] - kept[0] - 1 and row["sha"] == hashlib.sha256(b"user:Hi.\nassistant:Hello.").hexdigest()

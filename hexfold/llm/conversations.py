"""Repair of the structure of conversations at least cost, by depth-first branch and bound.

A conversation should read as an optional system row and then user and
assistant in turn.  Rows are kept, given another role or deleted, and rows
without text inserted; of the cheapest ways the one whose audit (the initials
of its edits) is least is taken.

All that the search needs of a row is one character.  Rows are numbered in the
order of all conversations, and the characters of ``BLOCK`` numbers are a block
of their conversation, so a conversation of any length is many small searches:
each finds, for every state that the block may be entered and left in, the best
(cost, audit) between them.  Blocks are joined in levels until one is left.
Texts stay in rows; at the end they pass a task in order, whose only memory is
the state of a hash.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexfold.llm.common import Scratch, kept_name, written
from hexfold.llm.ordering import running

BLOCK = 32
SPACES = " \t\n\x0b\f\r"
ROLES = {"u": "user", "a": "assistant"}
DELETE, INSERT, REROLE, CUT_SHORT = 2, 5, 1, 5
# states: E nothing yet, S after the system row, U after a user row, A after an assistant row
TURN = {"E": "U", "S": "U", "A": "U", "U": "A"}  #: the state that the next user or assistant row leads to
KEEP = {("E", "s"): "S", ("E", "u"): "U", ("S", "u"): "U", ("A", "u"): "U", ("U", "a"): "A"}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
INITIALS = "suao"  #: o: any other
SOUND, GONE, SHORT = 0, 1, 2  #: faults: none, to be deleted (blank or duplicate), cut short


def code(initial: Column, fault: Column) -> Column:
    """A row as one letter: initial and fault."""
    i = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.char(F.lit(65) + i * 3 + fault)


def decoded(codes: str) -> list[tuple[str, int]]:
    return [(INITIALS[(ord(x) - 65) // 3], (ord(x) - 65) % 3) for x in codes]


def suffix_bounds(rows: list[tuple[str, int]]) -> list[int]:
    """What the rows from each on cost at least.

    A row to be deleted, or cut short, costs 2 at least.  Of two sound rows
    that follow each other, with such rows between them at most, and whose
    initials may not, one is edited or a row is inserted; pairs do not share rows.
    """
    bounds, sound = [0] * (len(rows) + 1), None  # sound: place of the next sound row
    for i in range(len(rows) - 1, -1, -1):
        initial, fault = rows[i]
        if fault != SOUND:
            bounds[i] = bounds[i + 1] + DELETE
            continue
        alone = bounds[i + 1] + (REROLE if initial == "o" else 0)
        if sound is not None and (initial, rows[sound][0]) not in LEGAL:
            alone = max(alone, bounds[sound + 1] + DELETE * (sound - i - 1) + REROLE)
        bounds[i], sound = alone, i
    return bounds


def children(rows: list[tuple[str, int]], at: int, state: str) -> list[tuple[str, int, int, str]]:
    """(edit, cost, place, state) in the order of edits' initials."""
    if at == len(rows):
        return [("I", INSERT, at, TURN[state])]
    initial, fault = rows[at]
    out = [("D", DELETE, at + 1, state), ("I", INSERT, at, TURN[state])]
    if fault != GONE:
        more = CUT_SHORT if fault == SHORT else 0
        if (state, initial) in KEEP:
            out.append(("K", more, at + 1, KEEP[state, initial]))
        out.append(("R", REROLE + more, at + 1, TURN[state]))
    return out


def dive(rows, bounds, start: str, ends: str) -> tuple[int, str] | None:
    """A first incumbent: at each place the edit of least cost and bound, then rows inserted until an end is reached."""
    at, state, cost, audit = 0, start, 0, ""
    while at < len(rows):
        edit, more, at, state = min((e for e in children(rows, at, state) if e[0] != "I"), key=lambda e: (e[1] + bounds[e[2]], e[0] != "K", e[0]))
        cost, audit = cost + more, audit + edit
    for _ in range(3):
        if state in ends:
            return cost, audit
        cost, audit, state = cost + INSERT, audit + "I", TURN[state]
    return None


def search(rows: list[tuple[str, int]], start: str, ends: str) -> tuple[int, str] | None:
    """The least (cost, audit) from ``start`` to one of ``ends`` over all rows; None where there is no way.

    Nodes are places and states.  A node is left where an earlier way to it was
    no worse, or where its cost and bound do not beat the incumbent.
    """
    bounds = suffix_bounds(rows)
    incumbent = dive(rows, bounds, start, ends)
    best: dict[tuple[int, str], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        if incumbent is not None and (cost + bounds[at], audit) > incumbent:
            continue
        if (at, state) in best and best[at, state] <= (cost, audit):
            continue
        best[at, state] = (cost, audit)
        if at == len(rows) and state in ends and (incumbent is None or (cost, audit) < incumbent):
            incumbent = (cost, audit)
        for edit, more, to, then in reversed(children(rows, at, state)):
            if incumbent is None or cost + more + bounds[to] <= incumbent[0]:
                stack.append((to, then, cost + more, audit + edit))
        if incumbent is None and cost > (DELETE + INSERT) * (len(rows) + 2):
            return None  # inserted rows alone go on: no end can be reached
    return incumbent


@lru_cache(maxsize=100_000)
def block(codes: str, first: bool, last: bool) -> tuple[list, int]:
    """Entries (start, end, cost, audit) of a block, and its illegal pairs.

    Only the first block is entered before anything is kept for sure, and only
    the last has to end there or after an assistant's row; E is left by no way back.
    """
    rows = decoded(codes)
    entries = []
    for start in "E" if first else "ESUA":
        for end in "EA" if last else "ESUA":
            if end == "E" and start != "E" or end == "S" and start not in "ES":
                continue
            found = search(rows, start, end)
            if found:
                entries.append((start, end, *found))
    return entries, sum((a[0], b[0]) not in LEGAL for a, b in zip(rows, rows[1:], strict=False))


def joined(parts: list[list]) -> list[tuple[str, str, int, str]]:
    """Entries of blocks that follow each other, as those of one."""
    whole = {(s, e): (cost, audit) for s, e, cost, audit in parts[0]}
    for part in parts[1:]:
        after: dict[tuple[str, str], tuple[int, str]] = {}
        for (s, m), (cost, audit) in whole.items():
            for m2, e, more, rest in part:
                if m == m2 and ((s, e) not in after or cost + more <= after[s, e][0]):
                    way = (cost + more, audit + rest)
                    after[s, e] = min(after.get((s, e), way), way)
        whole = after
    return [(s, e, cost, audit) for (s, e), (cost, audit) in whole.items()]


ENTRY = "array<struct<s: string, e: string, cost: bigint, audit: string>>"
ENTRIES = pa.list_(pa.struct([("s", pa.string()), ("e", pa.string()), ("cost", pa.int64()), ("audit", pa.string())]))
PART = f"_ways {ENTRY}, _illegal bigint, _first string, _last string"


def _packed(keys: list[pa.Array], names: list[str], made: list[tuple]) -> pa.RecordBatch:
    ways = pa.array([[dict(zip(("s", "e", "cost", "audit"), x, strict=True)) for x in m[0]] for m in made], ENTRIES)
    rest = [pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.string()), pa.array([m[3] for m in made], pa.string())]
    return pa.RecordBatch.from_arrays([*keys, ways, *rest], names=[*names, "_ways", "_illegal", "_first", "_last"])


def searched(blocks: DataFrame) -> DataFrame:
    """_c, _b and the ways of blocks (_c, _b, _codes, _is_first, _is_last)."""

    def solve(batches):
        for batch in batches:
            made = []
            for codes, first, last in zip(*(batch.column(x).to_pylist() for x in ("_codes", "_is_first", "_is_last")), strict=True):
                ways, illegal = block(codes, first, last)
                made.append((ways, illegal, decoded(codes[0])[0][0], decoded(codes[-1])[0][0]))
            yield _packed([batch.column("_c"), batch.column("_b")], ["_c", "_b"], made)

    return blocks.mapInArrow(solve, f"_c {blocks.schema['_c'].dataType.simpleString()}, _b long, {PART}")


def level(parts: DataFrame) -> DataFrame:
    """Parts (_c, _b and ways) joined by ``BLOCK`` of them."""
    lists = parts.groupBy("_c", F.expr(f"_b div {BLOCK}").alias("_b")).agg(F.array_sort(F.collect_list(F.struct(F.col("_b").alias("b"), "_ways", "_illegal", "_first", "_last"))).alias("_parts"))

    def join(batches):
        for batch in batches:
            made = []
            for parts in batch.column("_parts").to_pylist():
                illegal = sum(p["_illegal"] for p in parts) + sum((a["_last"], b["_first"]) not in LEGAL for a, b in zip(parts, parts[1:], strict=False))
                made.append((joined([[(w["s"], w["e"], w["cost"], w["audit"]) for w in p["_ways"]] for p in parts]), illegal, parts[0]["_first"], parts[-1]["_last"]))
            yield _packed([batch.column("_c"), batch.column("_b")], ["_c", "_b"], made)

    return lists.mapInArrow(join, f"_c {parts.schema['_c'].dataType.simpleString()}, _b long, {PART}")


def slices(convs: DataFrame) -> DataFrame:
    """_c, _at (number of the first row), _edits, _state: the audits (_c, _lo, _hi, _audit) cut at blocks; inserted rows lead their block."""

    def cut(batches):
        for batch in batches:
            for i, (lo, hi, audit) in enumerate(zip(*(batch.column(x).to_pylist() for x in ("_lo", "_hi", "_audit")), strict=True)):
                out, at, number = [], 0, lo
                while number <= hi:
                    to, last = at, min(hi, number // BLOCK * BLOCK + BLOCK - 1)
                    for _ in range(last - number + 1):
                        while audit[to] == "I":
                            to += 1
                        to += 1
                    if last == hi:
                        to = len(audit)
                    out.append((number, audit[at:to]))
                    at, number = to, last + 1
                key = batch.column("_c").take(pa.array([i] * len(out), pa.int64()))
                yield pa.RecordBatch.from_arrays([key, pa.array([n for n, _ in out], pa.int64()), pa.array([e for _, e in out], pa.string())], names=["_c", "_at", "_edits"])

    return convs.mapInArrow(cut, f"_c {convs.schema['_c'].dataType.simpleString()}, _at long, _edits string")


def hashed(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """_c, _sha of each repaired conversation: ``role:text`` of its rows, joined by newlines.

    Rows (_c, _i, _role, _text) follow their slices (_c, _at, _edits) in order;
    a task keeps the hash and the edits of one block.
    """
    kind = rows.schema["_c"].dataType.simpleString()
    led = edits.select("_c", F.col("_at").alias("_i"), F.lit(0).alias("_k"), F.col("_edits").alias("_role"), F.lit("").alias("_text"))
    both = led.union(rows.select("_c", "_i", F.lit(1).alias("_k"), "_role", "_text"))
    both = both.repartition("_c").sortWithinPartitions("_i", "_k")

    def run(batches):
        now = None  # [key, hash, number of lines, state, edits left]

        def line(role: str, text: str) -> None:
            now[1].update((("\n" if now[2] else "") + role + ":" + text).encode())
            now[2] += 1

        def insert() -> None:
            while now[4][:1] == "I":
                now[3], now[4] = TURN[now[3]], now[4][1:]
                line(ROLES[now[3].lower()], "")

        for batch in batches:
            out = []
            for key, k, role, text in zip(*(batch.column(x).to_pylist() for x in ("_c", "_k", "_role", "_text")), strict=True):
                if now is None or key != now[0]:
                    if now is not None:
                        out.append((now[0], now[1].hexdigest()))
                    now = [key, hashlib.sha256(), 0, "E", ""]
                if not k:
                    now[4] += role
                    insert()
                    continue
                edit, now[4] = now[4][0], now[4][1:]
                if edit == "K":
                    now[3] = KEEP[now[3], role[:1]]
                    line(role, text)
                elif edit == "R":
                    now[3] = TURN[now[3]]
                    line(ROLES[now[3].lower()], text)
                insert()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], batch.column("_c").type), pa.array([b for _, b in out], pa.string())], names=["_c", "_sha"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now[0]], batch.column("_c").type), pa.array([now[1].hexdigest()], pa.string())], names=["_c", "_sha"])

    return both.mapInArrow(run, f"_c {kind}, _sha string")


def damaged(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """_c, _turn, _role, _text after the damage that a row's ``conv:turn`` stands for; nulls are one space, but for _c and _turn."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(space(conv), F.lit(":"), space(turn))) % 20
    rows = conversations.select(F.col(conv).alias("_c"), F.col(turn).alias("_turn"), space(role).alias("_role"), space(text).alias("_text"), fate.alias("_f")).filter("_f <> 0")
    body = F.when(F.col("_f") == 1, "").when(F.col("_f") == 2, F.translate("_text", ".!?", "")).otherwise(F.col("_text"))
    rows = rows.select("_c", "_turn", F.when(F.col("_f") == 4, "user").otherwise(F.col("_role")).alias("_role"), body.alias("_text"), F.explode(F.array_repeat(F.lit(1), F.when(F.col("_f") == 3, 2).otherwise(1))).alias("_one"))
    return rows.withColumn("_one", F.col("_one").cast("long"))


def repaired(rows: DataFrame) -> DataFrame:
    """_c and what is found and mended in each conversation of ``rows`` (_c, _turn, _role, _text, none of the texts null; _one: 1)."""
    c = F.col
    with Scratch(rows.sparkSession) as scratch:
        order = [c("_c").isNull(), c("_c"), c("_turn").asc_nulls_first(), c("_role"), F.xxhash64("_text")]
        placed = running(rows, order, "_one", scratch, "rows").withColumnRenamed("_before", "_i").drop("_one")
        trimmed = F.rtrim(c("_text"), F.lit(SPACES))
        placed = placed.withColumns({"_blank": trimmed == "", "_short": ~F.right(trimmed, F.lit(1)).isin(".", "!", "?")})
        seen = placed.filter("not _blank").groupBy("_c", "_role", F.sha2("_text", 256)).agg(F.min("_i").alias("_i")).select("_i", F.lit(True).alias("_new"))
        marked = placed.select("_c", "_i", "_turn", F.substring("_role", 1, 1).alias("_initial"), "_blank", "_short").join(seen, "_i", "left")
        again = ~c("_blank") & c("_new").isNull()
        short = ~c("_blank") & ~again & c("_short")
        fault = F.when(c("_blank") | again, GONE).when(short, SHORT).otherwise(SOUND)
        marked = scratch.written(marked.select("_c", "_i", "_turn", c("_blank"), again.alias("_again"), short.alias("_short"), code(c("_initial"), fault).alias("_code")), "marked")
        turns = F.max("_turn") - F.min("_turn") + 1 - F.count_distinct("_turn")
        counts = [F.count_if(n).alias(n) for n in ("_blank", "_again", "_short")]
        convs = scratch.written(marked.groupBy("_c").agg(F.min("_i").alias("_lo"), F.max("_i").alias("_hi"), F.coalesce(turns, F.lit(0)).cast("long").alias("_gaps"), *counts), "conversations")
        blocks = marked.groupBy("_c", F.expr(f"_i div {BLOCK}").alias("_b")).agg(F.array_sort(F.collect_list(F.struct("_i", "_code"))).alias("_l"))
        blocks = blocks.select("_c", "_b", F.array_join(F.transform("_l", lambda x: x["_code"]), "").alias("_codes"), c("_l")[0]["_i"].alias("_from"), F.element_at("_l", -1)["_i"].alias("_to"))
        ends = convs.select(c("_c").alias("_k"), "_lo", "_hi")
        blocks = blocks.join(ends, blocks["_c"].eqNullSafe(ends["_k"])).select("_c", "_b", "_codes", (c("_from") == c("_lo")).alias("_is_first"), (c("_to") == c("_hi")).alias("_is_last"), "_lo", "_hi")
        parts = scratch.written(searched(blocks.select("_c", "_b", "_codes", "_is_first", "_is_last")), "parts")
        width, done = BLOCK, None
        while True:
            one = convs.filter(F.expr(f"_lo div {width} = _hi div {width}")).select(c("_c").alias("_k"))
            whole = parts.join(one, parts["_c"].eqNullSafe(one["_k"]), "left_semi")
            done = whole if done is None else done.union(whole)
            rest = parts.join(one, parts["_c"].eqNullSafe(one["_k"]), "left_anti")
            if rest.isEmpty():
                break
            parts, width = scratch.written(level(rest), "parts"), width * BLOCK
        way = F.array_min(F.transform(F.filter("_ways", lambda w: (w["s"] == "E") & w["e"].isin("E", "A")), lambda w: F.struct(w["cost"].alias("cost"), w["audit"].alias("audit"))))
        best = done.select(c("_c").alias("_k"), "_illegal", way.alias("_way"))
        found = scratch.written(convs.join(best, convs["_c"].eqNullSafe(best["_k"])).select("_c", "_lo", "_hi", "_gaps", "_blank", "_again", "_short", "_illegal", c("_way.cost").alias("_cost"), c("_way.audit").alias("_audit")), "found")
        marks = hashed(placed, slices(found.select("_c", "_lo", "_hi", "_audit"))).withColumnRenamed("_c", "_k")
        return written(found.join(marks, found["_c"].eqNullSafe(marks["_k"])).drop("_k", "_lo", "_hi"), "repaired")


def repairs(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation, damaged first.

    Rows go by turn, nulls first; rows of one turn by role and then in the order
    of a hash of their texts, so equal rows stay side by side.  Rows without a
    conversation are one.  A role counts by its first letter, an empty one or
    one of spaces is illegal.  Null texts and roles are one space.  What no
    damaged row is left of has zeros, an empty audit and the hash of nothing.
    A ``conv`` like a made column's is returned as ``<conv>_in``.
    """
    names = {"_gaps": "gaps", "_blank": "blank", "_again": "duplicate", "_short": "truncated", "_illegal": "illegal", "_cost": "cost"}
    every = conversations.select(F.col(conv).alias("_k")).distinct()
    done = repaired(damaged(conversations, conv, turn, role, text))
    all_ = every.join(done, every["_k"].eqNullSafe(done["_c"]), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return all_.select(F.col("_k").alias(kept_name(conv, [*names.values(), "audit", "repaired_sha256"])), *[F.coalesce(F.col(a), F.lit(0)).cast("long").alias(b) for a, b in names.items()], F.coalesce("_audit", F.lit("")).alias("audit"), F.coalesce("_sha", F.lit(nothing)).alias("repaired_sha256"))


def _sql() -> str:
    """The same by a table of the best way to every state after every row, for all rows in turn."""
    spaces = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
    crc = "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(k, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"
    return f"""WITH RECURSIVE g AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS k FROM conversations),
 h AS (SELECT *, {crc} % 20 AS f FROM g),
 d AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE f WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE f <> 0),
 o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, rtrim(text, {spaces}) AS body, role[1] AS m FROM d),
 q AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, lag(m) OVER (PARTITION BY conv_id ORDER BY i) AS p FROM o),
 r AS (SELECT *, CASE WHEN body = '' THEN 1 WHEN again THEN 2 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM q),
 stats AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
  count(*) FILTER (p IS NOT NULL AND concat(p, m) NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM r GROUP BY conv_id),
 ins AS (SELECT * FROM (VALUES ('E', 'E', 0, '', ''), ('S', 'S', 0, '', ''), ('U', 'U', 0, '', ''), ('A', 'A', 0, '', ''), ('E', 'U', 5, 'I', concat(chr(10), 'user:')), ('S', 'U', 5, 'I', concat(chr(10), 'user:')), ('A', 'U', 5, 'I', concat(chr(10), 'user:')), ('U', 'A', 5, 'I', concat(chr(10), 'assistant:')),
  ('E', 'A', 10, 'II', concat(chr(10), 'user:', chr(10), 'assistant:')), ('S', 'A', 10, 'II', concat(chr(10), 'user:', chr(10), 'assistant:')), ('A', 'A', 10, 'II', concat(chr(10), 'user:', chr(10), 'assistant:')), ('U', 'U', 10, 'II', concat(chr(10), 'assistant:', chr(10), 'user:'))) AS t(a, b, cost, audit, lines)),
 w AS (SELECT conv_id, 0::BIGINT AS i, 'E' AS s, (0::BIGINT, '', '') AS x FROM stats UNION ALL
  SELECT conv_id, i, s, min(x) AS x FROM (SELECT w.conv_id, r.i, CASE e.e WHEN 'D' THEN ins.b WHEN 'K' THEN upper(r.m) ELSE CASE ins.b WHEN 'U' THEN 'A' ELSE 'U' END END AS s,
   (x[1] + ins.cost + CASE e.e WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN e.e <> 'D' AND fault = 3 THEN 5 ELSE 0 END, concat(x[2], ins.audit, e.e),
    concat(x[3], ins.lines, CASE e.e WHEN 'D' THEN '' WHEN 'K' THEN concat(chr(10), role, ':', text) ELSE concat(chr(10), CASE ins.b WHEN 'U' THEN 'assistant' ELSE 'user' END, ':', text) END)) AS x
   FROM w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1 JOIN ins ON ins.a = w.s CROSS JOIN (VALUES ('D'), ('K'), ('R')) e(e)
   WHERE e.e = 'D' OR (fault IN (0, 3) AND (e.e = 'R' OR (ins.b = 'E' AND m IN ('s', 'u')) OR (ins.b IN ('S', 'A') AND m = 'u') OR (ins.b = 'U' AND m = 'a')))) GROUP BY conv_id, i, s),
 z AS (SELECT w.conv_id, min((x[1] + ins.cost, concat(x[2], ins.audit), concat(x[3], ins.lines))) AS x FROM w JOIN stats ON stats.conv_id IS NOT DISTINCT FROM w.conv_id AND stats.n = w.i JOIN ins ON ins.a = w.s WHERE ins.b IN ('E', 'A') GROUP BY w.conv_id),
 every AS (SELECT DISTINCT conv_id FROM conversations)
 SELECT every.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(x[1], 0)::BIGINT AS cost, coalesce(x[2], '') AS audit, sha256(coalesce(x[3][2:], '')) AS repaired_sha256
 FROM every LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM every.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM every.conv_id"""


SQL = _sql()

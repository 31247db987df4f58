"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import zlib

import pytest

from loadlens.llm import conversation_repair as cr

SPACE = " \t\n\x0b\x0c\r"
NEXT = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}


def cheapest(rows):
    """rows: (initial, must go, cut). Least (cost, audit) over states, row by row, insertions before every row and at the end."""
    def inserted(front):
        front = dict(front)
        for _ in range(4):
            for p, (c, a) in list(front.items()):
                q = {"0": "U", "S": "U", "U": "A", "A": "U"}[p]
                front[q] = min(front.get(q, (1 << 60, "")), (c + 2, a + "I"))
        return front

    front = inserted({"0": (0, "")})
    for initial, gone, cut in rows:
        after = {}
        def take(q, c, a):
            after[q] = min(after.get(q, (1 << 60, "")), (c, a))
        for p, (c, a) in front.items():
            take(p, c + 3, a + "D")
            if not gone:
                if (p, initial) in NEXT:
                    take(NEXT[p, initial], c + cut, a + "K")
                for r in "ua":
                    if (p, r) in NEXT:
                        take(NEXT[p, r], c + 2 + cut, a + "R")
        front = inserted(after)
    return min(v for k, v in front.items() if k in "0A")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        one = lambda x: " " if x is None else x
        kind = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        role, text = one(role), one(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def expected(rows):
    every = {r[0] for r in rows}
    after = {}
    for r in damaged(rows):
        after.setdefault(r[0], []).append(r)
    out = {}
    for conv in every:
        mine = sorted(after.get(conv, []), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        turns = {r[1] for r in mine} - {None}
        counts = dict(gaps=max(turns) - min(turns) + 1 - len(turns) if turns else 0, blank=0, duplicate=0, truncated=0, illegal=0)
        seen, items = set(), []
        for _, _, role, text in mine:
            bare = text.rstrip(SPACE)
            gone, cut = False, not bare.endswith((".", "!", "?"))
            if not bare:
                counts["blank"] += 1
                gone = True
            elif (role, text) in seen:
                counts["duplicate"] += 1
                gone = True
            elif cut:
                counts["truncated"] += 1
            seen.add((role, text))
            items.append((role[:1], gone, cut))
        counts["illegal"] = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(items, items[1:]))
        cost, audit = cheapest(items)
        state, repaired, i = "0", [], 0
        for edit in audit:
            due = "a" if state == "U" else "u"
            if edit == "I":
                repaired.append(("user:", "assistant:")[due == "a"])
            else:
                _, _, role, text = mine[i]
                i += 1
                if edit == "D":
                    continue
                if edit == "R":
                    role = {"u": "user", "a": "assistant"}[due]
                due = role[0]
                repaired.append(f"{role}:{text}")
            state = NEXT[state, due]
        assert state in "0A"
        out[conv] = {**counts, "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(repaired).encode()).hexdigest()}
    return out


def found(df):
    return {r["conv_id"]: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in cr.repair_damaged(df).collect()}


SCHEMA = "conv_id long, turn long, role string, text string"


def test_query_against_search(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    assert found(df) == expected([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("parts", [1, 3])
def test_odd_rows(spark, parts):
    rnd = random.Random(5)
    rows = []
    for conv in [None, *range(60)]:
        for _ in range(rnd.randrange(0, 14)):
            role = rnd.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            text = rnd.choice(["A.", "B!", "B! ", "cut", "", " \t", None, "Long. " * 50, "x?\n"])
            rows.append((conv, rnd.choice([None, *range(12)]), role, text))
    rows += rows[:9]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS part", "'x' AS digest", "true AS first", "0 AS copies", "2 AS n")
        assert found(df) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_one_conversation_over_many_tasks(spark):
    """A conversation that holds most rows is parsed in spans of several tasks."""
    rnd = random.Random(2)
    rows = [(7, i, rnd.choice(["user", "assistant"]), f"{i % 1500}{rnd.choice(['.', '', '!'])}") for i in range(3000)]
    rows += [(c, t, "user", "Hm.") for c in (6, 8) for t in range(2)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == expected(rows)


def test_rows_all_dropped_and_empty_table(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    got = found(spark.createDataFrame([(1, gone, "user", "Hi.")], SCHEMA))
    nothing = dict(gaps=0, blank=0, duplicate=0, truncated=0, illegal=0, cost=0, audit="", repaired_sha256=hashlib.sha256(b"").hexdigest())
    assert got == {1: nothing}
    assert found(spark.createDataFrame([], SCHEMA)) == {}


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", ""), (1, 3, "user", "Why?"), (2, 0, "user", "cut")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1L AS copies")
    got = {(r.conv_id, r.position): (r.edit, r.role, r.text) for r in cr.repair(df).collect()}
    assert got == {
        (1, 1): ("K", "system", "Be kind."), (1, 2): ("I", "user", ""), (1, 3): ("K", "assistant", "Hello."),
        (1, 4): ("K", "user", "Why?"), (1, 5): ("I", "assistant", ""),
    }
    # the second is as dear kept and answered (KI) as deleted; the lesser audit wins
    assert {r.conv_id: (r.cost, r.audit) for r in cr.parse(df).collect()} == {1: (7, "KIKDKI"), 2: (3, "D")}


def test_long_and_string_ids(spark):
    df = spark.createDataFrame([("a", 0, "user", "x. " * 400_000), ("a", 1, "assistant", "Yes.")], "conv_id string, turn long, role string, text string")
    got = cr.parse(df.selectExpr("*", "1 AS copies")).collect()
    assert [(r.conv_id, r.cost, r.audit) for r in got] == [("a", 0, "KK")]

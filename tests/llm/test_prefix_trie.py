"""The burst trie against plain grouping of all prefixes, and against DuckDB."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from loadlens.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def sequences(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn, role or "", text or ""))
    key = lambda t: hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest()[:16]
    return {c: [t[1:] for t in sorted(ts, key=lambda t: (t[0] is not None, t[0] or 0, key(t)))] for c, ts in convs.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + turns[h:]
    return out


def nodes(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        own = (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved[p] = own + sum(saved[k] for k in kids[p])
    ends = lambda p: ",".join(map(str, sorted(c for c in members[p] if len(convs[c]) == len(p))))
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends(p).encode()).hexdigest())
        for p, m in members.items()
    )


def found(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(*pt.NODE.names).collect())


@pytest.mark.parametrize("most", [2, 60, pt.MOST])
def test_query_against_plain_grouping(spark, sf, most):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert found(pt.rebuilt_trie(df, most)) == nodes(rebuilt(sequences(rows)))


@pytest.mark.parametrize("most", [1, 7, 1000])
def test_copies_ties_and_odd_rows(spark, most):
    rnd = random.Random(most)
    rows = []
    for c in range(70):
        n = rnd.randrange(1, 5)
        rows += [(c, rnd.choice([None, 0, 1, 2, 3]), rnd.choice(["user", None, ""]), rnd.choice(["a b", "", None, "c"])) for _ in range(n)]
    rows += [(c, t, "user", "the same") for c in range(200, 240) for t in range(3)]  # copies, more than a container holds
    rows += rows[:5] + [(None, 0, "user", "nobody's")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS part", "'x' AS key", "2 AS depth", "3 AS words", "4 AS position")
    assert found(pt.conversation_trie(df, most)) == nodes(sequences(rows))
    assert found(pt.rebuilt_trie(df, most)) == nodes(rebuilt(sequences(rows)))


def test_one_long_conversation(spark):
    """A conversation that holds nearly all rows is numbered over several tasks and not gathered."""
    rows = [(1, t, "user", f"turn {t % 7}") for t in range(3000)] + [(c, t, "user", f"turn {t}") for c in (0, 2, 3) for t in range(3)]
    assert found(pt.conversation_trie(spark.createDataFrame(rows, SCHEMA), 50)) == nodes(sequences(rows))


def test_empty_table_and_turnless_conversations(spark):
    assert found(pt.rebuilt_trie(spark.createDataFrame([], SCHEMA))) == []
    rows = [(c, 0, "user", "only") for c in range(1, 20)]  # no giver: some lose their only turn
    assert found(pt.rebuilt_trie(spark.createDataFrame(rows, SCHEMA), 4)) == nodes(rebuilt(sequences(rows)))


def test_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS FROM '{sf}/conversations.parquet'")
    columns = ", ".join(pt.NODE.names)
    want = sorted(tuple(-1 if v is None else v for v in r) for r in con.sql(f"SELECT {columns} FROM ({pt.oracle()})").fetchall())
    assert want == found(pt.rebuilt_trie(spark.read.parquet(f"{sf}/conversations.parquet")))

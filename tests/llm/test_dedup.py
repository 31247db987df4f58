"""Exact and near-duplicates against plain Python."""

import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from loadlens.llm.exact_dedup import directory, drop_copies, exact_dedup
from loadlens.llm.minhash import components, drop_near_copies, near_duplicates


def groups(rows):
    by = {}
    for i, t in rows:
        by.setdefault(t or "", []).append(i)
    return by


def expected(rows):
    by = groups(rows)
    most = {t: max(ids, key=lambda i: (i is not None, i)) for t, ids in by.items()}
    return sorted(
        ((i, most[t or ""], len(by[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=str
    )


def narrow(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str)


def test_exact_whole_table(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = exact_dedup(documents)
    assert narrow(got) == expected(rows)
    assert got.filter("kept").count() == len(groups(rows))


def test_exact_odd_rows(docs_of):
    rows = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "a"), (None, None), (4, "A"), (5, "x" * 200_000), (6, "x" * 200_000), (7, " a")]
    df = docs_of(rows)
    got = exact_dedup(df)
    assert narrow(got) == expected(rows)
    assert [r["count"] for r in got.filter("kept").groupBy("text_sha256").count().collect()] == [1] * len(groups(rows))
    kept = drop_copies(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted(
        (max((i for i in ids if i is not None)), t) for t, ids in groups(rows).items()
    )
    assert exact_dedup(df.limit(0)).count() == 0 and drop_copies(df.limit(0)).count() == 0


def test_exact_with_colliding_keys_and_full_buckets(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    few = lambda t: F.shiftleft(F.pmod(F.xxhash64(t), F.lit(40)), 57)
    got = exact_dedup(documents, key=few, capacity=3, max_depth=8)
    assert narrow(got) == expected(rows)
    assert got.agg(F.max("chain")).first()[0] > 0


def test_directory_splits_only_overfull_buckets(spark):
    keys = spark.range(1000).select(F.shiftleft(F.col("id"), 44).alias("key"))  # all in one corner of the range
    table, depth = directory(keys.unionByName(spark.range(1).select((-F.col("id") - 1).alias("key"))), 100)
    sizes = keys.join(table, F.shiftrightunsigned("key", 64 - depth) == F.col("prefix")).groupBy("bucket").count()
    assert depth > 10 and sizes.agg(F.max("count")).first()[0] <= 100
    assert table.agg(F.min("local_depth")).first()[0] == 1  # the half with one key stays whole


def shingles(text, n=4):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def near_expected(rows):
    sets = {k: shingles(t) for k, (_, t) in enumerate(rows)}
    has, above = {}, {k: k for k in sets}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for k, s in sets.items():
        for j, both in Counter(j for x in s for j in has.get(x, ())).items():
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                a, b = top(k), top(j)
                above[max(a, b)] = min(a, b)
        for x in s:
            has.setdefault(x, []).append(k)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return sorted(((i, len(sets[k]), least.get(top(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)), key=str)


def near_got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_near_whole_table(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = near_duplicates(documents)
    assert near_got(got) == near_expected(rows)
    assert got.filter("kept <> (doc_id = component_id)").count() == 0


def test_near_chains_and_odd_rows(docs_of):
    rnd = random.Random(3)
    base = [f"w{rnd.randrange(10_000)}" for _ in range(120)]
    rows = [(None, ""), (1, None), (2, " \n\t"), (3, "one two"), (4, "One  TWO"), (5, "one two three"), (None, "one two")]
    for i in range(40):  # each a small step from the one before, the ends far apart
        base = base[:]
        base[rnd.randrange(120)] = f"n{i}"
        rows.append((100 + i, " ".join(base)))
    rows += [(200, "q " * 30_000), (201, "q " * 10), (100, "something else here entirely")]
    df = docs_of(rows)
    assert near_got(near_duplicates(df)) == near_expected(rows)
    kept = drop_near_copies(df)
    assert kept.columns == df.columns and {200, 5, 1, 2, 3} <= {r.doc_id for r in kept.collect()}
    assert not {4, 201, *range(101, 140)} & {r.doc_id for r in kept.collect()}
    assert near_duplicates(df.limit(0)).count() == 0


def test_near_many_unlike_classes_in_a_bucket(docs_of):
    """Groups that share most words but not enough of them are compared in blocks."""
    rnd = random.Random(5)
    head = [f"h{i}" for i in range(60)]
    rows = [(i, " ".join(head + [f"t{i}_{rnd.randrange(9)}_{k}" for k in range(18)])) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " end") for i in range(0, 60, 7)]
    assert near_got(near_duplicates(docs_of(rows), block=7)) == near_expected(rows)


def test_components(spark):
    edges = [("b", "a"), ("c", "b"), ("d", "c"), ("f", "e"), ("g", "g")]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "x string, y string")).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "a", "e": "e", "f": "e"}

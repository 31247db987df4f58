"""The pipeline's stages on a small table, and the queries that have checking SQL."""

import hashlib

import parity
import pytest
from pyspark.sql import functions as F
from test_dedup import near_expected
from test_text import base

import corpus_pipeline
from loadlens.llm import queries
from loadlens.llm.shared import stored, word_count


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_against_sql(spark, sf, name):
    names, rows = parity.spark_rows(queries.QUERIES[name](spark, sf))
    expected_names, expected = parity.duck_rows(parity.connect(sf), queries.ORACLE[name])
    assert names == expected_names and rows
    assert parity.difference(rows, expected) == ([], [])


def test_stages(spark, sf, documents):
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, sf), "stage")
        seen[name] = (docs, out)
        if name != "bpe":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = out
    pairs = lambda df: {(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()}

    before, after = map(pairs, seen["quality rules"])
    assert after <= before and not any(base(t)[-1] for _, t in after)
    assert len(after) >= 0.9 * sum(not base(t)[-1] for _, t in before)

    before, after = map(pairs, seen["exact dedup"])
    last = {}
    for i, t in before:
        last[t] = max(i, last.get(t, i))
    assert after == {(i, t) for t, i in last.items()}

    before, after = map(pairs, seen["near dedup"])
    kept = {i for i, _, c in near_expected(sorted(before)) if i == c}
    assert after == {(i, t) for i, t in before if i in kept}

    before, after = seen["mixing"]
    words = lambda df: {r.doc_id: r.n for r in df.groupBy("doc_id").agg(F.sum(word_count("text")).alias("n")).collect()}
    size, taken = words(before), words(after)
    assert set(taken) <= set(size) and all(0 < n <= 2 * size[i] for i, n in taken.items())
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) <= 0.03 * sum(size.values())
    assert after.filter("n_chars <> length(text)").count() == 0

    mixed, out = seen["bpe"]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted((r.doc_id, sha(r.text)) for r in mixed.collect()) == sorted((r.doc_id, r.decoded_sha256) for r in out.collect())


def test_run_is_the_stages(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and set(rows[0].asDict()) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}

"""Stops parsed as columns: the same values as parsed in arrays, by the same patterns, without lambdas around them."""

import pytest
from pyspark.sql import functions as F
from test_functions import evaluate, random_texts

from loadlens.functions import text as tx
from loadlens.operators import segment, stops
from loadlens.operators.extract import extract, stop_arrays, stop_rows
from loadlens.plans import fixtures as fx
from loadlens.plans import rulesets as rs

SF = "/root/testdata/sf0.001"
MADE = {"cy_1": fx.confirmations, "cy_2": fx.confirmations, "cy_4": fx.confirmations, "cy_5": fx.confirmations, "utb": fx.utb_documents}


@pytest.mark.parametrize("name", MADE)
def test_columns_equal_arrays(spark, name):
    rules, docs = rs.RULESETS[name], MADE[name](spark, SF)
    arrays = stop_arrays(docs.select("source_file", tx.normalise(F.col("text"), rules.profile).alias("_text")), rules)
    want, rows = {}, set()
    for r in arrays.collect():
        for t in segment.TYPES:
            for k, s in enumerate(r[f"{t}_stops"], 1):
                rows.add((r.source_file, t, k, *[s[f] or "" for f in stops.FIELDS]))
                want |= {(r.source_file, f"{t}_{f}_{k}"): s[f] or "" for f in stops.FIELDS}
    assert len(rows) > 1000
    got = stop_rows(docs, rules, capped=True)
    assert sorted(map(tuple, got.collect())) == sorted(rows)
    slots = [f"{t}_{f}_{k}" for t in segment.TYPES for k in range(1, rules.caps[t] + 1) for f in stops.FIELDS]
    for r in extract(docs, rules).collect():
        assert {c: r[c] for c in slots} == {c: want.get((r.source_file, c), "") for c in slots}


def test_blocks_are_rows_before_they_are_parsed(spark):
    plan = stop_rows(fx.confirmations(spark, SF), rs.CY)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    zone = next(i for i, line in enumerate(plan) if "ddress\\s+(.+?)" in line)
    assert any("Generate inline(" in line for line in plan[zone + 1 :])
    assert "lambda" not in plan[zone]


def test_entry_before_the_groups_is_the_only_difference(spark):
    texts = ["..a1b2 a3b4", "a9xb", "none", ""]
    with_guard = lambda f: evaluate(spark, texts, lambda c: f(c, r"a(\d+)(x)?b(\d*)", 3, guard=r"a\d"))
    assert [a and a[1:] for a in with_guard(tx.captured)] == [a and a[1:] for a in with_guard(tx.captures)]


def test_short_texts_go_without_a_guard(spark):
    short, long = "none", "none" * tx.UNGUARDED
    assert evaluate(spark, [short, long], lambda c: tx.captured(c, r"a(\d)", 1, guard=r"a\d")) == [["none"], None]


@pytest.mark.parametrize(
    "ours, plain",
    [
        (segment.TYPED_BLOCK_END, r"(?:Send Invoice|Special Instructions|Total|Please Sign)"),
        (rs.DATE, rf"(?:{rs.WEEKDAYS})\s+(\d{{2}}/\d{{2}}/\d{{4}})"),
    ],
)
def test_first_letters_as_one_class(spark, ours, plain):
    pieces = ["Send Invoice", "ſend invoice", "special INSTRUCTIONS", "Total", "tOTAL", "please sign", "S", "T", "Mon", "tue", "wED", "Thu", "FRI",
              "ſat", "SUN", "Mue", "Ton", " 02/03/2004", " 2/3/2004", " ", "\n", "é"]
    texts = random_texts(pieces, n=4000, length=6)
    found = lambda p: evaluate(spark, texts, lambda c: F.regexp_extract_all(c, F.lit(tx.rx(p, "is")), F.lit(0)))
    assert found(ours) == found(plain)
    assert sum(map(bool, found(plain))) > 50

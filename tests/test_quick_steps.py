"""Steps that are skipped or begun faster give what the plain patterns give."""

from functools import reduce

import pytest
from pyspark.sql import functions as F
from test_functions import evaluate, random_texts

from loadlens.functions import datetimes as dt
from loadlens.functions import text as tx
from loadlens.operators import segment
from loadlens.plans import rulesets as rs

SPACES = [(r"[ \t ]+", " ", ""), (r"\r\n?", "\n", ""), (r"\n{3,}", "\n\n", "")]
MARKS = [(tx.SEP, "", ""), (r"\*{2,}", "", "")]
PLAIN = {
    "blocks": [*MARKS, *SPACES],
    "lines": [
        *MARKS, (r"PickUp\b", "Pickup", "i"), (r"Del\.\s*Date", "Delivery Date", "i"), (r"Miami Lake,s", "Miami Lakes", "i"), *SPACES,
        (r"(?<=\w)\n(?=[A-Z0-9])", " ", ""), (r"(?=[\s\u001C-\u001E])\s*[\n\u000B\u000C\u001C-\u001E\u0085  ]\s*", "\n", ""),
    ],
    "flat": [(tx.SEP, "", ""), (r"\*", "", ""), (r"\s+", " ", "")],
}
PIECES = [
    "a", "B7", ",", ".", " ", " ", "\n", "\n", "\t", "\r", "*", " ", " ", " ", "\x0b", "\x1c", "\x1f", "\u0085", "é",
    "\U00010400", tx.SEP, "PICKUP", "picKup", "Del. date", "DEL.", "Miami Lake,s", "miami laKe,ſ", "~~x~~",
]


def one_by_one(c, steps):
    return reduce(lambda acc, s: F.regexp_replace(acc, f"(?dU{s[2]})" + s[0], s[1]), steps, c)


@pytest.mark.parametrize("profile", sorted(PLAIN))
def test_normalise_as_by_plain_steps(spark, profile):
    texts = random_texts(PIECES, n=4000, length=14)
    plain = lambda c: tx.strip(one_by_one(c, PLAIN[profile]))
    assert evaluate(spark, texts, lambda c: tx.normalise(c, profile)) == evaluate(spark, texts, plain)


def test_clean_blocks_go_through_no_pattern():
    # every step is behind literals that a clean text lacks
    for step in tx.BLOCK_STEPS:
        literals = step[:1] if len(step) == 2 else step[3]
        assert literals and not any(x in "Load 1\nStop 1: Pick Up\n\nAddress 5 OAK ST, * GA 30005" for x in literals)


def test_first_letter_as_a_class(spark):
    assert tx.quick_start("Load x") == "[L]oad x"
    assert all(tx.quick_start(p) == p for p in ("Kilo", "SLIC", "It", "L?x", "L", r"\bN", "(a)", "l*x"))
    texts = random_texts(["load", "LO", "Lo", "a", "D", " ", "1", "K", "ı"], n=2000, length=6)
    found = lambda p: evaluate(spark, texts, lambda c: F.regexp_extract(c, p, 0))
    assert found(tx.rx(r"Load\s*\d")) == found(r"(?dUi)Load\s*\d")
    assert tx.rx(r"Load\s*\d") != r"(?dUi)Load\s*\d"


def test_word_boundaries_behind_the_first_letter(spark):
    texts = random_texts(["Address", "addreſſ", "N/A", "n/a", " ", "x", "é", "_", "\U00010400", "\n"], n=3000, length=5)
    plain = lambda p: evaluate(spark, texts, lambda c: F.regexp_replace(c, "(?dUi)" + p, "!"))
    ours = lambda p: evaluate(spark, texts, lambda c: F.regexp_replace(c, tx.rx(p), "!"))
    assert ours(segment.ADDRESS_WORD) == plain(r"\bAddress\b")
    assert ours(rs.OPERATIONAL[0][0]) == plain(r"\bN/A\b")
    assert not any(p.startswith(r"\b") for p in (segment.ADDRESS_WORD, rs.OPERATIONAL[0][0]))


def test_several_replacements_are_looked_for_once(spark):
    steps = [(r"\bN/A\b", "", "i"), (r"Driver\s+Work", " ", "i"), (r"~~\S+~~", "", ""), (r"\s+[a-z].*", "", "")]
    texts = random_texts(["N/A", "n/a ", "driver", " Work", "~~x~~", "A", " ", "b", "é", "\n"], n=3000, length=7)
    assert evaluate(spark, texts, lambda c: tx.replace_all(c, steps)) == evaluate(spark, texts, lambda c: one_by_one(c, steps))
    assert "RLIKE" in plan_of(spark, lambda c: tx.replace_all(c, steps)).upper()


def plan_of(spark, column):
    df = spark.range(1).select(F.col("id").cast("string").alias("v")).select(column(F.col("v")).alias("x"))
    return df._jdf.queryExecution().analyzed().toString()


def test_a_date_is_split_once(spark):
    assert plan_of(spark, lambda c: dt.iso_date(c, dt.DAY_FIRST_TOO)).count("split(") == 1


def test_captures_search_once(spark):
    # the only pattern is the one that is looked for; the rest are literals
    assert plan_of(spark, lambda c: tx.captures(c, r"a(\d)", 1)).count("regexp_replace(") == 1

"""Scalar functions against hand-traced values and against Python's re on random text."""

import random
import re

import pytest
from pyspark.sql import functions as F

from loadlens.functions import datetimes as dt
from loadlens.functions import text as tx
from loadlens.operators import stops


def evaluate(spark, values, column):
    """column('v') for each string, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select("i", column(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def random_texts(alphabet, n=3000, length=24, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, length))) for _ in range(n)]


@pytest.mark.parametrize(
    "given, expected",
    [
        (None, ""),
        ("", ""),
        (" \t\n ", ""),
        ("**Load** 1", "Load 1"),
        ("a*b", "a*b"),
        ("a \t\u00a0 b", "a b"),
        ("a\r\nb\rc", "a\nb\nc"),
        ("a\n\n\n\n\nb", "a\n\nb"),
        ("\u2003a\x1f", "a"),
    ],
)
def test_normalise_blocks(spark, given, expected):
    assert evaluate(spark, [given], tx.normalise) == [expected]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("PickUp # 1", "Pickup # 1"),
        ("PickUps", "PickUps"),
        ("Del.  Date: 1", "Delivery Date: 1"),
        ("MIAMI LAKE,S, FL", "Miami Lakes, FL"),
        ("ABC\nDEF\nghi", "ABC DEF\nghi"),
        ("a\nB\nC\n1", "a B C 1"),
        ("x.\n\n  \n y ", "x.\ny"),
        ("x.\x0bz\u2028 w", "x.\nz\nw"),
    ],
)
def test_normalise_lines(spark, given, expected):
    assert evaluate(spark, [given], lambda c: tx.normalise(c, "lines")) == [expected]


def test_normalise_flat(spark):
    assert evaluate(spark, [" *a*\n\t b\u00a0c "], lambda c: tx.normalise(c, "flat")) == ["a b c"]


def test_emails_equal_a_plain_search(spark):
    texts = random_texts("ab.@-_ é", length=30) + ["a@b.c-d@e.f", "..@x.y", "a@b", "a@b.c.", "é.x@y.zé"]
    plain = re.compile(r"[\w\.\-]+@[\w\.\-]+\.\w+")
    assert evaluate(spark, texts, tx.emails) == [plain.findall(t) for t in texts]


def test_emails_joined_and_first_outside(spark):
    text = "z@b.io Y@a.io z@b.io x@sub.Coyote.com"
    assert evaluate(spark, [text], tx.emails_joined) == ["Y@a.io; x@sub.Coyote.com; z@b.io"]
    assert evaluate(spark, [text], lambda c: tx.emails_joined(c, fold=True)) == ["y@a.io; x@sub.coyote.com; z@b.io"]
    outside = lambda c: tx.first_email_outside(c, "coyote.com")
    assert evaluate(spark, ["x@Coyote.com a@b.io", "x@coyote.com", "none"], outside) == ["a@b.io", "", ""]


def test_city_words_equal_a_plain_search(spark):
    texts = [t.strip() for t in random_texts("AbC1. -", length=18)]
    plain = re.compile(r"((?:[A-Z]\S+)(?:\s+(?:[A-Z]\S+))*)$")
    found = [m.group(1) if (m := plain.search(t)) else "" for t in texts]
    reverse = lambda c: F.reverse(F.regexp_extract(F.reverse(c), tx.rx(stops.CITY_WORDS_REVERSED, ""), 1))
    assert evaluate(spark, texts, reverse) == found


def test_state_then_zip_equals_a_plain_search(spark):
    rng = random.Random(3)
    bits = ["Big", " ", "Town", "-", ".", ",", ", ", "GA", "tx", "12345", "12345-6789", "7", "x"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    plain = re.compile(r"([A-Za-z][A-Za-z\s\-\.]+?),\s*([A-Z]{2})\b.*?(\d{5}(?:-\d{4})?)", re.I)
    found = [list(m.groups()) if (m := plain.search(t)) else None for t in texts]
    assert any(found) and not all(found)
    caps = lambda c: F.when(F.size(tx.captures(c, stops.STATE_THEN_ZIP, 3)) > 1, F.slice(tx.captures(c, stops.STATE_THEN_ZIP, 3), 2, 3))
    assert evaluate(spark, texts, caps) == found


def test_captures(spark):
    pattern = r"a(\d+)(x)?b(\d*)"
    caps = lambda c: tx.captures(c, pattern, 3)
    assert evaluate(spark, ["..a1b2 a3b4", "a9xb", "none"], caps) == [["", "1", "", "2"], ["", "9", "x", ""], ["none"]]


@pytest.mark.parametrize(
    "date, time, expected",
    [
        ("03/29/2023", "08:00", "2023-03-29T08:00:00"),
        ("13/05/2023", "08:00", "2023-05-13T08:00:00"),
        ("05/06/2023", "08:00", "2023-05-06T08:00:00"),
        ("3/9/2023", "8:05", "2023-03-09T08:05:00"),
        ("3/9/2023", "8:5", "2023-03-09T08:05:00"),
        ("02/30/2023", "08:00", ""),
        ("03/29/2023", "24:00", ""),
        ("03/29/2023", "13:00 PM", ""),
        ("03/29/2023", "1:00 pm", "2023-03-29T13:00:00"),
        ("03/29/2023", "12:15 AM", "2023-03-29T00:15:00"),
        ("03/29/2023", "08:00:59", "2023-03-29T08:00:59"),
        ("03/29/2023", "08:00:60", ""),
        ("03/29/2023", "from 08:00 - 13:00", "2023-03-29T08:00:00"),
        ("03/29/2023", "At 09:30", "2023-03-29T09:30:00"),
        ("03/12/2023", "02:30", "2023-03-12T02:30:00"),
        ("03/29/23", "08:00", ""),
        ("01/01/0000", "08:00", ""),
        ("", "08:00", ""),
        (None, "08:00", ""),
        ("03/29/2023", None, ""),
    ],
)
def test_combine(spark, date, time, expected):
    df = spark.createDataFrame([(date, time)], "d string, t string")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert df.select(dt.combine(F.col("d"), F.col("t"))).first()[0] == expected
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "date, time, us, strict",
    [
        ("11/19/2021", "08:00", "2021-11-19T08:00:00", ""),
        ("19/11/2021", "08:00", "", ""),
        ("11/19/2021", "8:00:01 PM", "2021-11-19T20:00:01", "2021-11-19T08:00:01"),
        ("11/19/2021", "08:00:00", "2021-11-19T08:00:00", "2021-11-19T08:00:00"),
        ("on 1/2/2021.", "from 9:08:07", "", "2021-01-02T09:08:07"),
    ],
)
def test_other_combinations(spark, date, time, us, strict):
    df = spark.createDataFrame([(date, time)], "d string, t string")
    d, t = F.col("d"), F.col("t")
    assert tuple(df.select(dt.combine_us(d, t), dt.combine_strict(d, t)).first()) == (us, strict)


def test_processed_at(spark):
    rows = spark.range(3).select(dt.processed_at().alias("u"), dt.processed_at(local=True).alias("l")).distinct().collect()
    assert len(rows) == 1
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d", rows[0].u)
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}", rows[0].l)


@pytest.mark.parametrize(
    "path, expected",
    [
        ("/in/a/b.PDF", "/out/a/b.txt"),
        ("/in/a.b/c", "/out/a.b/c.txt"),
        ("/in/.pdf", "/out/.pdf.txt"),
        ("/in/x..pdf", "/out/x..txt"),
        ("/in/x.tar.pdf", "/out/x.tar.txt"),
    ],
)
def test_output_path(spark, path, expected):
    assert evaluate(spark, [path], lambda c: tx.output_path(c, "/in/", "/out")) == [expected]


def test_canonical_paths(spark):
    path = "dbfs:/v/raw/cy/txt_pymupdf4llm/1%20a+b.txt"
    canon = lambda name: evaluate(spark, [path], lambda c: tx.canonical_path(c, tx.PATH_STEPS[name]))[0]
    assert canon("current") == "/v/raw/cy/pdf/1 a+b.pdf"
    assert canon("any_folder") == "/v/raw/cy/pdf/1 a+b.pdf"
    assert canon("raw") == path
    assert evaluate(spark, [" a.txt/b.txt ", None], tx.comparable_path) == ["a.pdf/b.pdf", ""]


def test_captures_search_without_a_lazy_gap(spark):
    """The first match, wherever it stands, line ends before and behind it included; found by a plain search."""
    rng = random.Random(11)
    texts = ["".join(rng.choice(["a", "A", "1", "22", "x", "b", "\n", " ", "é"]) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    plain = re.compile(r"a(\d+)(x)?b?", re.I)
    found = [["", m[1], m[2] or ""] if (m := plain.search(t)) else [t] for t in texts]
    assert any(len(f) > 1 for f in found) and any(len(f) == 1 for f in found)
    caps = lambda c: tx.captures(c, plain.pattern, 2)
    assert evaluate(spark, texts, caps) == found
    plan = spark.range(1).select(caps(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString()
    assert ".*?" not in plan


def test_lines_are_joined_as_by_a_plain_pattern(spark):
    texts = random_texts(["a", "é", "\U00010400", "\n", "B", "7", " ", ".", "\u2028", "\x1c"], n=2000, length=10)
    plain = lambda c: tx.replace_all(c, [(r"(?<=\w)\n(?=[A-Z0-9])", " ", "")])
    (step,) = [s for s in tx.LINE_STEPS if s[0].endswith("(?=[A-Z0-9])")]
    assert evaluate(spark, texts, lambda c: tx.replace_all(c, [step[:3]])) == evaluate(spark, texts, plain)
    # the look back is tried at line ends only
    assert step[0].startswith(r"(?=\n)")


def test_single_spaces_are_left_alone(spark):
    texts = random_texts(["a", " ", "\t", "\u00a0", "\n"], n=2000, length=12)
    step = tx.SPACES[0]
    assert evaluate(spark, texts, lambda c: tx.replace_all(c, [step[:3]])) == [re.sub("[ \t\u00a0]+", " ", t) for t in texts]
    assert not re.search(step[0].replace("*+", "*").replace("++", "+"), "a b")


def test_filled(spark):
    values = ["", *tx.WHITE_SPACE, tx.WHITE_SPACE, "\u200b", "x", " x", "\u2003\n\u00e9\n", "\U0001f600", None]
    assert evaluate(spark, values, tx.filled) == [bool((v or "").strip(tx.WHITE_SPACE)) for v in values]

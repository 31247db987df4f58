"""Surrogates come to an end for values whose form leaves no or few others."""

import itertools

import pytest
from pyspark.sql import functions as F

from loadlens.llm import pii


def found(text):
    return {(kind, text[a:b]) for a, b, kind, _ in pii.mentions(text)}


@pytest.mark.parametrize("text", ["password=******", "Mr Ձակոբ", "Frau Öä", "Mr Ёё", "+++@--.com is mine", "secret=\u00b6\u00b6\u00b6\u00b6\u00b6\u00b6\u00b6", "Mr Ǆǆ"])
def test_every_value_gets_another_one(spark, text):
    assert list(pii.mentions(text))
    rows = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    out = {r.text for r in pii.replace_pii(rows, key=b"k").collect()}
    assert len(out) == 1 and text not in out


def test_a_used_up_space_is_left(spark):
    """All 676 names of two letters of one kind are real, so no surrogate can be one of them."""
    values = ["".join(p) for p in itertools.product("АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ".lower(), repeat=2)]
    entities = spark.createDataFrame([("surname", v) for v in values], "kind string, value string")
    new = pii.surrogates(entities, b"k").collect()
    assert len(new) == len(values) == len({r.surrogate for r in new})
    assert not {r.surrogate for r in new} & set(values)
    short = spark.range(900).select(F.lit("phone").alias("kind"), F.format_string("+1%03d", "id").alias("value"))
    new = pii.surrogates(short, b"k").collect()
    assert len({r.surrogate for r in new}) == 900 and not {r.surrogate for r in new} & {f"+1{i:03d}" for i in range(900)}


def test_longer_surrogates_are_written_whole():
    for kind, mention, value in (("phone", "+1 22-33", "+12233"), ("ssn", "123-45-6789", "123456789"), ("ip", "1.2.3.4", "1.2.3.4"), ("card", "4111 1111 1111 1111", "4111111111111111")):
        new = {pii.surrogate(b"k", kind, value, attempt) for attempt in range(12)}
        assert len(new) == 12 and len({pii.written(mention, kind, n) for n in new}) == 12
    assert all(pii.luhn(pii.surrogate(b"k", "card", "4111111111111111", a)) for a in range(12))


def test_telephone_forms():
    assert ("phone", "+91 98765 43210") in found("call +91 98765 43210 now")
    assert ("phone", "555-123-4567") in found("call 555-123-4567 now")
    assert found("order 1555-123-4567-9") == set()

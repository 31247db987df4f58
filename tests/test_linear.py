"""Patterns that read a long document once: the same values as the plain patterns, and no text that stalls them."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from loadlens.functions import text as tx
from loadlens.operators.extract import extract
from loadlens.plans import rulesets as rs

# the plain patterns, as the documents state them
PLAIN = {
    "broker_address": r"USA\s+Truck\s+Brokers\s+Inc\.\s+(.*?)\s+(.*?),\s+([A-Z]{2})\s+(\d{5})",
    "carrier_name": r"Carrier\s+([A-Z0-9\s]+?)\s+MC\s*#",
    "carrier_address": r"Address\s+(.*?)\s+City\s+(.*?),\s+([A-Z]{2})\s+(\d{5})",
    "carrier_contact": r"Contact\s+(.*?)\s+(?:Service|Notes|Payment)",
}
INVOICE = r"(\d{1,6}\s+[A-Za-z0-9#.,\s]+?)\s*(?:\n|,)?\s*([A-Za-z\s]+),\s*([A-Z]{2})\s*(\d{5})"


def of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").repartition(8)


def plain(pattern, text, n):
    m = re.search(pattern, text, re.I)
    return [g.strip() for g in m.groups()] if m else [""] * n


def test_flat_fields_equal_the_plain_patterns(spark):
    rnd = random.Random(3)
    words = ["USA Truck Brokers Inc.", "Inc.", "Carrier", "carrier", "MC #", "MC", "#", "Address", "City", "Contact", "Service", "Notes",
             ", TX 78215", ", tx 7821", ",", "a", "B7", "12", "x,", "Payments", "XAddress", "Cityx", ".", "MC#5"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 16))) for _ in range(8000)]
    by_field = {}
    for rule in rs.UTB_FLAT_HEADER:
        by_field[rule.fields[0] if hasattr(rule, "fields") else rule.field] = rule
    read = []
    for name in PLAIN:
        rule, n = by_field[name], re.compile(PLAIN[name]).groups
        caps = rule.captures(F.col("text")) if n > 1 else None
        read.append((F.array(*[tx.group(caps, g) for g in range(1, n + 1)]) if n > 1 else F.array(rule.column(F.col("text"), F.col("text")))).alias(name))
    found = 0
    for r in of(spark, texts).select("text", *read).collect():
        for name, pattern in PLAIN.items():
            want = plain(pattern, r.text, re.compile(pattern).groups)
            assert r[name] == want, (name, r.text)
            found += want[0] != ""
    assert found > 1000  # many of them match


def test_invoice_address_equals_the_plain_pattern(spark):
    rnd = random.Random(4)
    words = ["12", "7", "1234567", " ", " ", "  ", "\n", "\n\n", ",", ", ", "Main", "St.", "#4", "Miami Lakes", "FL", "33016", ", FL 33016", ", FL 33016", ",fl33016", "12 ", ":", "-", "é", "A", "."]
    texts = ["".join(rnd.choice(words) for _ in range(rnd.randrange(2, 14))) for _ in range(20000)]
    read = tx.invoice_address(F.col("text"))
    rows = of(spark, texts).select("text", F.array(*[F.coalesce(F.get(read, F.lit(g)), F.lit("")) for g in range(1, 5)]).alias("got")).collect()
    tidy = lambda values: [" ".join(v.split()) for v in values]
    for r in rows:
        m = re.search(INVOICE, r.text, re.I)
        assert tidy(r.got) == tidy(m.groups() if m else [""] * 4), r.text
    assert sum(r.got[0] != "" for r in rows) > 1000


HOSTILE = {
    "utb_flat": [
        "Address a City b, c ", "USA Truck Brokers Inc. a b, c ", "Contact a b ", "Carrier A ", "Carrier Carrier MC ", "Tel: 123 Fax: 4-5 ", "Phone 12-34 x ",
        "Total To Pay: $ ", "Trip #: ", "a@b ", "PickUp # 1 Customer: A ", "Delivery # 1 Customer: A Delivery Date: 1 Address # 1: ", "MC # ",
    ],
    "utb": [
        "Send Invoice to: 12 Main St. Miami, F ", "Send Invoice to: 1 a, b, ", "Trailer VIN Number Carrier A MC # 1 Address: 1 City: A, ", "Pickup # 1 Customer: A ",
        "Delivery # 1 Address #1: 1 A ", "Pickup a ", "Tel: 305-555 ", "Total Carrier Pay: ", "Zip Code: 12 Time: 1 - ",
    ],
    "cy_5": ["Stop 1: Pick Up\nFacility A Address 1 OAK RD ", "## Booked By\nAgent a@coyote.com ", "Load x USD $ ", "Carrier Legal Name - ", "Stop 1: Delivery\nAddress a b, GA "],
}


@pytest.mark.parametrize("name", HOSTILE)
def test_documents_of_repeated_labels_end(spark, name):
    """150 KB each that never completes a match."""
    start = time.monotonic()
    texts = [unit * (150_000 // len(unit)) for unit in HOSTILE[name]]
    assert extract(of(spark, texts).withColumnRenamed("i", "source_file"), rs.RULESETS[name]).agg(F.count_distinct(F.struct("*"))).first()[0] == len(texts)
    assert time.monotonic() - start < 90

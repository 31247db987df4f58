"""Stops, places, facilities and whole documents on hand-written text."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from loadlens.functions import text as tx
from loadlens.operators import segment
from loadlens.operators.extract import extract, extract_each, extract_routed, stop_rows, stops_beyond_slots
from loadlens.plans import rulesets as rs

LINE = segment.Splitter("line")


def docs(spark, *texts):
    return spark.createDataFrame([(f"/{i}.txt", t) for i, t in enumerate(texts)], "source_file string, text string")


def blocks(spark, text, splitter=LINE):
    rows = segment.stops_long(docs(spark, text), "text", splitter).orderBy("pos").collect()
    return [(r.type, r.number, r.text) for r in rows]


def test_split_at_line_starts(spark):
    text = "Load 1\n## Stop 1: Pick Up a\nb\n##\nStop 2 : delivery c\n### stop 3:PickUp"
    assert blocks(spark, text) == [
        ("pickup", 1, "Stop 1: Pick Up\n a\nb\n"),
        ("delivery", 2, "stop 2 : delivery\n c\n".replace("stop", "Stop")),
        ("pickup", 3, "stop 3:PickUp\n"),
    ]


@pytest.mark.parametrize("text", ["", " Stop 1: Delivery", "x Stop 1: Delivery", "#### Stop 1: Delivery", "Stop one: Delivery"])
def test_no_stop(spark, text):
    assert blocks(spark, text) == []


def test_first_stop_at_the_very_start(spark):
    assert [b[:2] for b in blocks(spark, "Stop 7: Delivery\nAddress")] == [("delivery", 7)]


def test_blocks_without_address_use_no_slot(spark):
    text = "Stop 1: Delivery\nx\nStop 2: Delivery\nADDRESS y\nStop 3: Delivery\nAddressee z"
    assert [b[1] for b in blocks(spark, text, rs.CY.splitter)] == [2]


def test_anywhere_splitter_closes_the_last_block(spark):
    text = "x Stop 1: Pick Up a Contact None b Stop 2: Delivery c Charges d Stop"
    assert blocks(spark, text, rs.CY_1.splitter) == [
        ("pickup", 1, "Stop 1: Pick Up a Contact None b"),
        ("delivery", 2, "Stop 2: Delivery c"),
    ]


def test_typed_blocks(spark):
    text = "Pickup # 1 a Delivery # 1 b Pickup#2 c Total d Delivery # 2 e"
    got = docs(spark, text).select(
        segment.typed_blocks(F.col("text"), "pickup"), segment.typed_blocks(F.col("text"), "delivery")
    ).first()
    # a block runs to the next marker of its own type
    assert got[0] == ["a Delivery # 1 b", "c"]
    assert got[1] == ["b Pickup#2 c", "e"]
    plain = docs(spark, "Pickup a Delivery b Pickup c Send Invoice").select(segment.typed_blocks(F.col("text"), "pickup"))
    assert plain.first()[0] == ["a", "c"]


PLACES = [
    ("450 SAMPLE DRIVE GATE D Milltown, FL 33440", "450 SAMPLE DRIVE GATE D", "Milltown", "FL", "33440"),
    ("220 TESTWOOD CT SUITE 230 McExample, GA 30253", "220 TESTWOOD CT SUITE 230", "McExample", "GA", "30253"),
    ("5000 EXAMPLE DR Building A Building A Fairtown, GA 30213", "5000 EXAMPLE DR BUILDING A BUILDING A", "Fairtown", "GA", "30213"),
    ("6123 Tester Road Sampleton, FL 34238", "6123 TESTER ROAD", "Sampleton", "FL", "34238"),
    ("885 SOME HILLS RD Test Springs, GA 30122-3626", "885 SOME HILLS RD", "Test Springs", "GA", "30122-3626"),
    ("12 MAIN ST 5 AVE North Bend, wa 98045", "12 MAIN ST 5 AVE", "North Bend", "WA", "98045"),
    ("1 A St. Louis, MO 63101", "1 A ST.", "Louis", "MO", "63101"),
    ("10 OAK RD Big Town, GA see 30122", "10", "Town", "GA", "30122"),
    ("10 OAK RD big town, GA 30122", "10 OAK RD", "big town", "GA", "30122"),
    ("10 OAK RD A Town, GA 30122 XFR43N", "10 OAK RD A", "Town", "GA", "30122"),
    ("10 OAK Driver SLIC Work Town, GA N/A 30122 ~~e~~", "10 OAK", "Town", "GA", "30122"),
    ("10, OAK LN, Town, GA 30122", "10, OAK LN,", "Town", "GA", "30122"),
    ("no place here", "", "", "", ""),
]


def test_places(spark):
    texts = [f"Stop 1: Pick Up\nAddress {zone} \nContact None" for zone, *_ in PLACES]
    rows = stop_rows(docs(spark, *texts), rs.CY).collect()
    got = {r.source_file: (r.address, r.city, r.state, r.zipcode) for r in rows}
    assert [got[f"/{i}.txt"] for i in range(len(PLACES))] == [tuple(p[1:]) for p in PLACES]


def test_zone_needs_white_space_before_its_end(spark):
    rows = stop_rows(docs(spark, "Stop 1: Pick Up\nAddress 1 OAK RD Town, GA 30122"), rs.CY).collect()
    assert [(r.state, r.rk) for r in rows] == [("", 1)]


@pytest.mark.parametrize(
    "line, expected",
    [
        ("Facility United Sugars Driver Work No Touch Address", "United Sugars"),
        ("Facility DSC-JM Smucker / Big Driver Work Heart Pet DC No Touch Address", "DSC-JM Smucker / Big Heart Pet DC"),
        ("Facility Notes dock Facility Mill One Address", "Mill One"),
        ("Facility Notes dock Address", ""),
        ("Facility Bank of X Address", "Bank"),
        ("Facility - Mill ~~e~~ Two | Address", "Mill Two"),
        ("Facility Mill > Confirmation Address", "Mill"),
        ("Facility Mill Lumper fee Address", "Mill"),
        ("Address", ""),
    ],
)
def test_facility(spark, line, expected):
    assert stop_rows(docs(spark, f"Stop 1: Delivery\n{line} x"), rs.CY).first().customer == expected


def test_times(spark):
    body = "Stop 1: Delivery\nAddress x\nWed 03/29/2023 {}"
    texts = [body.format(t) for t in ("at 9:30 from 08:00 - 13:00", "flat 9:30", "noon")]
    rows = stop_rows(docs(spark, *texts), rs.CY).orderBy("source_file").collect()
    assert [(r.start_datetime[-8:], r.end_datetime[-8:]) for r in rows] == [
        ("08:00:00", "13:00:00"),
        ("09:30:00", "09:30:00"),
        ("", ""),
    ]


def test_documents_without_text_or_stops(spark):
    rows = extract(docs(spark, None, "", " \n", "Load 5"), rs.CY).orderBy("source_file").collect()
    assert [set(r[1:]) for r in rows[:3]] == [{""}] * 3
    last = rows[3].asDict()
    assert last["loadConfirmationNumber"] == "5" and last["broker_phone"] == "877-626-9683"
    assert last["pickup_city_1"] == "" and None not in last.values()


def test_wide_columns(spark):
    assert len(extract(docs(spark, ""), rs.CY).columns) == 41
    assert len(extract(docs(spark, ""), rs.CY_3).columns) == 62
    assert len(extract(docs(spark, ""), rs.UTB).columns) == 63
    assert extract(docs(spark, ""), rs.UTB_FLAT).columns[-1] == "processed_at"


def test_routing_by_source(spark):
    df = docs(spark, "Load 5", "Trip #: T-6").withColumn("source", F.when(F.col("text") == "Load 5", "CY").otherwise("UTB"))
    rows = extract_routed(df, {"CY": rs.CY, "UTB": rs.UTB}).collect()
    assert {(r.source, r.loadConfirmationNumber, r.carrier_contact) for r in rows} == {("CY", "5", ""), ("UTB", "T-6", "")}
    odd = df.withColumn("source", F.when(F.col("source") == "CY", "cy")).select("source", "source_file", "text")
    rows = extract_routed(odd, {"CY": rs.CY, "UTB": rs.UTB}).collect()
    assert {(r.source, r.routed, r.loadConfirmationNumber) for r in rows} == {("cy", False, ""), (None, False, "")}


def test_routing_reads_its_input_once(spark, tmp_path):
    texts = ["Load 5\nStop 1: Pick Up\nAddress 1 OAK RD Town, GA 30122 \nContact None", "Trip #: T-6", "Trip #: 77 Contact Ann Service", None, ""]
    df = docs(spark, *texts).withColumn("source", F.expr("CASE source_file WHEN '/0.txt' THEN 'CY' WHEN '/1.txt' THEN 'UTB' WHEN '/2.txt' THEN 'FLAT' WHEN '/3.txt' THEN 'CY' END"))
    df.write.parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    rulesets = {"CY": rs.CY, "UTB": rs.UTB, "FLAT": rs.UTB_FLAT}
    routed = extract_routed(stored, rulesets)
    assert routed._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    rows = {r.source_file: r.asDict() for r in routed.collect()}
    for name, rules in rulesets.items():
        alone = extract(stored.filter(F.col("source") == name), rules).drop("processed_at")
        for r in alone.collect():
            assert {f: rows[r.source_file][f] for f in alone.columns} == r.asDict()
    assert not rows["/4.txt"]["routed"] and rows["/4.txt"]["processed_at"] is None and rows["/1.txt"]["processed_at"]
    assert rows["/2.txt"]["loadConfirmationNumber"] == "77" and rows["/2.txt"]["pickup_zipcode_3"] == ""


def test_all_stops_and_those_without_a_slot(spark):
    text = "\n".join(f"Stop {i}: Delivery\nAddress {i} OAK RD Town, GA 3012{i} \nContact None" for i in range(1, 6))
    df = docs(spark, text)
    assert [r.zipcode for r in stop_rows(df, rs.CY).orderBy("rk").collect()] == [f"3012{i}" for i in range(1, 6)]
    assert [r.rk for r in stop_rows(df, rs.CY, capped=True).orderBy("rk").collect()] == [1, 2]
    assert {(r.type, r.stops, r.slots, r.beyond) for r in stops_beyond_slots(df, rs.CY).collect()} == {("pickup", 0, 1, 0), ("delivery", 5, 2, 3)}


FLAT_STOP = "Delivery # {n} Customer: SHOP {n} Delivery Date: 01/0{n}/2023 Address # 1: {n} ROAD Delivery Time: 08:00:00 - 09:00:00 City: Town, GA US Zip Code: 3012{n} "


def test_all_numbered_stops(spark):
    """Five deliveries, out of order and one twice, give five rows, each with its own number."""
    text = "".join(FLAT_STOP.format(n=n) for n in (2, 1, 7, 9, 7, 4)) + "PickUp # 3 Customer: no more"
    df = docs(spark, text, None, "Delivery # 1 and no customer")
    rows = stop_rows(df, rs.UTB_FLAT).filter("type = 'delivery'").collect()
    assert sorted((r.rk, r.customer, r.zipcode, r.start_datetime[:10]) for r in rows) == [
        (n, f"SHOP {n}", f"3012{n}", f"2023-01-0{n}") for n in (1, 2, 4, 7, 9)
    ]
    # a stop whose text breaks off has its row and nothing in it
    assert [(r.rk, r.customer) for r in stop_rows(df, rs.UTB_FLAT).filter("type = 'pickup'").collect()] == [(3, "")]
    counted = stops_beyond_slots(df, rs.UTB_FLAT).filter("source_file = '/0.txt'").collect()
    assert {(r.type, r.stops, r.slots, r.beyond) for r in counted} == {("pickup", 1, 1, 1), ("delivery", 5, 2, 3)}
    slots = stop_rows(df, rs.UTB_FLAT, capped=True).filter("source_file = '/0.txt'").collect()
    assert {(r.type, r.rk, r.customer) for r in slots} == {("pickup", 1, ""), ("delivery", 1, "SHOP 1"), ("delivery", 2, "SHOP 2")}


BLOCK = "Trailer VIN Number x Carrier HAUL {n} MC # {n} Address: 1 ROAD City: Town, GA 30122 Phone: 5 Fax: 6 "
FLAT_BLOCK = "PickUp # 1 Customer: A PickUp Date: 01/02/2023 Address # 1: 1 ROAD PickUp Time: 08:00:00 - 09:00:00 City: Town, GA x "


def test_repeated_blocks_without_the_last_label_end(spark):
    """A document of 100 KB that never matches is given up in one pass."""
    start = time.monotonic()
    long = docs(spark, "".join(BLOCK.format(n=i) for i in range(1000)))
    assert extract(long, rs.UTB).first().carrier_mc == ""
    flat = docs(spark, FLAT_BLOCK * 1000)
    assert extract(flat, rs.UTB_FLAT).first().pickup_zipcode_1 == ""
    assert time.monotonic() - start < 60


def test_guards_hold_for_every_match(spark):
    """Random texts of the labels: with and without guard, the same groups."""
    rnd = random.Random(4)
    rule = next(r for r in rs.UTB_HEADER if getattr(r, "guard", None))
    parts = re.split(r"(?=Trailer|Carrier|MC|Address|City|Phone|Fax|Contact)", BLOCK.format(n=7) + "Contact: Ann Total")
    pattern, guard = rs.UTB_FLAT.stop.pattern, rs.UTB_FLAT.stop.guard
    fill = lambda p: p.replace("{label}", "PickUp").replace("{number}", "1")
    flat = re.split(r"(?=PickUp|Address|City|Zip)", FLAT_BLOCK + "Zip Code: 30122 ")
    texts = []
    for words in (parts, flat):
        for _ in range(200):
            new = [w for w in words if rnd.random() > 0.05]
            for _ in range(rnd.randrange(3)):
                new.insert(rnd.randrange(len(new) + 1), rnd.choice(words))
            texts.append("".join(new))
    table = lambda g: tx.captures(F.col("text"), rule.pattern, len(rule.fields), rule.flags, g)
    stop = lambda g: tx.captures(F.col("text"), fill(pattern), 8, guard=g)
    read = lambda c, n: F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.coalesce(F.get(c, i), F.lit("")))
    got = docs(spark, *texts).select(
        read(table(None), 9).alias("a"), read(table(rule.guard), 9).alias("b"),
        read(stop(None), 8).alias("c"), read(stop(fill(guard)), 8).alias("d"),
    ).collect()
    assert all(r.a == r.b and r.c == r.d for r in got)
    assert sum(r.a[0] != "" for r in got) > 20 and sum(r.c[0] != "" for r in got) > 20


def test_generations_in_one_pass_equal_single_runs(spark):
    df = docs(spark, "Load 5\nStop 1: Pick Up\nFacility A Address 1 OAK RD SLIC Big Town, GA 30122 \nContact None", "", None)
    generations = [rs.CY_1, rs.CY_2, rs.CY_3, rs.CY_4, rs.CY_5]
    each = extract_each(df, generations)
    for r in generations:
        alone = extract(df, r).drop("processed_at")
        together = each.filter(F.col("ruleset") == r.name).select(*alone.columns)
        assert sorted(map(tuple, alone.collect())) == sorted(map(tuple, together.collect()))
    cities = {r.ruleset: r.pickup_city_1 for r in each.filter("loadConfirmationNumber = '5'").collect()}
    assert cities == {"cy_1": "Big Town", "cy_2": "OAK RD Town", "cy_3": "RD Town", "cy_4": "Town", "cy_5": "Big Town"}


def test_generations_share_blocks_that_each_keeps(spark):
    """Stops without an address, beyond the slots, or missing: every generation still reads its own."""
    block = "Stop {n}: {t}\nFacility {f} Address {n} OAK RD SLIC Big Town, GA 3012{n} Contact None\nMon 01/0{n}/2024 from 08:00 - 09:30\n"
    bare = "Stop {n}: {t}\nFacility {f} Contact None\nTue 01/0{n}/2024 at 10:15\n"
    rnd = random.Random(8)
    facilities = ["ACME Notes Numbers 5", "Notes here Facility BIG ONE", "X ~~A~~ No Touch", "PLANT 9 Lumper x"]
    texts = ["Load 5\n", "Stop 1: Delivery\n"]
    for _ in range(30):
        stops = [
            rnd.choice((block, block, bare)).format(n=n, t=rnd.choice(("Pick Up", "Delivery")), f=rnd.choice(facilities))
            for n in range(1, rnd.randrange(2, 9))
        ]
        texts.append("Load 5\n" + "".join(stops) + "Total USD $ 1,200.00")
    df = docs(spark, *texts)
    generations = [rs.CY_2, rs.CY_3, rs.CY_4, rs.CY_5]
    each = extract_each(df, generations).collect()
    differ = set()
    for r in generations:
        alone = extract(df, r)
        rows = sorted(tuple(row) for row in alone.collect())
        assert rows == sorted(tuple(row[c] for c in alone.columns) for row in each if row.ruleset == r.name)
        differ.add(str([row[alone.columns.index("pickup_customer_1")] for row in rows]))
    assert len(differ) > 2


def test_no_python_and_no_shuffle_in_the_plan(spark, tmp_path):
    docs(spark, "Load 5").write.parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    for r in rs.RULESETS.values():
        plan = extract(stored, r)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Exchange" not in plan

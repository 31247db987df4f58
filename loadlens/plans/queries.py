"""One query per operator. Each reads whole tables of sf_dir and returns a DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import datetimes as dt
from ..functions import text as tx
from ..operators import pages, segment
from ..operators import validate as v
from ..operators.extract import Rule, extract, extract_routed, header, stop_rows
from ..operators.extract import stops_beyond_slots as beyond_slots
from ..operators.stops import FIELDS
from ..sources.tables import keep_old_columns
from . import fixtures as fx
from . import rulesets as rs
from .pipeline import compare_rulesets

ALL_STOPS = segment.Splitter("line")


def _normalised(docs: DataFrame, profile: str = "blocks", *keep) -> DataFrame:
    return docs.select("source_file", *keep, tx.normalise(F.col("text"), profile).alias("_text"))


def _header(docs: DataFrame, rules, profile: str = "blocks", constants=None) -> DataFrame:
    out = [f for r in rules for f in (r.fields if hasattr(r, "fields") else (r.field,))]
    return header(_normalised(docs, profile), rules, constants=constants).select("source_file", *out)


# --- extraction -------------------------------------------------------------------


def extract_wide(spark, sf):
    return extract(fx.confirmations(spark, sf), rs.CY)


def extract_utb_a(spark, sf):
    return extract(fx.utb_documents(spark, sf), rs.UTB).drop("processed_at")


def extract_utb_b(spark, sf):
    return extract(fx.flat_documents(spark, sf), rs.UTB_FLAT).drop("processed_at")


def empty_docs(spark, sf):
    """Documents without text: null for open orders, white space for finished ones."""
    docs = fx.confirmations(spark, sf)
    blank = F.when(F.col("status") == "O", F.lit(None)).when(F.col("status") == "F", F.lit(" \n \t ")).otherwise(F.col("text"))
    return extract(docs.withColumn("text", blank), rs.CY)


def vendor_route(spark, sf):
    """Documents of three sources, each parsed by its own rule set, and some of sources without one."""
    docs = [
        make(spark, sf).select(F.lit(source).alias("source"), "source_file", "text")
        for source, make in (("CY", fx.confirmations), ("UTB", fx.utb_documents), ("UTBFLAT", fx.flat_documents))
    ]
    others = fx.confirmations(spark, sf)
    other = F.when(F.col("status") == "O", "cy").when(F.col("status") == "F", "NEW")
    docs.append(others.select(other.alias("source"), "source_file", "text"))
    merged = reduce(lambda a, b: a.unionByName(b), docs)
    wide = extract_routed(merged, {"CY": rs.CY, "UTB": rs.UTB, "UTBFLAT": rs.UTB_FLAT})
    return wide.select(
        "source", "source_file", "routed", "loadConfirmationNumber", "totalCarrierPay", "carrier_name", "carrier_contact",
        "pickup_zipcode_2",
    )


# --- stops ------------------------------------------------------------------------


def stops_long(spark, sf):
    rows = segment.stops_long(_normalised(fx.confirmations(spark, sf)), "_text", ALL_STOPS)
    return rows.select("source_file", "pos", "type", "number")


def stops_valid(spark, sf):
    rows = segment.stops_long(_normalised(fx.confirmations(spark, sf)), "_text", rs.CY.splitter)
    return rows.select("source_file", "pos", "type", "number")


def stops_ranked(spark, sf):
    rows = segment.stops_ranked(_normalised(fx.confirmations(spark, sf)), "_text", rs.CY.splitter)
    return rows.select("source_file", "type", "rk", "number")


def _stops(spark, sf, *fields):
    return stop_rows(fx.confirmations(spark, sf), rs.CY, capped=True, fields=fields)


def stops_facility(spark, sf):
    return _stops(spark, sf, "customer")


def stops_geo(spark, sf):
    return _stops(spark, sf, "address", "city", "state", "zipcode")


def stops_time(spark, sf):
    return _stops(spark, sf, "start_datetime", "end_datetime")


def stops_all(spark, sf):
    """Every stop in long form, those without a slot in the wide row included."""
    return stop_rows(fx.confirmations(spark, sf), rs.CY, fields=("customer", "city", "zipcode", "start_datetime"))


def stops_beyond_slots(spark, sf):
    return beyond_slots(fx.confirmations(spark, sf), rs.CY)


def stops_all_flat(spark, sf):
    """Every numbered stop of the flat layout, those beyond its one pickup and two deliveries included."""
    rows = stop_rows(fx.flat_documents(spark, sf), rs.UTB_FLAT)
    return rows.select("source_file", "type", "rk", *FIELDS)


def stops_beyond_slots_flat(spark, sf):
    return beyond_slots(fx.flat_documents(spark, sf), rs.UTB_FLAT)


def stops_unanchored(spark, sf):
    """Stops found anywhere in a line; the last block ends at its closing label."""
    docs = fx.plain_confirmations(spark, sf)
    one_line = docs.withColumn("text", F.replace("text", F.lit("\n"), F.lit(" ")))
    rows = segment.stops_long(_normalised(one_line), "_text", rs.CY_1.splitter)
    # what is left of a block's closing labels: only the last block lost them
    return rows.select("source_file", "pos", "type", "number", F.contains("text", F.lit("Contact None")).alias("keeps_contact"))


def stops_time_variant(spark, sf):
    rows = stop_rows(fx.plain_confirmations(spark, sf), rs.CY_1, capped=True)
    return rows.select("source_file", "type", "rk", "customer", "address", "city", "start_datetime", "end_datetime")


def stops_by_type(spark, sf):
    """Blocks per type in the labelled layout, with numbered or plain markers."""
    docs = _normalised(fx.utb_documents(spark, sf), "lines")
    rows = segment.stops_ranked(docs, "_text", rs.UTB.splitter)
    zipcode = tx.extract(F.col("text"), rs.UTB_STOP.patterns["pickup"]["zipcode"])
    return rows.select("source_file", "type", "rk", zipcode.alias("zipcode"))


# --- header fields ----------------------------------------------------------------


def broker_contact(spark, sf):
    rules = (
        Rule("broker_email", rs.CY_BROKER[0].patterns, "booked_by"),
        Rule("broker_phone", (rs.CY_BROKER[1].pattern,), "booked_by"),
        rs.CY_BROKER[2],
    )
    return _header(fx.confirmations(spark, sf), rules)


def broker_fallback(spark, sf):
    return _header(fx.confirmations(spark, sf), rs.CY_BROKER[:2])


def section_slice(spark, sf):
    """The broker's block of one layout and the invoice block of the other."""
    of = lambda docs, profile, name: _normalised(docs, profile).select(
        "source_file", tx.strip(segment.section(F.col("_text"), name)).alias("section")
    )
    booked = of(fx.confirmations(spark, sf), "blocks", "booked_by")
    invoice = of(fx.utb_documents(spark, sf), "lines", "send_invoice")
    return booked.unionByName(invoice.withColumn("section", F.regexp_extract("section", tx.rx("Tel[:\\s]*([0-9-]+)"), 1)))


def carrier_id(spark, sf):
    return _header(fx.confirmations(spark, sf), (rs.CY_LOAD, *rs.CY_CARRIER))


def carrier_email(spark, sf):
    return _header(fx.confirmations(spark, sf), (rs.CY_CARRIER_EMAIL,))


def pay_extract(spark, sf):
    return _header(fx.confirmations(spark, sf), (rs.CY_PAY,))


def pay_extract_variants(spark, sf):
    """The first-generation, labelled and free-digit patterns on the same pay line."""
    amount = "format_number(price, 2)"
    line = fx.case(
        ("status = 'F'", f"concat('Line USD $ ', {amount})"),
        ("status = 'O'", f"concat('Total To Pay: $', {amount}, ' Amount $1.00')"),
        default=f"concat('Total Carrier Pay $', {amount}, ' Total $', {amount})",
    )
    docs = fx.orders(spark, sf).selectExpr("concat('/', k) AS source_file", f"{line} AS text")
    flat = rs.UTB_FLAT_HEADER[-1]
    return docs.select(
        "source_file",
        tx.first_amount(F.col("text"), rs.CY1_PAY.patterns).alias("first_generation"),
        tx.first_amount(F.col("text"), rs.UTB_HEADER[6].patterns).alias("labelled"),
        tx.first_amount(F.col("text"), flat.patterns).alias("free_digits"),
    )


def broker_addr(spark, sf):
    """Broker office read from the text, by the pattern of the first generation and that of the second."""
    base = fx.orders(spark, sf)
    office = "concat('Office ', 900 + k % 90, ' Northpoint Parkway Suite ', 100 + c % 50, ' Alpharetta, GA ', 30000 + k % 100, ' end')"
    docs = base.selectExpr("concat('/', k) AS source_file", f"CASE WHEN status = 'P' THEN 'none' ELSE {office} END AS text")
    first = _header(docs, (rs.CY1_OFFICE,))
    second = docs.withColumn("text", F.regexp_replace("text", r"Office \d+", "Office 960"))
    second = _header(second, (rs.CY2_OFFICE,)).select(
        F.col("source_file").alias("file"), *[F.col(f).alias(f"second_{f}") for f in rs.CY2_OFFICE.fields]
    )
    return first.join(second, F.col("source_file") == F.col("file")).drop("file")


# --- scalars ----------------------------------------------------------------------

# m/d/y date and time of day shapes rendered from lineitem
SHAPE = "((l_orderkey + l_linenumber) % 9)"
H24 = "(l_partkey % 24)"
H12 = "(l_partkey % 12 + 1)"
MINUTE = "(l_suppkey % 60)"
SHIP = "CAST(CAST(l_shipdate AS DATE) AS STRING)"


def _clocks(spark, sf):
    two = lambda x: f"lpad(cast({x} AS string), 2, '0')"
    us = f"concat(substr({SHIP}, 6, 2), '/', substr({SHIP}, 9, 2), '/', substr({SHIP}, 1, 4))"
    day_first = f"concat(substr({SHIP}, 9, 2), '/', substr({SHIP}, 6, 2), '/', substr({SHIP}, 1, 4))"
    bare = f"concat(cast(cast(substr({SHIP}, 6, 2) AS int) AS string), '/', cast(cast(substr({SHIP}, 9, 2) AS int) AS string), '/', substr({SHIP}, 1, 4))"
    half = "CASE WHEN l_suppkey % 2 = 0 THEN 'AM' ELSE 'pm' END"
    date = fx.case(
        (f"{SHAPE} = 1 AND substr({SHIP}, 9, 2) > '12'", day_first),
        (f"{SHAPE} = 4", f"concat('02/30/', substr({SHIP}, 1, 4))"),
        (f"{SHAPE} = 5", bare),
        default=us,
    )
    time = fx.case(
        (f"{SHAPE} = 1", f"concat('from ', {two(H24)}, ':', {two(MINUTE)}, ' - 23:59')"),
        (f"{SHAPE} = 2", f"concat({H12}, ':', {two(MINUTE)}, ' ', {half})"),
        (f"{SHAPE} = 3", f"concat({two(H24)}, ':', {two(MINUTE)}, ':07')"),
        (f"{SHAPE} = 5", f"concat({H24}, ':', {MINUTE})"),
        (f"{SHAPE} = 6", "'24:00'"),
        (f"{SHAPE} = 7", "''"),
        (f"{SHAPE} = 8", f"concat({H12}, ':', {two(MINUTE)}, ':07 ', {half})"),
        default=f"concat({two(H24)}, ':', {two(MINUTE)})",
    )
    lines = fx.read(spark, sf, "lineitem")
    return lines.selectExpr("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", f"{date} AS date", f"{time} AS time")


def _combined(spark, sf, combine):
    return _clocks(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", combine(F.col("date"), F.col("time")).alias("moment")
    )


def dt_combine(spark, sf):
    return _combined(spark, sf, dt.combine)


def dt_combine_us(spark, sf):
    return _combined(spark, sf, dt.combine_us)


def dt_combine_strict(spark, sf):
    return _combined(spark, sf, dt.combine_strict)


def _documents_text(spark, sf, column):
    return fx.read(spark, sf, "documents").select("doc_id", column.alias("text"))


def norm_text(spark, sf):
    return _documents_text(spark, sf, tx.normalise(F.col("text"), "blocks"))


def norm_lines(spark, sf):
    return _documents_text(spark, sf, tx.normalise(F.col("text"), "lines"))


def norm_flat(spark, sf):
    return _documents_text(spark, sf, tx.normalise(F.col("text"), "flat"))


def emails_joined(spark, sf):
    docs = fx.read(spark, sf, "documents")
    return docs.select(
        "doc_id", tx.emails_joined(F.col("text")).alias("emails"), tx.emails_joined(F.col("text"), fold=True).alias("folded")
    )


def _page_paths(spark, sf):
    prefix = "CASE WHEN url LIKE 'https:%' THEN 'dbfs:' ELSE 'file:' END"
    path = f"concat({prefix}, '/lake/raw/cy/txt_pymupdf4llm/', replace(url, '-', '%20'), '.txt')"
    return fx.read(spark, sf, "pages").selectExpr("page_id", f"{path} AS path")


def path_canon(spark, sf):
    p = F.col("path")
    names = [n for n, steps in tx.PATH_STEPS.items() if steps]
    return _page_paths(spark, sf).select("page_id", *[tx.canonical_path(p, tx.PATH_STEPS[n]).alias(n) for n in names])


def path_canon_validator(spark, sf):
    return _page_paths(spark, sf).select("page_id", tx.comparable_path(F.col("path")).alias("path"))


def path_target(spark, sf):
    path = "concat('/lake/pdf/', replace(url, '://', '/'), CASE WHEN url LIKE '%#top' THEN '.PDF' ELSE '' END)"
    rows = fx.read(spark, sf, "pages").selectExpr("page_id", f"{path} AS path")
    return rows.select("page_id", tx.output_path(F.col("path"), "/lake/pdf/", "/lake/txt").alias("path"))


def norm_all_strings(spark, sf):
    return v.normalise_strings(fx.read(spark, sf, "customer"))


# --- pages and audits -------------------------------------------------------------


def _pages(spark, sf):
    """Conversation turns as pages; a system turn stands for a page that failed."""
    text = F.when(F.col("role") != "system", F.col("text"))
    return spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", text.alias("text"))


def page_assemble(spark, sf):
    return pages.assemble(_pages(spark, sf), ["conv_id"], "turn")


def page_assemble_skip(spark, sf):
    return pages.assemble_filled(_pages(spark, sf), ["conv_id"], "turn")


def source_audit(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr(
        "concat('/lake/raw/txt/source=', source, '/', doc_id, '.txt') AS path", "text"
    )
    by = F.regexp_extract("path", "/source=([^/]+)/", 1).alias("source")
    return pages.source_audit(docs, "path", "text", [by])


def convert_ledger(spark, sf):
    """Labelled documents as conversion results: quality 1 converted, anything else failed."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    return pages.ledger(docs.join(labels, "doc_id", "left"), F.col("quality") == 1, ["source"])


# --- validation -------------------------------------------------------------------


def _target(spark, sf):
    """Extracted table with known differences: copies sent again at another price,
    a blank city for finished orders, one column gone, one added, spacing and case noise."""
    docs = fx.confirmations_with_copies(spark, sf)
    wide = extract(docs, rs.CY, keep=("source_file", "status"))
    return wide.select(
        *[c for c in wide.columns if c not in ("status", "pickup_city_1", "carrier_name", "carrier_fax")],
        F.when(F.col("status") == "F", "").otherwise(F.col("pickup_city_1")).alias("pickup_city_1"),
        F.concat(F.lit("  "), F.lower("carrier_name"), F.lit(" ")).alias("carrier_name"),
        F.lit("").alias("pickup_note"),
    )


def validate_fields(spark, sf):
    return v.compare(fx.truth(spark, sf), _target(spark, sf))


def validate_report(spark, sf):
    return v.compare(fx.truth(spark, sf), _target(spark, sf), missing="report")


def validate_one(spark, sf):
    """The report of a single load, the first one of the table."""
    return v.compare(v.only_key(fx.truth(spark, sf), "1"), v.only_key(_target(spark, sf), "1"))


def field_category(spark, sf):
    """Filled target values per field, with the field's category."""
    target = _target(spark, sf)
    values = F.array(*[F.struct(F.lit(c).alias("field"), (F.col(c) != "").alias("filled")) for c in target.columns])
    rows = target.select(F.inline(values))
    return rows.groupBy("field", v.category(F.col("field")).alias("category")).agg(F.count_if("filled").alias("filled"))


def missing_loads(spark, sf):
    return v.missing_loads(fx.truth(spark, sf), _target(spark, sf))


def dedup_first(spark, sf):
    return v.first_row_per_key(_target(spark, sf), columns=("source_file", "totalCarrierPay")).select(v.KEY, "source_file", "totalCarrierPay")


def schema_diff(spark, sf):
    return v.schema_diff(fx.truth(spark, sf), _target(spark, sf))


def schema_evolve(spark, sf):
    """New rows written over a table whose old columns stay as nulls."""
    old = spark.read.parquet(f"{sf}/customer.parquet")
    new = old.selectExpr("c_custkey", "c_name", "c_acctbal < 0 AS in_debt")
    return keep_old_columns(new, old.schema)


def _tally(spark, sf):
    return v.tally(fx.truth(spark, sf), _target(spark, sf))


def accuracy_rollup(spark, sf):
    return v.accuracy_of(_tally(spark, sf)).select("category", "matches", "total", "accuracy")


def accuracy_business(spark, sf):
    return v.accuracy_of(_tally(spark, sf)).select("category", "business_matches", "business_total", "business_accuracy")


def error_ledger(spark, sf):
    return v.errors_of(_tally(spark, sf))


def ruleset_compare(spark, sf):
    generations = [rs.CY_1, rs.CY_2, rs.CY_3, rs.CY_4, rs.CY_5]
    return compare_rulesets(fx.plain_confirmations(spark, sf), fx.plain_truth(spark, sf), generations)


QUERIES = {
    f.__name__: f
    for f in (
        extract_wide, extract_utb_a, extract_utb_b, empty_docs, vendor_route,
        stops_long, stops_valid, stops_ranked, stops_facility, stops_geo, stops_time,
        stops_all, stops_beyond_slots, stops_all_flat, stops_beyond_slots_flat, stops_unanchored, stops_time_variant, stops_by_type,
        broker_contact, broker_fallback, section_slice, carrier_id, carrier_email,
        pay_extract, pay_extract_variants, broker_addr,
        dt_combine, dt_combine_us, dt_combine_strict,
        norm_text, norm_lines, norm_flat, emails_joined,
        path_canon, path_canon_validator, path_target, norm_all_strings,
        page_assemble, page_assemble_skip, source_audit, convert_ledger,
        validate_fields, validate_report, validate_one, field_category,
        missing_loads, dedup_first, schema_diff, schema_evolve,
        accuracy_rollup, accuracy_business, error_ledger, ruleset_compare,
    )
}

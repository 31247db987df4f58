"""DuckDB SQL for every query: the values the documents were rendered from, or the
same scalar rules in RE2."""

from __future__ import annotations

from functools import reduce

from . import fixtures as fx
from . import queries as q
from . import rulesets as rs
from .fixtures import S, case

ORDERS = "o AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in fx.ORDER.items()) + " FROM orders)"
CY_FILE = f"('/lake/raw/cy/pdf/' || {S('k')} || '.pdf')"
UTB_FILE = f"('/lake/raw/utb/' || {S('k')} || '.txt')"
FLAT_FILE = f"('/lake/raw/utb_flat/' || {S('k')} || '.txt')"


def _slots(kind: str, cap: int, fields) -> str:
    return ", ".join(
        f"coalesce(max(CASE WHEN type = '{kind}' AND rk = {n} THEN {f} END), '') AS {kind}_{f}_{n}"
        for n in range(1, cap + 1)
        for f in fields
    )


def _stops(name: str, n: str, kind: str, where: str, truth: dict) -> str:
    """CTEs: stop rows of each order with their rank per type."""
    values = ", ".join(f"{e} AS {f}" for f, e in truth.items())
    return f"""
    {name}_i AS (SELECT *, unnest(generate_series(1, {n})) AS i FROM o),
    {name} AS (SELECT k, i, {kind} AS type, {values},
        row_number() OVER (PARTITION BY k, {kind} ORDER BY i) AS rk
        FROM {name}_i WHERE {where})"""


CY_KIND = f"CASE WHEN {fx.PICKUP} THEN 'pickup' ELSE 'delivery' END"
CY_STOPS = _stops("s", fx.N, CY_KIND, f"NOT {fx.EMPTY} AND NOT {fx.COLLAPSED}", fx.STOP_TRUTH)
ALL_CY_STOPS = _stops("s", fx.N, CY_KIND, f"NOT {fx.EMPTY}", fx.STOP_TRUTH)
FIELDS = list(fx.STOP_TRUTH)
KEPT = "((type = 'pickup' AND rk = 1) OR (type = 'delivery' AND rk <= 2))"


def _wide(file: str, header: dict, caps: dict, columns) -> str:
    slots = ", ".join(_slots(t, n, FIELDS) for t, n in caps.items())
    names = [f"{t}_{f}_{n}" for t, cap in caps.items() for n in range(1, cap + 1) for f in FIELDS]
    values = {**header, **{n: f"coalesce({n}, '')" for n in names}}
    return (
        f"p AS (SELECT k AS pk, {slots} FROM s GROUP BY k), "
        f"w AS (SELECT {file} AS source_file, k, status, priority, price, "
        + ", ".join(f"{values[c]} AS {c}" for c in columns)
        + " FROM o LEFT JOIN p ON o.k = p.pk)"
    )


CY_WIDE = f"WITH {ORDERS}, {CY_STOPS}, " + _wide(CY_FILE, fx.HEADER_TRUTH, rs.ONE_AND_TWO, rs.CY.fields)


def _typed(counts: dict, truth, caps: dict, file: str, header: dict, columns) -> str:
    parts, union = [], []
    for t, n in counts.items():
        values = ", ".join(f"{e} AS {f}" for f, e in truth(t).items())
        parts.append(f"{t}_i AS (SELECT *, unnest(generate_series(1, {n})) AS i FROM o)")
        union.append(f"SELECT k, i AS rk, '{t}' AS type, {values} FROM {t}_i")
    return f"WITH {ORDERS}, {', '.join(parts)}, s AS ({' UNION ALL '.join(union)}), " + _wide(file, header, caps, columns)


UTB_WIDE = _typed(
    {"pickup": fx.UTB_PICKUPS, "delivery": fx.UTB_DELIVERIES}, fx.utb_stop_truth, rs.THREE_EACH,
    UTB_FILE, fx.UTB_HEADER_TRUTH, rs.UTB.fields,
)
FLAT_WIDE = _typed(
    {"pickup": fx.FLAT_PICKUPS, "delivery": fx.FLAT_DELIVERIES}, lambda t: fx.FLAT_STOP_TRUTH[t], rs.ONE_AND_TWO,
    FLAT_FILE, fx.FLAT_HEADER_TRUTH, rs.UTB_FLAT.fields,
)


def _columns(names) -> str:
    return ", ".join(["source_file", *names])


def _header(fields, overrides=None) -> str:
    values = {**fx.HEADER_TRUTH, **(overrides or {})}
    return f"WITH {ORDERS} SELECT {CY_FILE} AS source_file, " + ", ".join(f"{values[f]} AS {f}" for f in fields) + " FROM o"


def _stop_query(*fields) -> str:
    return f"WITH {ORDERS}, {CY_STOPS} SELECT {CY_FILE} AS source_file, type, CAST(rk AS INTEGER) AS rk, {', '.join(fields)} FROM s WHERE {KEPT}"


NO_CONTACT = f"{fx.EMPTY} OR {fx.NO_DESK} OR {fx.SILENT_DESK}"
BOOKED_BY = case(
    (f"{fx.EMPTY} OR {fx.NO_DESK}", "''"),
    (fx.SILENT_DESK, "'Desk agent'"),
    default=f"'Agent One ' || {fx.AGENT_EMAIL} || ' Phone: ' || {fx.AGENT_PHONE} || chr(10) || 'Fax: ' || "
    + case(("k % 3 = 0", "'None'"), default="'+1 (555) 012 4891'"),
)

PLAIN_STOPS = _stops(
    "s", fx.PLAIN_STOPS, f"CASE WHEN {fx.PLAIN_PICKUP} THEN 'pickup' ELSE 'delivery' END", "TRUE",
    {**fx.PLAIN_STOP_TRUTH, "labelled": "(k % 4 = 1)", "last": f"(i = {fx.PLAIN_STOPS})"},
)

# --- dates ------------------------------------------------------------------------

_two = lambda x: f"lpad(CAST({x} AS STRING), 2, '0')"
_MONTH_DAY_SWAP = f"{q.SHAPE} = 1 AND substr({q.SHIP}, 9, 2) > '12'"
_PM = "l_suppkey % 2 = 1"
_H12_24 = f"CASE WHEN {_PM} THEN {q.H12} % 12 + 12 ELSE {q.H12} % 12 END"
_AT = lambda hour, seconds="00": f"{q.SHIP} || 'T' || {_two(hour)} || ':' || {_two(q.MINUTE)} || ':{seconds}'"


def _moment(*cases) -> str:
    return f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {case(*cases)} AS moment FROM lineitem"


PLAIN_CLOCK = f"{q.SHAPE} IN (0, 5)"
DATES = {
    "dt_combine": _moment(
        (f"{PLAIN_CLOCK} OR {q.SHAPE} = 1", _AT(q.H24)),
        (f"{q.SHAPE} = 2", _AT(f"({_H12_24})")),
        (f"{q.SHAPE} = 3", _AT(q.H24, "07")),
    ),
    "dt_combine_us": _moment(
        (PLAIN_CLOCK, _AT(q.H24)),
        (f"{q.SHAPE} = 2", _AT(f"({_H12_24})")),
        (f"{q.SHAPE} = 3", _AT(q.H24, "07")),
        (f"{q.SHAPE} = 8", _AT(f"({_H12_24})", "07")),
    ),
    # the strict form reads the clock before AM/PM as it stands
    "dt_combine_strict": _moment((f"{q.SHAPE} = 3", _AT(q.H24, "07")), (f"{q.SHAPE} = 8", _AT(q.H12, "07"))),
}

# --- text -------------------------------------------------------------------------

WS = r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
WORD = r"\p{L}\p{M}\p{N}_"


def sub(x: str, pattern: str, by: str) -> str:
    return f"regexp_replace({x}, '{pattern}', {by}, 'g')"


def strip(x: str) -> str:
    return sub(x, f"^{WS}+|{WS}+$", "''")


def spaces(x: str) -> str:
    x = sub(x, r"[ \t\x{A0}]+", "' '")
    x = sub(x, r"\r\n?", "chr(10)")
    return sub(x, r"\n{3,}", "chr(10) || chr(10)")


NORM_TEXT = strip(spaces(sub("text", r"\*{2,}", "''")))
_lines = sub("text", r"\*{2,}", "''")
_lines = sub(_lines, r"(?i)PickUp\b", "'Pickup'")
_lines = sub(_lines, r"(?i)Del\.\s*Date", "'Delivery Date'")
_lines = spaces(sub(_lines, r"(?i)Miami Lake,s", "'Miami Lakes'"))
for _ in range(2):  # a second pass for lines of a single character
    _lines = sub(_lines, rf"([{WORD}])\n([A-Z0-9])", r"'\1 \2'")
NORM_LINES = strip(sub(_lines, rf"{WS}*\n{WS}*", "chr(10)"))
NORM_FLAT = strip(sub(sub("text", r"\*", "''"), f"{WS}+", "' '"))
MAILS = rf"list_sort(list_distinct(regexp_extract_all(text, '[{WORD}.\-]+@[{WORD}.\-]+\.[{WORD}]+')))"
PAGE_PATH = "(CASE WHEN url LIKE 'https:%' THEN 'dbfs:' ELSE 'file:' END || '/lake/raw/cy/txt_pymupdf4llm/' || replace(url, '-', '%20') || '.txt')"
_steps = lambda *steps: reduce(lambda x, s: sub(x, *s), steps, PAGE_PATH)
_DBFS, _PDF, _TXT, _SPACE = (r"^dbfs:", "''"), ("/txt_pymupdf4llm/", "'/pdf/'"), (r"\.txt$", "'.pdf'"), ("%20", "' '")

PAGES = "(SELECT conv_id, turn, CASE WHEN role <> 'system' THEN text END AS text FROM conversations)"

# --- validation -------------------------------------------------------------------

ALL_FIELDS = ["source_file", *rs.CY.fields]
RESENT = "priority = '5-LOW'"
RESENT_PAY = S("CAST(price + 1 AS DECIMAL(18,2))")
SENT_FILE = f"('/lake/raw/cy/pdf/' || CASE WHEN {RESENT} THEN '{fx.RESENT_FOLDER}' ELSE '' END || {S('k')} || '.pdf')"
TARGET = {
    "source_file": SENT_FILE,
    "totalCarrierPay": case((f"{RESENT} AND totalCarrierPay <> ''", RESENT_PAY), default="totalCarrierPay"),
    "pickup_city_1": case(("status = 'F'", "''"), default="pickup_city_1"),
    "carrier_name": "'  ' || lower(carrier_name) || ' '",
    "carrier_fax": "'None'",
}


def _category(f: str) -> str:
    prefix = f.split("_")[0]
    return prefix if prefix in ("broker", "carrier", "pickup", "delivery") and "_" in f else "other"


def _results(missing: bool) -> str:
    """CTE r: one row per load and field."""
    lists = {
        "field": [f"'{f}'" for f in ALL_FIELDS],
        "category": [f"'{_category(f)}'" for f in ALL_FIELDS],
        # an empty document still has a truth: its stops; only its header is empty
        "truth": ALL_FIELDS,
        "target": [TARGET.get(f, f) for f in ALL_FIELDS],
    }
    unnested = ", ".join(f"unnest([{', '.join(v)}]) AS {n}" for n, v in lists.items())
    status = case(
        ("field = 'carrier_fax'", "'Missing Col'"),
        ("lower(trim(truth)) = lower(trim(target))", "'Match'"),
        default="'Mismatch'",
    )
    found = f"NOT {fx.EMPTY}"
    if missing:
        status = case((fx.EMPTY, "'Missing record'"), default=status)
        target = f"CASE WHEN {found} THEN target END"
        where = ""
    else:
        target, where = "target", f"WHERE {found}"
    return (
        f"u AS (SELECT k, {S('k')} AS load, {unnested} FROM w), "
        f"r AS (SELECT load, field, category, truth, {target} AS target, {status} AS status FROM u {where})"
    )


TRUTH_STOPS = _stops("s", fx.N, CY_KIND, f"NOT {fx.COLLAPSED}", fx.STOP_TRUTH)
TRUTH_WIDE = f"WITH {ORDERS}, {TRUTH_STOPS}, " + _wide(
    CY_FILE, {**fx.HEADER_TRUTH, "loadConfirmationNumber": S("k")}, rs.ONE_AND_TWO, rs.CY.fields
)
RESULTS = f"{TRUTH_WIDE}, {_results(False)}"
REPORT = f"{TRUTH_WIDE}, {_results(True)}"
SCORES = f"""{RESULTS},
    e AS (SELECT category, status = 'Match' AS ok, truth <> '' AS filled FROM r WHERE status <> 'Missing Col'),
    a AS (SELECT coalesce(category, 'total') AS category, count(*) FILTER (ok) AS matches, count(*) AS total,
        count(*) FILTER (ok AND filled) AS business_matches, count(*) FILTER (filled) AS business_total
        FROM e GROUP BY ROLLUP (category))"""
_percent = lambda a, n: f"CASE WHEN {n} > 0 THEN CAST({a} AS DOUBLE) / {n} * 100 ELSE 0.0 END"

# Wrong place fields per stop for each rule-set generation, by form of the plain layout.
PLAIN_ERRORS = {"cy_1": (4, 0, 4, 4), "cy_2": (2, 2, 0, 2), "cy_3": (2, 2, 0, 0), "cy_4": (0, 2, 0, 2), "cy_5": (0, 0, 0, 2)}
_errors = ", ".join(f"('{r}', {f}, {n})" for r, row in PLAIN_ERRORS.items() for f, n in enumerate(row))
_drops = "1 + k % 2"
RULESETS = f"""WITH {ORDERS}, x(ruleset, form, wrong) AS (VALUES {_errors}),
    j AS (SELECT ruleset, wrong, {_drops} AS drops FROM o JOIN x ON k % 4 = form),
    c AS (
        SELECT ruleset, 'broker' AS category, 8 * count(*) AS matches, 8 * count(*) AS total, 8 * count(*) AS business_matches, 8 * count(*) AS business_total FROM j GROUP BY ruleset
        UNION ALL SELECT ruleset, 'carrier', 9 * count(*), 9 * count(*), 3 * count(*), 3 * count(*) FROM j GROUP BY ruleset
        UNION ALL SELECT ruleset, 'other', 3 * count(*), 3 * count(*), 3 * count(*), 3 * count(*) FROM j GROUP BY ruleset
        UNION ALL SELECT ruleset, 'pickup', sum(7 - wrong), 7 * count(*), sum(7 - wrong), 7 * count(*) FROM j GROUP BY ruleset
        UNION ALL SELECT ruleset, 'delivery', sum(14 - drops * wrong), 14 * count(*), sum(drops * (7 - wrong)), sum(7 * drops) FROM j GROUP BY ruleset),
    t AS (SELECT * FROM c UNION ALL
        SELECT ruleset, 'total', sum(matches), sum(total), sum(business_matches), sum(business_total) FROM c GROUP BY ruleset)
    SELECT ruleset, category, CAST(matches AS BIGINT) AS matches, CAST(total AS BIGINT) AS total, {_percent('matches', 'total')} AS accuracy,
        CAST(business_matches AS BIGINT) AS business_matches, CAST(business_total AS BIGINT) AS business_total,
        {_percent('business_matches', 'business_total')} AS business_accuracy FROM t"""

BLANK = f"({fx.EMPTY} OR status IN ('O', 'F'))"
_office = lambda value: case(("status = 'P'", "''"), default=value)

FILLED = ", ".join(
    f"('{f}', '{_category(f)}', (SELECT count(*) FILTER ({TARGET.get(f, f)} <> '') FROM sent))"
    for f in ALL_FIELDS
    if f != "carrier_fax"
)

ORACLE = {
    "extract_wide": f"{CY_WIDE} SELECT {_columns(rs.CY.fields)} FROM w",
    "extract_utb_a": f"{UTB_WIDE} SELECT {_columns(rs.UTB.fields)} FROM w",
    "extract_utb_b": f"{FLAT_WIDE} SELECT {_columns(rs.UTB_FLAT.fields)} FROM w",
    "empty_docs": f"{CY_WIDE} SELECT source_file, "
    + ", ".join(f"CASE WHEN {BLANK} THEN '' ELSE {f} END AS {f}" for f in rs.CY.fields)
    + " FROM w",
    "vendor_route": " UNION ALL ".join(
        f"SELECT * FROM ({wide} SELECT '{source}' AS source, source_file, true AS routed, loadConfirmationNumber, totalCarrierPay, carrier_name, {contact} AS carrier_contact, {second} AS pickup_zipcode_2 FROM w)"
        for source, wide, contact, second in (
            ("CY", CY_WIDE, "''", "''"),
            ("UTB", UTB_WIDE, "carrier_contact", "pickup_zipcode_2"),
            ("UTBFLAT", FLAT_WIDE, "carrier_contact", "''"),
        )
    )
    + f" UNION ALL SELECT * FROM (WITH {ORDERS} SELECT CASE status WHEN 'O' THEN 'cy' WHEN 'F' THEN 'NEW' END AS source, {CY_FILE} AS source_file, "
    "false AS routed, '' AS loadConfirmationNumber, '' AS totalCarrierPay, '' AS carrier_name, '' AS carrier_contact, '' AS pickup_zipcode_2 FROM o)",
    "stops_all": f"WITH {ORDERS}, {CY_STOPS} SELECT {CY_FILE} AS source_file, type, CAST(rk AS INTEGER) AS rk, customer, city, zipcode, start_datetime FROM s",
    "stops_beyond_slots": f"WITH {ORDERS}, {CY_STOPS}, t(type, slots) AS (VALUES ('pickup', 1), ('delivery', 2)), "
    "n AS (SELECT o.k, t.type, t.slots, CAST((SELECT count(*) FROM s WHERE s.k = o.k AND s.type = t.type) AS INTEGER) AS stops FROM o, t) "
    f"SELECT {CY_FILE} AS source_file, type, stops, slots, greatest(stops - slots, 0) AS beyond FROM n",
    "stops_all_flat": f"{FLAT_WIDE} SELECT {FLAT_FILE} AS source_file, type, CAST(rk AS INTEGER) AS rk, {', '.join(FIELDS)} FROM s",
    "stops_beyond_slots_flat": f"{FLAT_WIDE}, t(type, slots) AS (VALUES ('pickup', 1), ('delivery', 2)), "
    "n AS (SELECT o.k, t.type, t.slots, CAST((SELECT count(*) FROM s WHERE s.k = o.k AND s.type = t.type) AS INTEGER) AS stops FROM o, t) "
    f"SELECT {FLAT_FILE} AS source_file, type, stops, slots, greatest(stops - slots, 0) AS beyond FROM n",
    "stops_long": f"WITH {ORDERS}, {ALL_CY_STOPS} SELECT {CY_FILE} AS source_file, CAST(i AS INTEGER) AS pos, type, CAST(i AS INTEGER) AS number FROM s",
    "stops_valid": f"WITH {ORDERS}, {CY_STOPS} SELECT {CY_FILE} AS source_file, CAST(row_number() OVER (PARTITION BY k ORDER BY i) AS INTEGER) AS pos, type, CAST(i AS INTEGER) AS number FROM s",
    "stops_ranked": f"WITH {ORDERS}, {CY_STOPS} SELECT {CY_FILE} AS source_file, type, CAST(rk AS INTEGER) AS rk, CAST(i AS INTEGER) AS number FROM s WHERE {KEPT}",
    "stops_facility": _stop_query("customer"),
    "stops_geo": _stop_query("address", "city", "state", "zipcode"),
    "stops_time": _stop_query("start_datetime", "end_datetime"),
    "stops_unanchored": f"WITH {ORDERS}, {PLAIN_STOPS} SELECT {CY_FILE} AS source_file, CAST(i AS INTEGER) AS pos, type, CAST(i AS INTEGER) AS number, NOT last AS keeps_contact FROM s",
    "stops_time_variant": f"WITH {ORDERS}, {PLAIN_STOPS} SELECT {CY_FILE} AS source_file, type, CAST(rk AS INTEGER) AS rk, customer, CASE WHEN labelled THEN address ELSE '' END AS address, CASE WHEN labelled THEN city ELSE '' END AS city, start_datetime, end_datetime FROM s",
    "stops_by_type": f"{UTB_WIDE} SELECT {UTB_FILE} AS source_file, type, CAST(rk AS INTEGER) AS rk, zipcode FROM s WHERE rk <= 3",
    "broker_contact": _header(
        ("broker_email", "broker_phone", "broker_fax"),
        {
            "broker_email": case((NO_CONTACT, "''"), default=fx.AGENT_EMAIL),
            "broker_phone": case((NO_CONTACT, "''"), default=fx.AGENT_PHONE),
        },
    ),
    "broker_fallback": _header(("broker_email", "broker_phone")),
    "section_slice": f"WITH {ORDERS} SELECT {CY_FILE} AS source_file, {BOOKED_BY} AS section FROM o "
    f"UNION ALL SELECT {UTB_FILE}, {fx.UTB_HEADER_TRUTH['broker_phone']} FROM o",
    "carrier_id": _header(("loadConfirmationNumber", "carrier_name", "carrier_mc")),
    "carrier_email": _header(("carrier_email",)),
    "pay_extract": _header(("totalCarrierPay",)),
    "pay_extract_variants": f"WITH {ORDERS} SELECT '/' || {S('k')} AS source_file, "
    f"{case(('status = ' + chr(39) + 'O' + chr(39), chr(39) + '1.00' + chr(39)), default=fx.AMOUNT)} AS first_generation, "
    f"{case(('status = ' + chr(39) + 'F' + chr(39), chr(39) * 2), default=fx.AMOUNT)} AS labelled, "
    f"{case(('status = ' + chr(39) + 'O' + chr(39), fx.AMOUNT))} AS free_digits FROM o",
    "broker_addr": f"WITH {ORDERS} SELECT '/' || {S('k')} AS source_file, "
    + _office(f"{S('900 + k % 90')} || ' Northpoint Parkway Suite ' || {S('100 + c % 50')}")
    + f" AS broker_address, {_office(chr(39) + 'Alpharetta' + chr(39))} AS broker_city, {_office(chr(39) + 'GA' + chr(39))} AS broker_state, {_office(S('30000 + k % 100'))} AS broker_zipcode, "
    + _office(f"'960 Northpoint Parkway Suite ' || {S('100 + c % 50')}")
    + f" AS second_broker_address, {_office(chr(39) + 'Alpharetta' + chr(39))} AS second_broker_city, {_office(chr(39) + 'GA' + chr(39))} AS second_broker_state, "
    + f"{_office(S('30000 + k % 100'))} AS second_broker_zipcode FROM o",
    **DATES,
    "norm_text": f"SELECT doc_id, {NORM_TEXT} AS text FROM documents",
    "norm_lines": f"SELECT doc_id, {NORM_LINES} AS text FROM documents",
    "norm_flat": f"SELECT doc_id, {NORM_FLAT} AS text FROM documents",
    "emails_joined": f"SELECT doc_id, array_to_string({MAILS}, '; ') AS emails, lower(array_to_string({MAILS}, '; ')) AS folded FROM documents",
    "path_canon": "SELECT page_id, "
    + f"{_steps(_DBFS, (r'^file:', chr(39) * 2), _PDF, _TXT, _SPACE)} AS current, "
    + f"{_steps(_DBFS, _PDF, _TXT, _SPACE)} AS no_file_prefix, "
    + f"{_steps(_DBFS, ('raw/cy/[^/]+/', chr(39) + 'raw/cy/pdf/' + chr(39)), _TXT, _SPACE)} AS any_folder, "
    + f"{_steps(('dbfs:', chr(39) * 2), ('txt_llm', chr(39) + 'pdf' + chr(39)), _TXT, _SPACE)} AS flat FROM pages",
    "path_canon_validator": f"SELECT page_id, trim(replace(replace(replace({PAGE_PATH}, 'dbfs:', ''), '/txt_pymupdf4llm/', '/pdf/'), '.txt', '.pdf')) AS path FROM pages",
    "path_target": "SELECT page_id, '/lake/txt/' || regexp_replace(replace(url, '://', '/') || CASE WHEN url LIKE '%#top' THEN '.PDF' ELSE '' END, "
    + r"'([^/.]\.*)\.[^./]*$', '\1') || '.txt' AS path FROM pages",
    "norm_all_strings": "SELECT c_custkey, lower(trim(c_name)) AS c_name, c_nationkey, c_acctbal, lower(trim(c_mktsegment)) AS c_mktsegment FROM customer",
    "page_assemble": f"SELECT conv_id, string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY turn) AS text FROM {PAGES} GROUP BY ALL",
    "page_assemble_skip": f"SELECT conv_id, coalesce(string_agg(CASE WHEN text <> '' THEN text || chr(10) END, '' ORDER BY turn), '') AS text FROM {PAGES} GROUP BY ALL",
    "source_audit": "SELECT source, count(*) AS files, min('/lake/raw/txt/source=' || source || '/' || doc_id || '.txt') AS first_file, max('/lake/raw/txt/source=' || source || '/' || doc_id || '.txt') AS last_file, CAST(sum(length(text)) AS BIGINT) AS characters FROM documents GROUP BY source",
    "convert_ledger": "SELECT source, count(*) FILTER (quality = 1) AS converted, count(*) FILTER (coalesce(quality, 0) <> 1) AS failed FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source",
    "validate_fields": f"{RESULTS} SELECT * FROM r",
    "validate_report": f"{REPORT} SELECT * FROM r",
    "validate_one": f"{RESULTS} SELECT * FROM r WHERE load = '1'",
    "field_category": f"{CY_WIDE}, sent AS (SELECT * FROM w UNION ALL SELECT * FROM w WHERE {RESENT}) SELECT * FROM (VALUES {FILLED}, ('pickup_note', 'pickup', 0)) AS v(field, category, filled)",
    "missing_loads": f"WITH {ORDERS} SELECT {S('k')} AS loadConfirmationNumber FROM o WHERE {fx.EMPTY}",
    "dedup_first": f"{CY_WIDE} SELECT loadConfirmationNumber, min({SENT_FILE}) AS source_file, max({TARGET['totalCarrierPay']}) AS totalCarrierPay FROM w GROUP BY loadConfirmationNumber",
    "schema_diff": f"WITH {ORDERS} SELECT column_name, difference, (SELECT count(*) FROM o WHERE NOT {fx.EMPTY}) AS loads FROM (VALUES ('carrier_fax', 'missing'), ('pickup_note', 'extra')) AS v(column_name, difference)",
    "schema_evolve": "SELECT c_custkey, c_name, c_acctbal < 0 AS in_debt, CAST(NULL AS INTEGER) AS c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer",
    "accuracy_rollup": f"{SCORES} SELECT category, matches, total, {_percent('matches', 'total')} AS accuracy FROM a",
    "accuracy_business": f"{SCORES} SELECT category, business_matches, business_total, {_percent('business_matches', 'business_total')} AS business_accuracy FROM a",
    "error_ledger": f"""{REPORT}, f AS (SELECT count(*) FILTER (status = 'Mismatch') AS bad, count(*) FILTER (status = 'Missing Col') AS col,
        count(DISTINCT load) FILTER (status = 'Missing record') AS gone, count(DISTINCT load) FILTER (status = 'Missing Col') AS cut FROM r)
        SELECT 'mismatch' AS kind, bad AS errors FROM f UNION ALL SELECT 'missing_column', col FROM f
        UNION ALL SELECT 'missing_load', gone FROM f UNION ALL SELECT 'incomplete_schema', cut FROM f""",
    "ruleset_compare": RULESETS,
}

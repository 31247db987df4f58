"""Documents rendered from the orders table, one per order and layout.

TRUTH expressions are plain SQL over one order row (k, c, d, price, status, priority)
and, for stops, the stop index i. Spark and DuckDB both evaluate them: Spark renders
document text from them and extracts it back, the check returns them directly.
Rendering and truth are map-only, so nothing here groups, ranks or shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import PATH_STEPS, canonical_path
from . import rulesets as rs

ORDER = {
    "k": "o_orderkey",
    "c": "o_custkey",
    "d": "CAST(o_orderdate AS DATE)",
    "price": "CAST(o_totalprice AS DECIMAL(18,2))",
    "status": "o_orderstatus",
    "priority": "o_orderpriority",
}


def S(x: str) -> str:
    return f"CAST({x} AS STRING)"


def pick(words: str, index: str, sep: str = "|") -> str:
    return f"split_part('{words}', '{sep}', CAST(({index}) % {len(words.split(sep))} + 1 AS INTEGER))"


def pad(x: str, n: int) -> str:
    return f"lpad({S(x)}, {n}, '0')"


def case(*pairs, default: str = "''") -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {default} END"


# --- stops of layout CY -----------------------------------------------------------

N = "CAST(k % 8 AS INTEGER)"
EMPTY = "(k % 29 = 0)"
PICKUP = "((k + i) % 3 = 0)"
COLLAPSED = "((k + i * 5) % 11 = 0)"  # no Address word
TBD = "((k + i) % 13 = 5)"  # an address without a place
CUT_OFF = f"(k % 23 = 7 AND i = {N})"  # the document ends right after the ZIP
NO_FACILITY = "((k + 2 * i) % 17 = 3)"
NO_TIME = "((k + 3 * i) % 19 = 7)"
RANGE = "((k + i) % 2 = 0)"
KIND = "((k + i * 7) % 6)"

NUMBER = S("100 + (c * 7 + i * 31) % 9000")
STREET = f"({NUMBER} || ' ' || {pick('OAK|MAPLE|GREENWOOD|COUNTY|SONORA|BOHANNON|HARBOR|MILL', 'c + i')})"
ROAD = f"({pick('RD|DR|AVE|ST|BLVD|HWY|WAY|CT|PKWY|LN', 'k + i')} || {case(('(k + i) % 9 = 4', chr(39) + '.' + chr(39)))})"
SUITE = f"('SUITE ' || {S('10 + (k + i) % 290')})"
CITY = pick("Lithia Springs|McDonough|Plant City|Sarasota|Fairburn|Lakeland|North Bend|West Palm Beach", "c + i")
ONE_WORD_CITY = pick("Sarasota|Fairburn|Lakeland|Clewiston|Tampa|Lewiston|Macon", "c + i")
STATE = pick("FL|GA|TX|ME|WA|OH|AL|SC", "c + i")
ZIP5 = pad("(k * 37 + i * 101) % 100000", 5)
ZIP = f"({ZIP5} || {case(('(k + i) % 5 = 2', chr(39) + '-' + chr(39) + ' || ' + pad('(c + i) % 10000', 4)))})"
NAMES = "United Mills|Acme Foods|DSC-JM Orchard / Blue Heart DC|Harvest of Ohio|Northern Grain Depot"
NAME = pick(NAMES, "c + i")
DAY = S("d + CAST(i AS INTEGER)")
HOUR = "(6 + (k + i) % 9)"

PLACED = f"(NOT {TBD} AND NOT {CUT_OFF})"
# the text after a lower-case word is taken for noise, so 'Harvest of Ohio' ends early
KEPT_NAME = case((f"{NAME} = 'Harvest of Ohio'", "'Harvest'"), default=NAME)

STOP_TRUTH = {
    "customer": case((NO_FACILITY, "''"), default=KEPT_NAME),
    "address": case(
        (f"NOT {PLACED}", "''"),
        (f"{KIND} = 1", f"{STREET} || ' ' || {ROAD} || ' ' || {SUITE}"),
        (f"{KIND} = 2", f"{STREET} || ' ' || {ROAD} || ' BUILDING A'"),
        (f"{KIND} = 3", f"{STREET} || ' TRAIL'"),
        (f"{KIND} = 4", NUMBER),
        default=f"{STREET} || ' ' || {ROAD}",
    ),
    "city": case(
        (f"NOT {PLACED}", "''"), (f"{KIND} = 3", ONE_WORD_CITY), (f"{KIND} = 4", "'Town'"), default=CITY
    ),
    "state": case((PLACED, STATE)),
    "zipcode": case((PLACED, ZIP)),
    "start_datetime": case(
        (NO_TIME, "''"),
        (RANGE, f"{DAY} || 'T' || {pad(HOUR, 2)} || ':00:00'"),
        default=f"{DAY} || 'T' || {pad(HOUR, 2)} || ':15:00'",
    ),
    "end_datetime": case(
        (NO_TIME, "''"),
        (RANGE, f"{DAY} || 'T' || {pad(HOUR + ' + 5', 2)} || ':30:00'"),
        default=f"{DAY} || 'T' || {pad(HOUR, 2)} || ':15:00'",
    ),
}

# --- rendering of layout CY (Spark only) --------------------------------------------

US_DATE = f"concat(substr({DAY}, 6, 2), '/', substr({DAY}, 9, 2), '/', substr({DAY}, 1, 4))"
DAY_FIRST_DATE = f"concat(substr({DAY}, 9, 2), '/', substr({DAY}, 6, 2), '/', substr({DAY}, 1, 4))"
SHOWN_DATE = case((f"substr({DAY}, 9, 2) > '12' AND (k + i) % 4 = 1", DAY_FIRST_DATE), default=US_DATE)
SLIC = case(("(k + i) % 5 = 0", "'SLIC '"))
ZONE = case(
    (TBD, "'TBD'"),
    (f"{KIND} = 1", f"concat({STREET}, ' ', {ROAD}, ' ', {SUITE}, ' ', {SLIC}, {CITY}, ', ', {STATE}, ' ', {ZIP})"),
    (
        f"{KIND} = 2",
        f"concat({STREET}, ' ', {ROAD}, ' Building A ', {case(('(c + i) % 3 = 0', chr(39) + 'Driver Work ' + chr(39)))}, {CITY}, ', ', {STATE}, ' ', {ZIP})",
    ),
    (f"{KIND} = 3", f"concat({STREET}, ' Trail ', {SLIC}, {ONE_WORD_CITY}, ', ', {STATE}, ' ', {ZIP})"),
    (f"{KIND} = 4", f"concat({STREET}, ' ', {ROAD}, ' Big Town, ', {STATE}, ' see ', {ZIP})"),
    (f"{KIND} = 5", f"concat({STREET}, ' ', {ROAD}, ' ', {CITY}, ', ', lower({STATE}), ' ', {ZIP}, {case((f'NOT {CUT_OFF}', chr(39) + ' C33PS' + chr(39)))})"),
    default=f"concat({STREET}, ' ', {ROAD}, ' ', {SLIC}, {CITY}, ', ', {STATE}, ' N/A ', {ZIP})",
)
STOP_TEXT = f"""concat(
    {pick('## ||### ', 'k + i')}, 'Stop ', i, {case(("(k + i) % 4 = 3", "' : '"), default="': '")},
    {case((PICKUP, pick('Pick Up|PickUp|pick up', 'c + i')), default="'Delivery'")}, ' ~~eee~~ \\n',
    'Numbers 1162 Scheduled For ',
    {case((NO_TIME, "'later '"), default=f"concat({pick('Mon|Tue|Wed|Thu|Fri|Sat|Sun', 'k + i')}, ' ', {SHOWN_DATE}, ' Confirmation None ', " + case((RANGE, f"concat('from ', {pad(HOUR, 2)}, ':00 - ', {pad(HOUR + ' + 5', 2)}, ':30')"), default=f"concat('at ', {HOUR}, ':15')") + ", ' ')")},
    'Numbers ~~|~~ ', {case(("(k + i) % 7 = 3", "'Facility Notes dock 4 '"))},
    {case((NO_FACILITY, "''"), default=f"concat('Facility ', {NAME}, ' ', " + case(("(c + i) % 2 = 0", "'Driver Work No Touch '")) + ")")},
    {case((COLLAPSED, "'\\nContact None\\n'"), (CUT_OFF, f"concat('Address ', {ZONE})"), default=f"concat('Address ', {ZONE}, ' \\nContact None Phone +1 (555) 010 2707\\n## Facility Notes\\nFood Grade Trailer Required\\n')")})"""

# --- header of layout CY ------------------------------------------------------------

NO_DESK = "(k % 5 = 0)"  # no Booked By block
SILENT_DESK = "(k % 5 = 1)"  # a block without contact values
DEFAULT_EMAIL = "CarrierInvoices@" + rs.CY_DOMAIN
DEFAULT_PHONE = rs.CY_BROKER[1].default
CONTACT_LINE = rs.CY_BROKER[1].text_patterns[0].split(r"\s")[0]

AGENT_EMAIL = f"('agent' || {S('k')} || '@{rs.CY_DOMAIN}')"
AGENT_PHONE = f"('+1 (555) 011 ' || {pad('c % 10000', 4)} || ' x' || {S('k % 100')})"
DESK_PHONE = f"('800-555-' || {pad('k % 10000', 4)})"
CARRIER_NAME = f"('HAUL ' || {S('c')} || ' LLC')"
CARRIER_EMAIL = f"('dispatch' || {S('c')} || '@haul' || {S('c % 7')} || '.example')"
AMOUNT = S("price")

HEADER_TRUTH = {
    "broker_name": f"'{rs.CY_NAME}'",
    "broker_phone": case((NO_DESK, f"'{DEFAULT_PHONE}'"), (SILENT_DESK, DESK_PHONE), default=AGENT_PHONE),
    "broker_fax": case((f"{NO_DESK} OR {SILENT_DESK} OR k % 3 = 0", "''"), default="'+1 (555) 012 4891'"),
    **{f: f"'{v}'" for f, v in rs.CY_OFFICE.items()},
    "broker_email": case((f"{NO_DESK} OR {SILENT_DESK}", f"'{DEFAULT_EMAIL}'"), default=AGENT_EMAIL),
    "loadConfirmationNumber": S("k"),
    "totalCarrierPay": case(("k % 4 = 3", "''"), default=AMOUNT),
    "carrier_name": CARRIER_NAME,
    "carrier_mc": S("c"),
    **{f"carrier_{f}": "''" for f in ("address", "city", "state", "zipcode", "phone", "fax")},
    "carrier_email": case(("k % 6 = 0", "''"), default=CARRIER_EMAIL),
}
# an empty document has no value at all
HEADER_TRUTH = {f: case((EMPTY, "''"), default=v) for f, v in HEADER_TRUTH.items()}

NOISE = "k % 7"
HEADER_TEXT = f"""concat(
    'Load Confirmation\\nLoad ', k, ' sheet 1\\n',
    {case(("k % 31 = 5", "' Stop 99: Delivery draft Address none\\n'"))},
    {case((SILENT_DESK, f"concat('{CONTACT_LINE} ', {DESK_PHONE}, ' today\\n')"))},
    {case(("k % 4 = 0", "concat('Total USD $', format_number(price, 2))"), ("k % 4 = 1", "concat('Line Haul USD $ ', format_number(price, 2))"), ("k % 4 = 2", "concat('Total $ ', format_number(price, 2))"), default="'Rate pending'")},
    '\\n\\n\\n\\n',
    {case((NO_DESK, "''"), (SILENT_DESK, "'## Booked By\\nDesk agent\\n'"), default=f"concat('## Booked By\\nAgent One ', {AGENT_EMAIL}, ' Phone: ', {AGENT_PHONE}, '\\nFax: ', " + case(("k % 3 = 0", "'None'"), default="'+1 (555) 012 4891'") + ", '\\n')")},
    '## Carrier\\nCarrier Legal Name - ', {CARRIER_NAME}, ' [active]\\nCarrier USDOT - ', c, '\\n',
    {case(("k % 6 = 0", "''"), default=f"concat('Carrier desk Email ', {CARRIER_EMAIL}, '\\n')")})"""

# Spacing noise by order: bold marks, CR or CRLF line ends, NBSP, double spaces, tabs; at most one kind each.
NOISY = """CASE k % 7 WHEN 6 THEN replace({t}, 'Load ', '**Load** ')
    WHEN 2 THEN replace({t}, '\\n', '\\r') WHEN 3 THEN replace({t}, '\\n', '\\r\\n')
    WHEN 1 THEN replace({t}, ' ', '\\u00A0') WHEN 4 THEN replace({t}, ' ', '  ') WHEN 5 THEN replace({t}, ' ', '\\t')
    ELSE {t} END"""

CY_FOLDER = "/lake/raw/cy/txt_pymupdf4llm/"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table dealt out evenly: rendered text is many times larger than the row it comes from."""
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "orders")
    return table.selectExpr(*[f"{e} AS {n}" for n, e in ORDER.items()])


def per_stop(body: str, n: str = N) -> str:
    """SQL array with body evaluated for i = 1..n."""
    return f"CASE WHEN {n} > 0 THEN transform(sequence(1, {n}), i -> {body}) ELSE array() END"


def confirmations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout CY: source_file, text and the order columns."""
    return render(orders(spark, sf_dir).withColumn("folder", F.lit("")))


# A second copy of the low-priority documents, one unit dearer, found first by path.
RESENT = "priority = '5-LOW'"
RESENT_FOLDER = "-resent/"


def confirmations_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = f"CASE WHEN {RESENT} THEN array('', '{RESENT_FOLDER}') ELSE array('') END"
    base = orders(spark, sf_dir).withColumn("folder", F.explode(F.expr(folders)))
    dearer = F.expr("CAST(price + CASE WHEN folder = '' THEN 0 ELSE 1 END AS DECIMAL(18,2))")
    return render(base.withColumn("price", dearer))


def render(base: DataFrame) -> DataFrame:
    raw = base.withColumn("raw", F.expr(f"concat({HEADER_TEXT}, array_join({per_stop(STOP_TEXT)}, ''))"))
    text = f"CASE WHEN k % 58 = 0 THEN NULL WHEN {EMPTY} THEN '' ELSE {NOISY.format(t='raw')} END"
    return raw.select(
        "*",
        canonical_path(F.expr(f"concat('dbfs:{CY_FOLDER}', folder, k, '.txt')"), PATH_STEPS["current"]).alias("source_file"),
        F.expr(text).alias("text"),
    ).drop("raw")


def _truth(base: DataFrame, header: dict, stop: dict, pickup: str, valid: str, n: str) -> DataFrame:
    fields = ", ".join(f"'{f}', {e}" for f, e in stop.items())
    body = f"named_struct('type', CASE WHEN {pickup} THEN 'pickup' ELSE 'delivery' END, 'valid', {valid}, {fields})"
    base = base.withColumn("stops", F.expr(per_stop(body, n)))
    for t in rs.ONE_AND_TWO:
        base = base.withColumn(t, F.expr(f"filter(stops, s -> s.valid AND s.type = '{t}')"))
    values = {
        **header,
        **{
            f"{t}_{f}_{k}": f"coalesce(get({t}, {k - 1}).{f}, '')"
            for t, cap in rs.ONE_AND_TWO.items()
            for k in range(1, cap + 1)
            for f in stop
        },
    }
    return base.selectExpr(
        "concat('/lake/raw/cy/pdf/', k, '.pdf') AS source_file", *[f"{values[f]} AS {f}" for f in rs.CY.fields]
    )


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth rows for layout CY, keyed by load number; every order is expected."""
    header = {**HEADER_TRUTH, "loadConfirmationNumber": S("k")}
    return _truth(orders(spark, sf_dir), header, STOP_TRUTH, PICKUP, f"NOT {COLLAPSED}", N)


# --- layout UTB -----------------------------------------------------------------------

UTB_PICKUPS = "CAST(k % 5 AS INTEGER)"
UTB_DELIVERIES = "CAST(c % 5 AS INTEGER)"
UNNUMBERED = "(k % 9 = 4)"  # plain type words instead of numbered markers
NO_INVOICE = "(k % 11 = 3)"
NO_CARRIER = "(k % 13 = 5)"
UTB_BROKER = "USA Truck Brokers Inc."
UTB_STREET = f"({S('100 + c % 900')} || ' NW ' || {S('k % 90')} || ' Court Suite ' || {S('k % 300')})"
UTB_MAIL = f"('a' || {S('c')} || '@usatruckbrokers.com; z' || {S('k')} || '@usatruckbrokers.com')"
UTB_TEL = f"('305-555-' || {pad('k % 10000', 4)})"

UTB_HEADER_TRUTH = {
    "broker_name": case((NO_INVOICE, "''"), default=f"'{UTB_BROKER}'"),
    "broker_phone": case((NO_INVOICE, "''"), default=UTB_TEL),
    "broker_fax": case((NO_INVOICE, "''"), default="'305-555-0146'"),
    "broker_address": case((NO_INVOICE, "''"), default=UTB_STREET),
    "broker_city": case((NO_INVOICE, "''"), default="'Miami Lakes'"),
    "broker_state": case((NO_INVOICE, "''"), default="'FL'"),
    "broker_zipcode": case((NO_INVOICE, "''"), default=ZIP5.replace("i * 101", "7")),
    "broker_email": case((NO_INVOICE, "''"), default=UTB_MAIL),
    "loadConfirmationNumber": f"('T-' || {S('k')})",
    "totalCarrierPay": case(("k % 4 = 3", "''"), default=AMOUNT),
    "carrier_name": CARRIER_NAME,
    "carrier_mc": S("1000 + c"),
    "carrier_address": f"('120 9th st #' || {S('c')})",
    "carrier_city": "'SAN ANTONIO'",
    "carrier_state": "'TX'",
    "carrier_zipcode": "'78215'",
    "carrier_phone": f"('555-013-' || {pad('c % 10000', 4)})",
    "carrier_fax": case(("k % 2 = 0", "'305-100-2000'")),
    "carrier_contact": "'Ann Arbor (dispatcher'",
}
UTB_HEADER_TRUTH = {
    f: case((NO_CARRIER, "''"), default=v) if f.startswith("carrier_") else v for f, v in UTB_HEADER_TRUTH.items()
}

UTB_CUSTOMER = {
    "pickup": f"({pick('ACME|DINGLEY PRESS|A&B MILLS', 'c + i')} || ' ' || {S('i')})",
    "delivery": f"({pick('YBOR|WEST DC|P-DEPOT', 'k + i')} || ' ' || {S('i')})",
}
UTB_TOWN = pick("TAMPA|LEWISTON|WEST PALM BEACH", "k + i")
CLOCK_START = f"({pad(HOUR, 2)} || ':00' || {case(('k % 2 = 0', chr(39) + ':00' + chr(39)))})"
CLOCK_END = f"({pad(HOUR + ' + 2', 2)} || ':30' || {case(('k % 2 = 0', chr(39) + ':00' + chr(39)))})"


def utb_stop_truth(kind: str) -> dict:
    undated = f"({UNNUMBERED})" if kind == "delivery" else "(1 = 0)"
    when = lambda clock: case((undated, "''"), default=f"{DAY} || 'T' || {clock}")
    return {
        "customer": UTB_CUSTOMER[kind],
        "address": f"{STREET} || ' ST'",
        "city": UTB_TOWN,
        "state": STATE,
        "zipcode": ZIP5,
        "start_datetime": when(f"{pad(HOUR, 2)} || ':00:00'"),
        "end_datetime": when(f"{pad(HOUR + ' + 2', 2)} || ':30:00'"),
    }


def _utb_stop(kind: str) -> str:
    word = kind.title()
    date_label = "'PickUp Date: '" if kind == "pickup" else case(("k % 3 = 0", "'Del. Date: '"), default="'Delivery Date: '")
    place = f"concat('City: ', {UTB_TOWN}, ', ', {STATE}, '\\nZip Code: ', {ZIP5}, '\\n')"
    numbered = f"""concat('{word} # ', i, '\\nCustomer: ', {UTB_CUSTOMER[kind]}, '\\n', {date_label}, {US_DATE},
        '\\nAddress #1: ', {STREET}, ' ST\\n{word} Time: ', {CLOCK_START}, ' - ', {CLOCK_END}, '\\n', {place})"""
    dated = f"concat('Pick Date: ', {US_DATE}, '\\nTime: ', {CLOCK_START}, ' - ', {CLOCK_END}, '\\n')" if kind == "pickup" else "''"
    plain = f"""concat('{word}\\nCustomer: ', {UTB_CUSTOMER[kind]}, '\\nAddress #1: ', {STREET}, ' ST\\n(dock 4)\\n', {dated}, {place})"""
    return case((UNNUMBERED, plain), default=numbered)


UTB_TEXT = f"""concat('**Trip #:** T-', k, '\\n\\n',
    array_join({per_stop(_utb_stop('pickup'), UTB_PICKUPS)}, ''),
    array_join({per_stop(_utb_stop('delivery'), UTB_DELIVERIES)}, ''),
    'Special Instructions none\\n',
    {case((NO_INVOICE, "''"), default=f"concat('Send Invoice to:\\n{UTB_BROKER}\\n  ', {UTB_STREET}, '\\nMiami Lake,s, FL ', {ZIP5.replace('i * 101', '7')}, '\\nTel: ', {UTB_TEL}, ' Fax: 305-555-0146\\nz', k, '@usatruckbrokers.com a', c, '@usatruckbrokers.com z', k, '@usatruckbrokers.com\\n')")},
    {case(("k % 4 = 3", "'Total pending\\n'"), ("k % 4 = 1", "concat('Total To Pay: $', format_number(price, 2), '\\n')"), default="concat('Total Carrier Pay: $', format_number(price, 2), '\\n')")},
    {case((NO_CARRIER, "''"), default=f"concat('Truck VIN Number 1 Trailer VIN Number 2\\nCarrier ', {CARRIER_NAME}, '\\nMC #: ', 1000 + c, '\\nAddress: 120 9th st #', c, '\\nCity: SAN ANTONIO, TX 78215\\nPhone: 555-013-', {pad('c % 10000', 4)}, '\\nFax: ', {case(('k % 2 = 0', chr(39) + '305-100-2000' + chr(39)))}, ' \\nContact: Ann Arbor (dispatcher\\n')")},
    'Please Sign\\n')"""


def utb_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout UTB with numbered or plain stop markers."""
    return orders(spark, sf_dir).selectExpr(
        "*", "concat('/lake/raw/utb/', k, '.txt') AS source_file", f"{UTB_TEXT} AS text"
    )


# --- flat layout UTB --------------------------------------------------------------------

FLAT_PICKUPS = "CAST(k % 3 AS INTEGER)"
FLAT_DELIVERIES = "CAST(c % 4 AS INTEGER)"
FLAT_HEADER_TRUTH = {
    "broker_name": f"'{UTB_BROKER}'",
    "broker_phone": UTB_TEL,
    "broker_fax": "'305-555-0146'",
    # the address ends at the first space
    "broker_address": S("100 + c % 900"),
    "broker_city": f"('NW ' || {S('k % 90')} || ' Court Miami Lakes')",
    "broker_state": "'FL'",
    "broker_zipcode": "'33016'",
    "broker_email": UTB_MAIL,
    "loadConfirmationNumber": S("k"),
    "totalCarrierPay": case(("k % 4 = 3", "''"), default=AMOUNT),
    "carrier_name": f"('HAUL ' || {S('c')})",
    "carrier_mc": S("1000 + c"),
    "carrier_address": "'120 9th st'",
    "carrier_city": "'SAN ANTONIO'",
    "carrier_state": "'TX'",
    "carrier_zipcode": "'78215'",
    "carrier_phone": f"('555-013-' || {pad('c % 10000', 4)})",
    "carrier_fax": "''",
    "carrier_contact": "'Ann Arbor'",
}
FLAT_STOP_TRUTH = {
    kind: {
        **utb_stop_truth(kind),
        # a clock without seconds is not accepted
        "start_datetime": case(("k % 2 = 0", f"{DAY} || 'T' || {pad(HOUR, 2)} || ':00:00'")),
        "end_datetime": case(("k % 2 = 0", f"{DAY} || 'T' || {pad(HOUR + ' + 2', 2)} || ':30:00'")),
    }
    for kind in ("pickup", "delivery")
}


def _flat_stop(label: str, kind: str) -> str:
    return f"""concat('{label}  # ', i, '\\nCustomer: ', {UTB_CUSTOMER[kind]}, '\\n{label} Date: ', {US_DATE}, ' Ref 9\\n',
        'Address # 1: ', {STREET}, ' ST\\t{label} Time: ', {CLOCK_START}, ' - ', {CLOCK_END}, '\\nContact: desk\\n',
        'City: ', {UTB_TOWN}, ', ', {STATE}, ' US\\nZip Code: ', {ZIP5}, '\\n')"""


FLAT_TEXT = f"""concat('*Trip #:* ', k, '\\n{UTB_BROKER}\\n', 100 + c % 900, ' NW ', k % 90, ' Court\\nMiami Lakes, FL  33016\\n',
    'Tel: ', {UTB_TEL}, '\\nFax: 305-555-0146\\nZ', k, '@usatruckbrokers.com a', c, '@usatruckbrokers.com\\n',
    'Carrier HAUL ', c, '\\nMC # ', 1000 + c, '\\nAddress 120 9th st\\nCity SAN ANTONIO, TX   78215\\nPhone 555-013-', {pad('c % 10000', 4)},
    '\\nContact Ann Arbor\\nService none\\n',
    array_join({per_stop(_flat_stop('PickUp', 'pickup'), FLAT_PICKUPS)}, ''),
    array_join({per_stop(_flat_stop('Delivery', 'delivery'), FLAT_DELIVERIES)}, ''),
    {case(("k % 4 = 3", "'Total pending'"), default="concat('Total To Pay: $', format_number(price, 2))")}, '\\n')"""
# upper case sorts first, then the joined list is lower-cased
FLAT_HEADER_TRUTH["broker_email"] = f"('z' || {S('k')} || '@usatruckbrokers.com; a' || {S('c')} || '@usatruckbrokers.com')"


def flat_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).selectExpr(
        "*", "concat('/lake/raw/utb_flat/', k, '.txt') AS source_file", f"{FLAT_TEXT} AS text"
    )


# --- plain layout CY for scoring rule-set generations -----------------------------------

PLAIN_STOPS = "CAST(2 + k % 2 AS INTEGER)"  # one pickup, then one or two deliveries
PLAIN_PICKUP = "(i = 1)"
PLAIN_OAK = f"({NUMBER} || ' OAK')"
PLAIN_FORMS = [  # shown in the document, true address, true city; by k % 4
    ("' RD Lakeland, FL '", "' RD'", "Lakeland"),
    ("' RD SLIC Plant City, FL '", "' RD'", "Plant City"),
    ("' RD SUITE 9 Lakeland, FL '", "' RD SUITE 9'", "Lakeland"),
    ("' Plant City, FL '", "''", "Plant City"),
]


def _by_form(n: int, quote: str = "") -> str:
    return case(*[(f"k % 4 = {f}", f"{quote}{form[n]}{quote}") for f, form in enumerate(PLAIN_FORMS)])


PLAIN_STOP_TRUTH = {
    "customer": "'United Mills'",
    "address": f"{PLAIN_OAK} || {_by_form(1)}",
    "city": _by_form(2, "'"),
    "state": "'FL'",
    "zipcode": ZIP5,
    "start_datetime": f"{DAY} || 'T' || {pad(HOUR, 2)} || ':00:00'",
    "end_datetime": f"{DAY} || 'T' || " + case((PLAIN_PICKUP, f"{pad(HOUR + ' + 5', 2)} || ':30:00'"), default=f"{pad(HOUR, 2)} || ':00:00'"),
}
PLAIN_HEADER_TRUTH = {
    **HEADER_TRUTH,
    "broker_name": f"'{rs.CY_NAME}'",
    "broker_phone": AGENT_PHONE,
    "broker_fax": "'+1 (555) 012 4891'",
    **{f: f"'{v}'" for f, v in rs.CY_OFFICE.items()},
    "broker_email": AGENT_EMAIL,
    "loadConfirmationNumber": S("k"),
    "totalCarrierPay": AMOUNT,
    "carrier_name": CARRIER_NAME,
    "carrier_mc": S("c"),
    **{f"carrier_{f}": "''" for f in ("address", "city", "state", "zipcode", "phone", "fax")},
    "carrier_email": CARRIER_EMAIL,
}
_PLAIN_STOP = f"""concat('Stop ', i, ': ', {case((PLAIN_PICKUP, "'Pick Up'"), default="'Delivery'")},
    '\nScheduled For Wed ', {US_DATE}, ' ', {case((PLAIN_PICKUP, f"concat('from ', {pad(HOUR, 2)}, ':00 - ', {pad(HOUR + ' + 5', 2)}, ':30')"), default=f"concat('at ', {pad(HOUR, 2)}, ':00')")},
    ' Facility United Mills Address ', {PLAIN_OAK}, {_by_form(0)}, {ZIP5}, ' \nContact None Phone 1\n')"""
PLAIN_TEXT = f"""concat('Load ', k, '\n', '{" ".join(rs.CY_OFFICE[f] for f in ("broker_address", "broker_city"))}, GA 30005\n',
    'Line Haul USD $ ', format_number(price, 2), '\n## Booked By\nAgent ', {AGENT_EMAIL}, ' Phone: ', {AGENT_PHONE},
    '\nFax: +1 (555) 012 4891\n## Carrier\nCarrier Legal Name - ', {CARRIER_NAME}, ' [active]\nCarrier USDOT - ', c,
    '\nCarrier desk Email ', {CARRIER_EMAIL}, '\n', array_join({per_stop(_PLAIN_STOP, PLAIN_STOPS)}, ''))"""


def plain_confirmations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).selectExpr(
        "*", "concat('/lake/raw/cy/pdf/', k, '.pdf') AS source_file", f"{PLAIN_TEXT} AS text"
    )


def plain_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _truth(
        orders(spark, sf_dir), PLAIN_HEADER_TRUTH, PLAIN_STOP_TRUTH, PLAIN_PICKUP, "true", PLAIN_STOPS
    )

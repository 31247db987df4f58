"""Rule sets as data. All patterns, constants and word lists below are fixed values:
they state what the documents look like, so that results agree."""

from __future__ import annotations

from functools import partial

from ..functions import text as tx
from ..operators.extract import Computed, Fallback, Group, Parts, Rule, Ruleset
from ..operators.segment import Splitter
from ..operators.stops import FIELDS, BlockStop, Facility, Geo, LabelledStop, NumberedStop, ScheduledTimes, Times
from ..sources.documents import Reader

BROKER = tuple(f"broker_{f}" for f in ("name", "phone", "fax", "address", "city", "state", "zipcode", "email"))
CARRIER = tuple(f"carrier_{f}" for f in ("name", "mc", "address", "city", "state", "zipcode", "phone", "fax"))


def fields(last: str, pickups: int, deliveries: int) -> tuple:
    """Wide column order: broker, load, carrier, then the stop slots."""
    stops = [f"{t}_{f}_{k}" for t, n in (("pickup", pickups), ("delivery", deliveries)) for k in range(1, n + 1) for f in FIELDS]
    return (*BROKER, "loadConfirmationNumber", "totalCarrierPay", *CARRIER, last, *stops)


# --- vendor CY: header ------------------------------------------------------------

CY_DOMAIN = "coyote.com"
CY_NAME = "Coyote Logistics, LLC"
CY_OFFICE = {
    "broker_address": "960 Northpoint Parkway Suite 150",
    "broker_city": "Alpharetta",
    "broker_state": "GA",
    "broker_zipcode": "30005",
}
PHONE_LIKE = r"([+\d\s()\-xX]+)"

CY_LOAD = Rule("loadConfirmationNumber", (r"Load\s+(\d+)",))
CY_BROKER = (
    Rule("broker_email", (r"([\w.\-]+@coyote\.com)",), "booked_by", default="CarrierInvoices@coyote.com"),
    Fallback("broker_phone", "booked_by", r"Phone:\s*" + PHONE_LIKE, (r"Please contact Coyote at\s+([\d\-]+)",), "877-626-9683"),
    Rule("broker_fax", (r"Fax:\s*" + PHONE_LIKE,), "booked_by"),
)
CY_CARRIER = (
    Rule("carrier_name", (r"Carrier Legal Name\s*-\s*([^\[\]\n]+)",)),
    Rule("carrier_mc", (r"Carrier USDOT\s*-\s*(\d+)",)),
)
CY_CARRIER_EMAIL = Computed("carrier_email", partial(tx.first_email_outside, domain=CY_DOMAIN))
CY_PAY = Rule(
    "totalCarrierPay",
    (r"Total\s+USD\s*\$?\s*([\d,]+\.\d{2})", r"USD\s*\$\s*([\d,]+\.\d{2})", r"Total\s+\$\s*([\d,]+\.\d{2})"),
    clean="money",
)
CY_HEADER = (CY_LOAD, *CY_BROKER, *CY_CARRIER, CY_CARRIER_EMAIL, CY_PAY)

# first generation
CY1_PAY = Rule(
    "totalCarrierPay",
    (r"USD\s*\$\s*([\d,]+\.\d{2})", r"Total\s+\$([\d,]+\.\d{2})", r"Amount\s+\$([\d,]+\.\d{2})"),
    clean="money",
)
CY1_OFFICE = Group(
    tuple(CY_OFFICE), r"(\d+\s+Northpoint\s+Parkway\s+Suite\s+\d+)\s+([A-Za-z]+),\s*([A-Z]{2})\s*(\d{5})"
)
CY1_CARRIER = (
    Rule("carrier_name", (r"Carrier Legal Name\s*-\s*([A-Z0-9 &.\-]+)",)),
    Rule("carrier_mc", (r"Carrier USDOT\s*-\s*(\d+)",)),
    Rule("carrier_email", (r"Carrier\s+.*?Email\s+([\w.\-]+@[\w.\-]+)",), flags="is"),
)
CY2_OFFICE = Group(
    tuple(CY_OFFICE),
    r"(960\s+Northpoint\s+(?:Parkway|Pkwy)(?:\s+Suite\s+\d+)?)\s+([A-Za-z\s]+),\s*([A-Z]{2})\s+(\d{5})",
    flags="is",
)

# --- vendor CY: stops -------------------------------------------------------------

WEEKDAYS = "Mon|Tue|Wed|Thu|Fri|Sat|Sun"
# the first letters as a plain class, with the long s that is an s to a pattern that ignores case; then the rest of each word
DATE = (
    r"(?-i:[MmTtWwFfSs\u017F])(?:(?<=M)on|(?<=T)(?:ue|hu)|(?<=W)ed|(?<=F)ri|(?<=S)(?:at|un))"
    r"\s+(\d{2}/\d{2}/\d{4})"
)
CY_TIMES = Times(
    date=DATE,
    range=r"from\s+(\d{1,2}:\d{2})\s*-\s*(\d{1,2}:\d{2})",
    at=r"at\s+(\d{1,2}:\d{2})",
)
CY1_TIMES = ScheduledTimes(
    date=r"Scheduled For\s+([A-Za-z ]+)?(\d{2}/\d{2}/\d{4})",
    range=r"(?:from|at)\s*([\d:]+)\s*(?:-\s*([\d:]+))?",
    at=r"(?:from|at)\s*([\d: \-]+(?:AM|PM)?)",
    shapes=("24h", "12h"),
)

NOTES_COLUMN = (r"(?:Notes\s+Numbers.*|Notes\s+-.*|Numbers\s+\d+.*)", "", "i")
ARTEFACT = (r"~~\S+~~", "", "")
CONFIRMATION = (r"\s*>?\s*Confirmation\b.*", "", "i")
NO_TOUCH = (r"\s*No\s+Touch\b.*", "", "i")
LUMPER = (r"\s*Lumper\b.*", "", "i")
DRIVER_WORK = (r"\s*Driver\s+Work\b", " ", "i")
LOWER_CASE_TAIL = (r"\s+[a-z].*", "", "")
NOTES_ONLY = (r"\ANotes\b.*", "", "is")

EARLY_ENDS = rf"Driver\s+Work|Address|SLIC|Contact|Phone|Notes|Numbers|{WEEKDAYS}|\|"
LATE_ENDS = rf"Address|SLIC|Contact|Phone|Notes|Facility|Numbers|No\s+Touch|Confirmation|>|{WEEKDAYS}|\|"
EARLY_FACILITY = rf"Facility\s+(.+?)(?=\s+(?:{EARLY_ENDS}))"
LATE_FACILITY = rf"Facility\s+(.+?)(?=\s+(?:{LATE_ENDS}))"

FACILITY_1 = Facility(
    r"Facility\s+([A-Z0-9\s&,.\-]+?)(?=\s+Driver|\s+Address|\s+Contact|$)", None, (), tidy=False
)
FACILITY_2 = Facility(EARLY_FACILITY, None, (ARTEFACT,))
FACILITY_3 = Facility(EARLY_FACILITY, None, (NOTES_COLUMN, ARTEFACT))
FACILITY_4 = Facility(LATE_FACILITY, None, (NOTES_COLUMN, ARTEFACT, CONFIRMATION, NO_TOUCH, DRIVER_WORK))
FACILITY_5 = Facility(
    LATE_FACILITY,
    r"Notes\b",
    (NOTES_COLUMN, ARTEFACT, CONFIRMATION, NO_TOUCH, LUMPER, DRIVER_WORK, None, LOWER_CASE_TAIL, None, NOTES_ONLY),
)

# STACEY and FRCO close the address zone in documents seen so far.
ZONE = r"Address\s+(.+?)(?=\s+(?:Contact|Phone|Facility\s+Notes|STACEY|FRCO|$))"
OPERATIONAL = (
    # word boundaries are looked at only behind the first letter
    (r"[N](?<=\b[N])/A\b", "", "i"),
    (r"Driver\s+Work", "", "i"),
    (r"No\s+Touch", "", "i"),
    (r"Lumper", "", "i"),
    (r"~~\S+~~", "", ""),
)
SLIC_WORD = (r"\bSLIC\b", "", "i")
SLIC_AND_CODE = (r"SLIC\s*(?:N/A|\S+)?", "", "i")
ROAD = r"^(.+?\b(?:RD|DR|AVE|ST|BLVD|HWY|WAY|CT|PKWY|LN|PL|TER|CIR|LOOP|RTE|SQ|FWY|BYP)\b\.?)\s+([A-Za-z].+)$"

GEO_1 = Geo(
    "labelled",
    place=r"Address\s+(.+?)\s+SLIC\s+([A-Za-z\s]+),\s*([A-Z]{2})(?:\s+N/A)?\s*(\d{5}(?:-\d{4})?)",
)
GEO_2 = Geo(
    "run",
    ZONE,
    (SLIC_AND_CODE, *OPERATIONAL),
    place=r"^(.*?)\s+([A-Za-z][A-Za-z\s\-.]+?),\s*([A-Z]{2})\s+(\d{5}(?:-\d{4})?)",
)
GEO_3 = Geo(
    "last_two",
    ZONE,
    (SLIC_AND_CODE, *OPERATIONAL),
    place=r"^(.*?)\s+([A-Za-z\s\-.]+?),\s*([A-Z]{2})\s+(\d{5}(?:-\d{4})?)",
)
GEO_4 = Geo("last_word", ZONE, (SLIC_WORD, *OPERATIONAL))
GEO_5 = Geo("road", ZONE, (SLIC_WORD, *OPERATIONAL), road=ROAD)

THREE_EACH = {"pickup": 3, "delivery": 3}
ONE_AND_TWO = {"pickup": 1, "delivery": 2}


def _cy(version: int, header, constants, splitter, stop, caps, stamp=None, reader=Reader()) -> Ruleset:
    return Ruleset(
        f"cy_{version}",
        "blocks",
        fields("carrier_email", caps["pickup"], caps["delivery"]),
        header,
        constants,
        splitter,
        stop,
        caps,
        stamp,
        reader,
    )


CY_1 = _cy(
    1,
    (CY_LOAD, *CY_BROKER, *CY1_CARRIER, CY1_PAY, CY1_OFFICE),
    {"broker_name": CY_NAME},
    Splitter("anywhere", caps=THREE_EACH),
    BlockStop(FACILITY_1, GEO_1, CY1_TIMES),
    THREE_EACH,
    "utc",
    Reader(binary=True, path_steps="any_folder", file_columns=True),
)
CY_2 = _cy(
    2,
    (*CY_HEADER, CY2_OFFICE),
    {"broker_name": CY_NAME},
    Splitter("line", caps=THREE_EACH),
    BlockStop(FACILITY_2, GEO_2, CY_TIMES),
    THREE_EACH,
    reader=Reader(binary=True, path_steps="no_file_prefix", encoded_path=False, file_columns=True),
)
CY_3 = _cy(
    3,
    CY_HEADER,
    {"broker_name": CY_NAME, **CY_OFFICE},
    Splitter("line", caps=THREE_EACH),
    BlockStop(FACILITY_3, GEO_3, CY_TIMES),
    THREE_EACH,
)
CY_4 = _cy(
    4,
    CY_HEADER,
    {"broker_name": CY_NAME, **CY_OFFICE},
    Splitter("line", caps=ONE_AND_TWO),
    BlockStop(FACILITY_4, GEO_4, CY_TIMES),
    ONE_AND_TWO,
)
CY_5 = _cy(
    5,
    CY_HEADER,
    {"broker_name": CY_NAME, **CY_OFFICE},
    Splitter("line", True, ONE_AND_TWO),
    BlockStop(FACILITY_5, GEO_5, CY_TIMES),
    ONE_AND_TWO,
)
CY = CY_5

# --- vendor UTB -------------------------------------------------------------------

# The labels of the carrier table in order, each with the least that the pattern below takes after it.
CARRIER_TABLE_GUARD = tx.in_order(
    r"Trailer VIN Number",
    r"Carrier\s+[A-Z0-9 &.\-]",
    r"MC\s*#[:\s]*\d",
    r"Address[:\s]*[0-9A-Za-z\s#.,\-]",
    r"City[:\s]*[A-Za-z\s]+,\s*[A-Z]{2}\s*\d{5}",
    r"Phone[:\s]*[\d\-\s()]",
    r"Fax[:\s]*",
    r"Contact[:\s]*[A-Za-z\s\-.,()]+?(?=\s*(?:Truck VIN Number|Trailer VIN Number|Total|Please Sign|$))",
)
US_PHONE = r"(\(?\d{3}\)?[-\s]?\d{3}[-\s]?\d{4})"
UTB_HEADER = (
    Rule("broker_name", (r"(USA Truck Brokers Inc\.?)",), "send_invoice"),
    Rule("broker_phone", (r"Tel[:\s]*" + US_PHONE,), "send_invoice"),
    Rule("broker_fax", (r"Fax[:\s]*" + US_PHONE,), "send_invoice"),
    Computed("broker_email", tx.emails_joined, "send_invoice"),
    Parts(
        ("broker_address", "broker_city", "broker_state", "broker_zipcode"),
        tx.invoice_address,
        "send_invoice",
        clean={"broker_address": "collapse"},
    ),
    Rule("loadConfirmationNumber", (r"Trip\s*#[:\s]*([A-Z0-9\-]+)",)),
    Rule("totalCarrierPay", (r"Total\s*(?:To\s*Pay|Carrier\s*Pay)[:\s$]*([\d,]+\.\d{2})",), clean="money"),
    Group(
        (*CARRIER, "carrier_contact"),
        r"Trailer VIN Number.*?Carrier\s+([A-Z0-9 &.\-]+).*?"
        r"MC\s*#[:\s]*(\d+).*?"
        r"Address[:\s]*([0-9A-Za-z\s#.,\-]+).*?"
        r"City[:\s]*([A-Za-z\s]+),\s*([A-Z]{2})\s*(\d{5}).*?"
        r"Phone[:\s]*([\d\-\s()]+).*?"
        r"Fax[:\s]*([\d\-\s()]*).*?"
        r"Contact[:\s]*([A-Za-z\s\-.,()]+?)(?=\s*(?:Truck VIN Number|Trailer VIN Number|Total|Please Sign|$))",
        flags="is",
        guard=CARRIER_TABLE_GUARD,
    ),
)
UTB_STOP = LabelledStop(
    {
        "pickup": {
            "customer": r"Customer[:\s]*([A-Z0-9 &.\-]+?)(?=\s*(?:Pick.?Up|Address|City|Zip|Phone|$))",
            "address": r"Address\s*#1[:\s]*([0-9A-Za-z.,#\-\s]+?)(?:\n|Pick(?:up)?\s*Time|$)",
            "place": r"City[:\s]*([A-Za-z\s]+),\s*([A-Z]{2})",
            "zipcode": r"Zip(?:\s*Code)?[:\s]*([0-9]{5})",
            "date": r"Pick(?:up)?\s*Date[:\s]*([0-9/]+)",
            "times": r"(?=[PT])(?:Pick(?:up)?\s*Time|Time)[:\s]*([0-9:]+)\s*-\s*([0-9:]+)",
        },
        "delivery": {
            "customer": r"Customer[:\s]*([A-Z0-9 &.\-]+?)(?=\s*(?:Delivery|Address|City|Zip|Phone|$))",
            "address": r"Address\s*#1[:\s]*([0-9A-Za-z.,#\-\s]+)",
            "place": r"City[:\s]*([A-Za-z\s]+),\s*([A-Z]{2})",
            "zipcode": r"Zip(?:\s*Code)?[:\s]*([0-9]{5})",
            "date": r"Delivery\s*Date[:\s]*([0-9/]+)",
            "times": r"(?=[DT])(?:Delivery\s*Time|Time)[:\s]*([0-9:]+)\s*-\s*([0-9:]+)",
        },
    },
    {"pickup": (), "delivery": ((r"\bDelivery\s*Time[:\s]*[0-9: -ETapm]*", "", "i"),)},
)
UTB = Ruleset(
    "utb",
    "lines",
    fields("carrier_contact", 3, 3),
    UTB_HEADER,
    splitter=Splitter("typed", caps=THREE_EACH),
    stop=UTB_STOP,
    caps=THREE_EACH,
    stamp="utc",
    reader=Reader(binary=True, path_steps="raw"),
)

LONG_NUMBER = r"([\d\-\s]{10,})"
# White space is single spaces in this layout. A gap takes any text, so what follows a later label follows the first one
# as well; a gap that has found the next label need not look for another one.
PLACE = r"\s+(.*?),\s+([A-Z]{2})\s+(\d{5})"
UTB_FLAT_HEADER = (
    Rule("loadConfirmationNumber", (r"Trip\s*#:\s*(\d+)",)),
    Rule("broker_name", (r"(USA Truck Brokers Inc\.)",), flags=""),
    Group(
        ("broker_address", "broker_city", "broker_state", "broker_zipcode"),
        tx.after_first(r"USA\s+Truck\s+Brokers\s+Inc\.(?=\s)", r"(?>\s+(.*?)(?=\s))" + PLACE),
    ),
    Rule("broker_phone", (r"Tel[:\s]*" + LONG_NUMBER,), clean="no_spaces"),
    Rule("broker_fax", (r"Fax[:\s]*" + LONG_NUMBER,), clean="no_spaces"),
    Computed("broker_email", partial(tx.emails_joined, fold=True)),
    # names are one run of these characters: the first label of a run, looked for from where the run begins
    Rule("carrier_name", (r"(?<![A-Z0-9\s])(?>[A-Z0-9\s]*?Carrier(?=\s))\s+([A-Z0-9\s]+?)\s+MC\s*#",)),
    Rule("carrier_mc", (r"MC\s*#?\s*(\d+)",)),
    Group(
        ("carrier_address", "carrier_city", "carrier_state", "carrier_zipcode"),
        tx.after_first(r"Address(?=\s)", r"(?>\s+(.*?)\s+City(?=\s))" + PLACE),
    ),
    Rule("carrier_phone", (r"Phone\s+" + LONG_NUMBER,), clean="no_spaces"),
    Rule("carrier_contact", (tx.after_first(r"Contact(?=\s)", r"\s+(.*?)\s+(?:Service|Notes|Payment)"),)),
    Rule("totalCarrierPay", (r"Total\s*To\s*Pay[:\s$]*([\d,.]+)",), clean="money"),
)
UTB_FLAT = Ruleset(
    "utb_flat",
    "flat",
    fields("carrier_contact", 1, 2),
    UTB_FLAT_HEADER,
    stop=NumberedStop(
        r"{label}\s*#\s*{number}\s+Customer:\s*(.*?)\s+{label}\s*Date:\s*([\d\-/]+).*?"
        r"Address\s*#\s*1:\s*(.*?)\s+{label}\s*Time:\s*([\d:]+)\s*-\s*([\d:]+).*?"
        r"City:\s*([^,:]+?),\s*([A-Z]{2})\s+.*?Zip\s*Code:\s*(\d{5})",
        {"pickup": "PickUp", "delivery": "Delivery"},
        guard=tx.in_order(
            r"{label}\s*#\s*{number}\s+Customer:",
            r"\s+{label}\s*Date:\s*[\d\-/]",
            r"Address\s*#\s*1:",
            r"\s+{label}\s*Time:\s*[\d:]+\s*-\s*[\d:]",
            r"City:\s*[^,:]+?,\s*[A-Z]{2}\s",
            r"Zip\s*Code:\s*\d{5}",
        ),
    ),
    caps=ONE_AND_TWO,
    stamp="local",
    reader=Reader(binary=True, path_steps="flat", glob="*", merge_schema=False),
)

RULESETS = {r.name: r for r in (CY_1, CY_2, CY_3, CY_4, CY_5, UTB, UTB_FLAT)}

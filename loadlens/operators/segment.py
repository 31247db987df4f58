"""Document -> sections -> stop blocks.

Blocks stay in an array on the document row, so ranking, capping and pivoting them
needs no shuffle; stops_long()/stops_ranked() explode the same arrays into rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import SEP, let, rx, strip

TYPES = ("pickup", "delivery")

# Section and stop markers. A leading (?=[...]) names the first letters of
# the alternatives that follow and only spares trying them at other positions.
PREFIX = r"(?:#{1,3}\s*)?"
LINE_HEADER = r"Stop\s+\d+\s*:\s*(?:Pick\s*Up|Delivery)"
LINE_PICKUP = r"Stop\s+\d+\s*:\s*Pick"
ANY_HEADER = r"Stop\s+\d+:\s*(?:Pick\s*Up|Delivery)"
LAST_BLOCK_END = r"(?=[CF])(?:Charges|Contact\s+None|Facility\s+Notes)"
# the first letters as a plain class, with the long s that is an s to a pattern that ignores case; then the rest of each word
TYPED_BLOCK_END = r"(?-i:[Ss\u017FTtPp])(?:(?<=S)(?:end Invoice|pecial Instructions)|(?<=T)otal|(?<=P)lease Sign)"
TYPED_FALLBACK_END = r"(?=(?:Pickup|Delivery|Send Invoice|Total|$))"
# the word boundary is looked at only behind the first letter
ADDRESS_WORD = r"[A](?<=\b[A])ddress\b"
BOOKED_BY = r"##\s*Booked\s+By\s*\n(.+?)(?=\n##|\z)"
SEND_INVOICE = r"Send Invoice to:(.*?)(?=Total Carrier Pay|Carrier\b|$)"

SECTIONS = {"booked_by": BOOKED_BY, "send_invoice": SEND_INVOICE}


@dataclass(frozen=True)
class Splitter:
    """How a layout marks its stops and how many of each type it keeps."""

    kind: str  # 'line', 'anywhere' or 'typed'
    require_address: bool = False
    caps: dict = field(default_factory=lambda: {"pickup": 3, "delivery": 3})


def section(text: Column, name: str) -> Column:
    """Named section of a normalised document, unstripped; '' if it is missing."""
    return F.regexp_extract(text, rx(SECTIONS[name], "is"), 1)


def _cut_at(text: Column, marker: str, kept: str) -> Column:
    """Pieces that start at the marker; the text before the first marker is left out."""
    pieces = F.split(F.regexp_replace(text, marker, SEP + kept), SEP)
    return F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1)))


def blocks(text: Column, splitter: Splitter) -> Column:
    """All stop blocks of a document in order, both types together."""
    if splitter.kind == "line":
        out = _cut_at(text, rx(f"^{PREFIX}({LINE_HEADER})", "im"), "$1\n")
    elif splitter.kind == "anywhere":
        found = _cut_at(text, rx(f"({ANY_HEADER})"), "$1")
        # only the last block is closed by the labels that follow the stops
        close = lambda b: F.regexp_replace(b, rx(LAST_BLOCK_END + ".*", "is"), "")
        out = let(
            found,
            lambda bs: F.transform(
                bs, lambda b, i: strip(F.when(i == F.size(bs) - 1, close(b)).otherwise(b))
            ),
        )
    else:
        raise ValueError(splitter.kind)
    return F.filter(out, has_address) if splitter.require_address else out


def has_address(block: Column) -> Column:
    return block.rlike(rx(ADDRESS_WORD))


def is_pickup(block: Column) -> Column:
    return block.rlike(rx(rf"\A{LINE_PICKUP}"))


def stop_type(block: Column) -> Column:
    return F.when(is_pickup(block), F.lit("pickup")).otherwise(F.lit("delivery"))


def stop_number(block: Column) -> Column:
    return F.coalesce(F.regexp_extract(block, r"(\d+)", 1).try_cast("int"), F.lit(0))


def typed_blocks(text: Column, kind: str) -> Column:
    """Blocks '<Type> # n' up to the next marker of the same type, cut at closing labels.

    Without any numbered marker, the plain type word starts a block.
    """
    label = kind.title()
    close = lambda b: strip(F.regexp_replace(b, rx(TYPED_BLOCK_END + ".*", "is"), ""))
    plain = F.regexp_extract_all(text, F.lit(rx(rf"{label}\b(.*?){TYPED_FALLBACK_END}", "is")), F.lit(1))
    return let(
        _cut_at(text, rx(rf"{label}\s*#\s*\d+"), ""),
        lambda numbered: F.when(F.size(numbered) > 0, F.transform(numbered, close)).otherwise(
            F.transform(plain, strip)
        ),
    )


def blocks_by_type(df: DataFrame, text: str, splitter: Splitter) -> DataFrame:
    """Adds one array column per stop type: pickup_blocks, delivery_blocks."""
    if splitter.kind == "typed":
        return df.withColumns({f"{t}_blocks": typed_blocks(F.col(text), t) for t in TYPES})
    df = df.withColumn("_blocks", blocks(F.col(text), splitter))
    return df.withColumns(
        {
            "pickup_blocks": F.filter("_blocks", is_pickup),
            "delivery_blocks": F.filter("_blocks", lambda b: ~is_pickup(b)),
        }
    ).drop("_blocks")


def stops_long(df: DataFrame, text: str, splitter: Splitter) -> DataFrame:
    """One row per stop: pos, type, number, text, plus the other columns of df."""
    keep = [c for c in df.columns if c != text]
    rows = df.select(*keep, F.posexplode(blocks(F.col(text), splitter)).alias("pos", "text"))
    return rows.select(
        *keep,
        (F.col("pos") + 1).alias("pos"),
        stop_type(F.col("text")).alias("type"),
        stop_number(F.col("text")).alias("number"),
        "text",
    )


def stops_ranked(df: DataFrame, text: str, splitter: Splitter) -> DataFrame:
    """One row per kept stop with its index rk among the stops of its type."""
    keep = [c for c in df.columns if c != text]
    by_type = blocks_by_type(df, text, splitter)

    def ranked(kind):
        item = lambda b, i: F.struct(F.lit(kind).alias("type"), (i + 1).alias("rk"), b.alias("text"))
        return F.transform(F.slice(f"{kind}_blocks", 1, splitter.caps[kind]), item)

    rows = by_type.select(*keep, F.inline(F.concat(*[ranked(t) for t in TYPES])))
    return rows.withColumn("number", stop_number(F.col("text")))

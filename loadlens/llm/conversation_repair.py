"""Conversation structure: faults, and the cheapest edits that give role initials (s?(ua)+)?.

Weighted interval parsing. The grammar is in Chomsky normal form; its symbols are N(p, q) for states p, q of the
role language: 0 nothing yet, S after the system turn, U after a user turn, A after an assistant turn.

    N(p, q) -> N(p, r) N(r, q)          every r
    N(p, q) -> one edited row           keep or rerole where the language goes from p to q, delete where p = q
    N(p, q) -> nothing                  at no cost where p = q, else by insertions

A cell of a span of rows holds, for every symbol, the least (cost, audit). Rows are closed under insertions on both
sides, and spans are combined bottom-up: one row, two, four, and so on. As a symbol names the states at both ends, every
split of a span gives the same cell, so one split is enough and a chart has two spans a row instead of all pairs of ends.
Audits of one span and one cost are never prefixes of each other (they differ in a row's edit, or in the number of
insertions and so in cost), so the least audit of a whole is made of least audits of its parts.

A conversation may hold any share of all rows: rows are dealt out by ranges of (conversation, turn), a task parses its
spans, and only cells meet. Texts move once, after the parse, and are streamed through their conversation's edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANK = " \t\n\u000b\f\r"
STATES = "0SUA"
#: Where an output turn of an initial leads from a state.
NEXT = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}
SYMBOLS = ("00", "0S", "0U", "0A", "SS", "SU", "SA", "UU", "UA", "AU", "AA")
RULES = tuple(
    (i, tuple((SYMBOLS.index(pq[0] + r), SYMBOLS.index(r + pq[1])) for r in STATES if pq[0] + r in SYMBOLS and r + pq[1] in SYMBOLS))
    for i, pq in enumerate(SYMBOLS)
)
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")

Cell = tuple  # of (cost, audit) or None, by symbol


def combined(left: Cell, right: Cell) -> Cell:
    """The cell of a span from those of its two parts."""
    out = []
    for _, splits in RULES:
        best = None
        for i, j in splits:
            a, b = left[i], right[j]
            if a is not None and b is not None:
                cost = a[0] + b[0]
                if best is None or cost < best[0]:
                    best = (cost, a[1] + b[1])
                elif cost == best[0]:
                    best = min(best, (cost, a[1] + b[1]))
        out.append(best)
    return tuple(out)


def _inserted() -> Cell:
    """The cell of no rows: insertions only, closed under concatenation."""
    cell = tuple((0, "") if p == q else (INSERT, "I") if (p, "u") in NEXT and NEXT[p, "u"] == q or (p, q) == ("U", "A") else None for p, q in SYMBOLS)
    while (longer := combined(cell, cell)) != cell:
        cell = longer
    return cell


INSERTED = _inserted()


def closed(cell: Cell) -> Cell:
    return combined(combined(INSERTED, cell), INSERTED)


def row_cell(initial: str, cut: bool) -> Cell:
    """The cell of a row that may stay: initial s, u, a or anything else; cut: truncated."""
    out = []
    for p, q in SYMBOLS:
        ways = [(DELETE, "D")] if p == q else []
        if NEXT.get((p, initial)) == q:
            ways.append((CUT * cut, "K"))
        if any(NEXT.get((p, r)) == q for r in ROLES):
            ways.append((REROLE + CUT * cut, "R"))
        out.append(min(ways, default=None))
    return closed(tuple(out))


def deleted_cell(n: int) -> Cell:
    """The cell of n rows that must go."""
    return closed(tuple((DELETE * n, "D" * n) if p == q else None for p, q in SYMBOLS))


class Chart:
    """Spans of falling length, each twice the next or more; two of one length are combined at once."""

    def __init__(self):
        self.spans = []

    def add(self, cell: Cell) -> None:
        size = 1
        while self.spans and self.spans[-1][0] <= size:
            length, before = self.spans.pop()
            cell, size = combined(before, cell), size + length
        self.spans.append((size, cell))

    def cell(self) -> Cell:
        whole = INSERTED
        for _, cell in reversed(self.spans):
            whole = combined(cell, whole)
        return whole


COUNTS = ("blank", "duplicate", "truncated", "illegal", "distinct")


class Span:
    """Consecutive rows of one conversation: counts, both ends, and the chart."""

    cells: dict = {}

    def __init__(self, conv):
        self.conv, self.chart, self.counts = conv, Chart(), dict.fromkeys(COUNTS, 0)
        self.first = self.last = None  # (turn, initial) of the rows at both ends
        self.low = self.high = None

    def known(self, *key) -> Cell:
        if key not in self.cells:
            if len(self.cells) > 10_000:
                self.cells.clear()
            self.cells[key] = row_cell(*key) if len(key) == 2 else deleted_cell(*key)
        return self.cells[key]

    def add(self, turn, initial: str, blank: bool, cut: bool, n: int, first: bool) -> None:
        """n equal rows, the first of them the first of its role and text if told so."""
        if not n:
            return
        count, gone = self.counts, n
        if blank:
            count["blank"] += n
        else:
            gone -= first
            count["duplicate"] += gone
            if first:
                count["truncated"] += cut
                self.chart.add(self.known(initial, cut))
        if gone:
            self.chart.add(self.known(gone))
        count["illegal"] += n - 1 + (self.last is not None and self.last[1] + initial not in LEGAL)
        if turn is not None:
            if self.last is None or self.last[0] != turn:
                count["distinct"] += 1
            self.low = turn if self.low is None else min(self.low, turn)
            self.high = turn if self.high is None else max(self.high, turn)
        self.first = self.first or (turn, initial)
        self.last = (turn, initial)

    def join(self, other: Span) -> None:
        """The rows of other follow."""
        if other.first is None:
            return
        if self.first is None:
            self.first = other.first
        else:
            self.counts["illegal"] += self.last[1] + other.first[1] not in LEGAL
            self.counts["distinct"] -= other.first[0] is not None and self.last[0] == other.first[0]
        self.last = other.last
        for k in COUNTS:
            self.counts[k] += other.counts[k]
        some = [x for x in (self.low, other.low) if x is not None]
        self.low = min(some, default=None)
        self.high = max((x for x in (self.high, other.high) if x is not None), default=None)
        self.chart.add(other.chart.cell())


def _spans(conv: T.DataType, turn: T.DataType) -> T.StructType:
    end = T.StructType([T.StructField("turn", turn), T.StructField("initial", T.StringType())])
    cell = T.ArrayType(T.StructType([T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())]))
    return T.StructType(
        [T.StructField("conv_id", conv), T.StructField("part", T.LongType()), T.StructField("first", end), T.StructField("last", end)]
        + [T.StructField(c, turn) for c in ("low", "high")] + [T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField("cell", cell)]
    )


PARSE = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [T.StructField("audit", T.StringType())]
)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterator[dict], schema: pa.Schema, most: int = 1000, most_chars: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows as batches of at most `most` rows, begun anew after most_chars characters of text."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row.get("text") or "") + len(row.get("audit") or "")
        if len(held) == most or chars > most_chars:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _grouped(rows: Iterator[tuple], make, add) -> Iterator:
    """One object per run of rows with the same first value."""
    now = None
    for row in rows:
        if now is None or now.conv != row[0]:
            if now is not None:
                yield now
            now = make(row[0])
        add(now, row)
    if now is not None:
        yield now


def _parse_parts(schema: pa.Schema):
    def parse(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for_row = lambda span, row: span.add(*row[1:])
        for s in _grouped(_rows(batches), Span, for_row):
            end = lambda e: None if e is None else {"turn": e[0], "initial": e[1]}
            cell = [None if c is None else {"cost": c[0], "audit": c[1]} for c in s.chart.cell()]
            yield {"conv_id": s.conv, "part": part, "first": end(s.first), "last": end(s.last), "low": s.low, "high": s.high, **s.counts, "cell": cell}

    return lambda batches: _batches(parse(batches), schema, 200)


def _parse_whole(schema: pa.Schema):
    def add(whole: Span, row: tuple) -> None:
        _, _, first, last, low, high, *counts, cell = row
        s = Span(whole.conv)
        end = lambda e: None if e is None else (e["turn"], e["initial"])
        s.first, s.last, s.low, s.high = end(first), end(last), low, high
        s.counts = dict(zip(COUNTS, counts))
        s.chart.spans = [(1, tuple(None if c is None else (c["cost"], c["audit"]) for c in cell))]
        whole.join(s)

    def whole(batches):
        for s in _grouped(_rows(batches), Span, add):
            cell = s.chart.cell()
            cost, audit = min(c for c in (cell[SYMBOLS.index("00")], cell[SYMBOLS.index("0A")]) if c is not None)
            gaps = 0 if s.low is None else s.high - s.low + 1 - s.counts["distinct"]
            found = {k: v for k, v in s.counts.items() if k != "distinct"}
            yield {"conv_id": s.conv, "gaps": gaps, **found, "cost": cost, "audit": audit}

    return lambda batches: _batches(whole(batches), schema, 200)


def damage(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows dropped (copies 0), emptied, unpunctuated, doubled or given to the user
    by crc32 of conv_id:turn modulo 20. Nulls stand for one space, in the key as in role and text."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return df.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(space("role")).alias("role"), text.alias("text"), copies.cast("long").alias("copies")
    )


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def parse(rows: DataFrame) -> DataFrame:
    """Per conversation: conv_id and the columns of PARSE, from conv_id, turn, role, text, copies.

    Rows stand in order of turn, nulls first; rows of one turn by role and then by the SHA-256 of the text. copies is how
    often a row is there; a conversation whose rows are there 0 times is returned with zeros and an empty audit. Faults, a
    row's first one counts: blank, duplicate (role and text seen earlier), truncated (does not end in . ! or ?). A null
    conv_id is a conversation of its own; null role and text are empty; an empty table gives no row. Columns of other
    names are not read. turn is an integer.
    """
    there = F.col("copies") > 0
    text = F.coalesce("text", F.lit(""))
    bare = F.rtrim(text, F.lit(BLANK))
    light = rows.select(
        "conv_id",
        F.when(there, F.col("turn")).alias("turn"),
        F.when(there, F.coalesce("role", F.lit(""))).alias("role"),
        F.when(there, _digest(text)).alias("digest"),
        F.when(there, bare == "").alias("blank"),
        F.when(there, ~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.col("copies").cast("long").alias("n"),
    )
    same = ["conv_id", "role", "digest", "blank", "cut"]
    earliest = F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn"))
    firsts = light.filter("n > 0").groupBy(same).agg(earliest.alias("at")).select(*same, F.col("at.turn").alias("turn"), F.lit(0).cast("long").alias("n"), F.lit(True).alias("first"))
    each = light.withColumn("first", F.lit(False)).unionByName(firsts).groupBy("conv_id", "turn", "role", "digest", "blank", "cut").agg(
        F.sum("n").alias("n"), F.max("first").alias("first")
    )
    initial = F.left("role", F.lit(1))
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("-")
    order = ["conv_id", "turn", "role", "digest"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = each.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt = dealt.select("conv_id", "turn", initial.alias("initial"), "blank", "cut", "n", "first")
    conv, turn = rows.schema["conv_id"].dataType, rows.schema["turn"].dataType
    schema = _spans(conv, turn)
    spans = dealt.mapInArrow(_parse_parts(_arrow(schema)), schema)
    schema = T.StructType([T.StructField("conv_id", conv), *PARSE])
    return spans.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(_parse_whole(_arrow(schema)), schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _with_edits(rows: DataFrame, parsed: DataFrame) -> DataFrame:
    """conv_id, parse, turn, role, text, copies: a row with its conversation's parse, then the rows in the order of the audit."""
    found = F.struct(*PARSE.names).alias("parse")
    null = lambda c: F.lit(None).cast(rows.schema[c].dataType).alias(c)
    heads = parsed.select("conv_id", found, null("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("copies"))
    texts = rows.filter("copies > 0").select(
        "conv_id", F.lit(None).cast(PARSE).alias("parse"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.col("copies").cast("long")
    )
    every = heads.unionByName(texts).repartition("conv_id")
    return every.sortWithinPartitions("conv_id", F.col("parse").isNull(), "turn", "role", _digest(F.col("text")))


class Edited:
    """A conversation's edits, taken as its rows come."""

    def __init__(self, conv):
        self.conv, self.parse, self.state, self.at = conv, None, "0", 0

    def turns(self, row: tuple) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the repaired turns up to this row's edit, its own included."""
        _, parse, _, role, text, copies = row
        if parse is not None:
            self.parse = parse
            return
        for _ in range(copies):
            yield from self.insertions()
            edit = self.parse["audit"][self.at]
            self.at += 1
            if edit == "K":
                yield self.put(edit, role[:1], role, text)
            elif edit == "R":
                due = self.due()
                yield self.put(edit, due, ROLES[due], text)

    def insertions(self) -> Iterator[tuple[str, str, str]]:
        while self.parse["audit"][self.at : self.at + 1] == "I":
            self.at += 1
            due = self.due()
            yield self.put("I", due, ROLES[due], "")

    def due(self) -> str:
        return "a" if self.state == "U" else "u"

    def put(self, edit: str, initial: str, role: str, text: str) -> tuple[str, str, str]:
        self.state = NEXT[self.state, initial]
        return edit, role, text


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Edited, Iterator]]:
    """Every conversation once (turns None), then each piece of its repaired turns, the insertions at its end included."""
    now = None
    for row in _rows(batches):
        if now is None or now.conv != row[0]:
            if now is not None:
                yield now, now.insertions()
            now = Edited(row[0])
            yield now, None
        yield now, now.turns(row)
    if now is not None:
        yield now, now.insertions()


def repair(rows: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, position from 1, edit (K, R or I), role, text. Input and cases as in parse()."""
    schema = T.StructType(
        [rows.schema["conv_id"], T.StructField("position", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("edit", "role", "text"))]
    )

    def apply(batches):
        at = 0
        for c, turns in _edits(batches):
            if turns is None:
                at = 0
                continue
            for edit, role, text in turns:
                at += 1
                yield {"conv_id": c.conv, "position": at, "edit": edit, "role": role, "text": text}

    arrow = _arrow(schema)
    return _with_edits(rows, parse(rows)).mapInArrow(lambda batches: _batches(apply(batches), arrow), schema)


def repair_digests(rows: DataFrame) -> DataFrame:
    """The columns of parse() and repaired_sha256: of the repaired turns as role:text, joined by line ends.

    SHA-256 has no parallel form, so a conversation's texts pass one task for it, as a stream that is never held.
    """
    schema = T.StructType([rows.schema["conv_id"], *PARSE, T.StructField("repaired_sha256", T.StringType())])

    def digests(batches):
        now = digest = None
        for c, turns in _edits(batches):
            if turns is None:
                if now is not None:
                    yield {"conv_id": now.conv, **now.parse, "repaired_sha256": digest.hexdigest()}
                now, digest, between = c, hashlib.sha256(), b""
                continue
            for _, role, text in turns:
                digest.update(between + f"{role}:{text}".encode())
                between = b"\n"
        if now is not None:
            yield {"conv_id": now.conv, **now.parse, "repaired_sha256": digest.hexdigest()}

    arrow = _arrow(schema)
    return _with_edits(rows, parse(rows)).mapInArrow(lambda batches: _batches(digests(batches), arrow), schema)


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """repair_digests() of a table after damage()."""
    return repair_digests(damage(conversations))

"""Fields of one stop: facility, place, date and time.

A step is a function col -> {name: Column}; later steps read earlier names through col, so
each regex runs once per stop. Steps run over columns (add_steps), which Spark compiles: a
stop is a row, or each slot of a document has columns of its own. Or they map over an array
of stops (run_steps), where one expression serves any number of stops but is interpreted.
Either way nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby, zip_longest

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.datetimes import DAY_FIRST_TOO, MONTH_FIRST, combine, iso_date, iso_time
from ..functions.text import RUNS, SEP, captured, collapse, extract, group, let, replace_all, replace_each, rx, strip

PARTS = ("customer",), ("address", "city", "state", "zipcode"), ("start_datetime", "end_datetime")  # facility, place, times
FIELDS = tuple(f for part in PARTS for f in part)


def run_steps(items: Column, steps, fields=FIELDS) -> Column:
    """Array of structs with the fields, after mapping every item through the steps.

    items is an array of structs; its fields are what the first step reads. Each step makes a struct of its values and
    of the earlier ones that are read after it, so a value is computed once, only referred to, and dropped when done with.
    """
    for make, kept, needed in _planned(steps, fields):

        def body(s):
            new = make(lambda name: s[name])
            if needed is None:
                return F.struct(*[(new[f] if f in new else s[f]).alias(f) for f in fields])
            return F.struct(*[s[k].alias(k) for k in kept], *[e.alias(k) for k, e in new.items() if k in needed])

        items = F.transform(items, body)
    return items


def _planned(steps, fields):
    """Per step: the step, the earlier names that are read after it, and its own names that are (None: the last step)."""
    reads, makes = [], []
    for make in steps:
        seen = set()
        makes.append(set(make(lambda name: seen.add(name) or F.lit(None).cast("string"))))
        reads.append(seen)
    for n, make in enumerate(steps):
        known = set().union(*reads[:1], *makes[:n])
        needed = set(fields).union(*reads[n + 1 :])
        yield make, sorted((needed & known) - makes[n]), needed if n < len(steps) - 1 else None


def add_steps(df: DataFrame, slots: dict, keep) -> DataFrame:
    """The keep columns and, per slot, its fields: the steps run over columns, which Spark compiles.

    slots: prefix -> (steps, fields, names). Names tell the columns of df that the first step reads; fields become
    columns <prefix><field>. A value is computed once and dropped when done with; it is null where what it reads is.

    With several slots, the first kept value goes through let() in each step: a projection with a lambda is compiled on its
    own, in small methods, while the steps of all slots in one method are longer than what the JVM compiles to machine code.
    """
    plans = {prefix: list(_planned(steps, fields)) for prefix, (steps, fields, _) in slots.items()}
    now = {prefix: dict(names) for prefix, (_, _, names) in slots.items()}
    for n in range(max(map(len, plans.values()))):
        out = []
        for prefix, (_, fields, _) in slots.items():
            names = now[prefix]
            if n >= len(plans[prefix]):
                out += map(F.col, names.values())
                continue
            make, kept, needed = plans[prefix][n]
            new = make(lambda name, names=names: F.col(names[name]))
            if needed is None:
                done = {f: new[f] if f in new else F.col(names[f]) for f in fields}
            else:
                done = {**{k: F.col(names[k]) for k in kept}, **{k: e for k, e in new.items() if k in needed}}
            now[prefix] = {k: prefix + k for k in done}
            out += [e.alias(prefix + k) for k, e in done.items()]
        apart = 1 if len(slots) > 1 else 0
        df = df.select(*[let(F.col(k), lambda v: v).alias(k) for k in keep[:apart]], *keep[apart:], *out)
    return df


def _together(*step_lists):
    """Run several step lists side by side."""

    def merge(makes):
        return lambda c: {name: e for make in makes if make for name, e in make(c).items()}

    return [merge(makes) for makes in zip_longest(*step_lists)]


def _iso(date: Column, time: Column) -> Column:
    """'' unless both parts are there."""
    return F.coalesce(F.concat(date, F.lit("T"), time), F.lit(""))


def _moments(c):
    return {"start_datetime": _iso(c("_day"), c("_start")), "end_datetime": _iso(c("_day"), c("_end"))}


@dataclass(frozen=True)
class Facility:
    pattern: str
    skip: str | None  # candidates that start so are passed over
    cleanups: tuple  # (pattern, replacement, flags); None strips
    tidy: bool = True  # collapse white space, drop ' -|' at the ends

    def candidates(self, block: Column) -> Column:
        return F.regexp_extract_all(block, F.lit(rx(self.pattern, "is")), F.lit(1))

    def chosen(self, found: Column) -> Column:
        """The candidate that counts, from all of a block."""
        if self.skip is not None:
            found = F.filter(found, lambda c: ~self.passed(c))
        return F.coalesce(F.get(found, F.lit(0)), F.lit(""))

    def passed(self, candidate: Column) -> Column:
        return candidate.rlike(rx(rf"\A\s*(?:{self.skip})"))

    def steps(self, kind: str):
        first = lambda c: {"_first": F.regexp_extract(c("block"), rx(self.pattern, "is"), 1)}
        if self.skip is None:
            return [first, lambda c: {"_name": strip(c("_first"))}, *self.tidied()]
        # the other candidates are looked for only if the first is passed over
        chosen = lambda c: F.when(self.passed(c("_first")), self.chosen(self.candidates(c("block")))).otherwise(c("_first"))
        return [first, lambda c: {"_name": strip(chosen(c))}, *self.tidied()]

    def steps_from(self, found: str):
        """The steps from the candidates of a block to its name."""
        return [lambda c: {"_name": strip(self.chosen(c(found)))}, *self.tidied()]

    def tidied(self):
        """The steps from a stripped name to the customer."""
        makes, value = [], lambda c: c("_name")
        for n, (strips, steps) in enumerate(groupby(self.cleanups, lambda step: step is None)):
            if strips:
                value = lambda c, before=value: strip(before(c))
                continue
            if n:
                makes.append(lambda c, before=value: {"_name": before(c)})
            value = lambda c, steps=tuple(steps): replace_each(c("_name"), steps)
        if not self.tidy:
            return [*makes, lambda c: {"customer": value(c)}]
        makes.append(lambda c: {"_name": value(c)})
        return [*makes, lambda c: {"customer": F.trim(F.regexp_replace(c("_name"), rx(RUNS, ""), " "), F.lit(" -|"))}]


# Place patterns.
CITY_STATE_ZIP = r"^(.+),\s*([A-Z]{2})\s+(\d{5}(?:-\d{4})?)\s*$"
# Only the first letter of a run of city characters can start this match, so runs are
# scanned once instead of from every letter.
STATE_THEN_ZIP = (
    r"(?:^|[^A-Za-z\s\-.])[\s\-.]*+([A-Za-z][A-Za-z\s\-.]++),\s*([A-Z]{2})\b.*?(\d{5}(?:-\d{4})?)"
)
TRAILING_CODE = (r"\s+[A-Z][A-Z0-9]{2,7}$", "", "")
# Reversed text: capital-initial words of two or more characters, read backwards. One
# anchored pass, where a forward search would retry from every word.
CITY_WORDS_REVERSED = r"\A(\S+[A-Z](?:\s+\S+[A-Z])*+)"


def _minus_tail(whole: Column, tail: Column) -> Column:
    return strip(F.left(whole, F.length(whole) - F.length(tail)))


def _found(caps: Column) -> Column:
    return F.size(caps) > 1


@dataclass(frozen=True)
class Geo:
    """address, city, state and zipcode; four empty strings if no state is found."""

    kind: str  # 'road', 'last_word', 'last_two', 'run' or 'labelled'
    zone: str = ""
    removals: tuple = ()
    road: str = ""
    place: str = ""

    def steps(self, kind: str):
        if self.kind == "labelled":
            names = ("address", "city", "state", "zipcode")
            return [
                lambda c: {"_a": captured(c("block"), self.place, 4)},
                lambda c: {name: group(c("_a"), g) for g, name in enumerate(names, 1)},
            ]
        return [
            lambda c: {"_found": self.zone_text(c("block"))},
            lambda c: {"_cleared": self.cleared(c("_found"))},
            *self.steps_from("_cleared"),
        ]

    def steps_from(self, cleared: str):
        """The steps from a cleared zone to the place."""
        by_tail = self.kind in ("road", "last_word")
        steps = [lambda c: {"_zone": self.zone_end(c(cleared))}, self._match_by_tail if by_tail else self._match_by_run]
        if by_tail:
            steps.append(lambda c: {"_before": group(c("_a"), 1), **self._otherwise(c)})
        else:
            steps.append(self._otherwise)
        if self.kind == "road":
            steps += [self._road, self._after_road, self._city_words]
        return [*steps, self._place]

    def zone_text(self, block: Column) -> Column:
        return F.regexp_extract(block, rx(self.zone, "is"), 1)

    def cleared(self, zone: Column) -> Column:
        return collapse(replace_each(zone, self.removals))

    def zone_end(self, zone: Column) -> Column:
        return strip(replace_all(zone, [TRAILING_CODE])) if self.kind == "road" else zone

    def _match_by_tail(self, c):
        return {"_a": captured(c("_zone"), CITY_STATE_ZIP, 3)}

    def _match_by_run(self, c):
        return {"_a": captured(c("_zone"), self.place, 4)}

    def _otherwise(self, c):
        return {"_b": F.when(~_found(c("_a")), captured(c("_zone"), STATE_THEN_ZIP, 3))}

    def _road(self, c):
        return {"_r": F.when(_found(c("_a")), captured(c("_before"), self.road, 2))}

    def _after_road(self, c):
        return {"_road": group(c("_r"), 1), "_after": group(c("_r"), 2)}

    def _city_words(self, c):
        found = F.regexp_extract(F.reverse(c("_after")), rx(CITY_WORDS_REVERSED, ""), 1)
        return {"_run": F.reverse(found)}

    def _address_and_city(self, c):
        if self.kind in ("road", "last_word"):
            city = F.substring_index(c("_before"), " ", -1)
            address = _minus_tail(c("_before"), city)
            if self.kind == "road":
                by_road, has_run = _found(c("_r")), c("_run") != ""
                between = _minus_tail(c("_after"), c("_run"))
                joined = F.rtrim(F.concat_ws(" ", c("_road"), between))
                address = F.when(by_road & has_run, joined).when(by_road, c("_road")).otherwise(address)
                city = F.when(by_road & has_run, c("_run")).when(by_road, c("_after")).otherwise(city)
            return address, city
        address, city = group(c("_a"), 1), group(c("_a"), 2)
        if self.kind == "last_two":
            words = F.split(city, " ")
            more = F.size(words) > 2
            rest = F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))), " ")
            address = F.when(more, F.concat_ws(" ", address, rest)).otherwise(address)
            city = F.when(more, F.substring_index(city, " ", -2)).otherwise(city)
        return address, city

    def _place(self, c):
        address, city = self._address_and_city(c)
        other_city = F.coalesce(F.get(c("_b"), F.lit(1)), F.lit(""))
        other_address = strip(F.call_function("substring_index", c("_zone"), other_city, F.lit(1)))
        pick = lambda a, b: F.when(_found(c("_a")), a).when(_found(c("_b")), b).otherwise("")
        n = 2 if self.kind in ("road", "last_word") else 3
        return {
            "address": F.upper(pick(address, other_address)),
            "city": pick(city, F.substring_index(strip(other_city), " ", -1)),
            "state": F.upper(pick(group(c("_a"), n), group(c("_b"), 2))),
            "zipcode": pick(group(c("_a"), n + 1), group(c("_b"), 3)),
        }


@dataclass(frozen=True)
class Times:
    """start and end, both '' unless a date and a time are found; a range wins over 'at'."""

    date: str
    range: str
    at: str

    def steps(self, kind: str):
        def find(c):
            return {
                "_date": F.regexp_extract(c("block"), rx(self.date), 1),
                "_range": captured(c("block"), self.range, 2),
                "_at": F.regexp_extract(c("block"), rx(self.at), 1),
            }

        def parts(c):
            time = lambda g: F.when(_found(c("_range")), F.get(c("_range"), F.lit(g))).otherwise(c("_at"))
            return {
                "_parts": F.split(c("_date"), "/"),
                "_from": time(1),
                "_to": time(2),
            }

        def moments(c):
            day = iso_date(c("_date"), DAY_FIRST_TOO, c("_parts"))
            return {"_day": day, "_start": iso_time(c("_from"), ("24h",)), "_end": iso_time(c("_to"), ("24h",))}

        return [find, parts, moments, _moments]


@dataclass(frozen=True)
class ScheduledTimes:
    """Pickups read a range; deliveries read the start and repeat it as the end."""

    date: str
    range: str
    at: str
    shapes: tuple

    def steps(self, kind: str):
        def find(c):
            day = {"_date": extract(c("block"), self.date, 2)}
            if kind == "pickup":
                return {**day, "_range": captured(c("block"), self.range, 2)}
            return {**day, "_at": extract(c("block"), self.at)}

        def moments(c):
            if kind == "pickup":
                start, end = group(c("_range"), 1), group(c("_range"), 2)
                end = F.when(end == "", start).otherwise(end)
                return {
                    "start_datetime": combine(c("_date"), start, self.shapes),
                    "end_datetime": combine(c("_date"), end, self.shapes),
                }
            start = combine(c("_date"), c("_at"), self.shapes)
            return {"start_datetime": start, "end_datetime": start}

        return [find, moments]


def _own(name: str, part: int) -> str:
    return f"{name}_{part}" if name.startswith("_") else name


@dataclass(frozen=True)
class BlockStop:
    """Stops read from free text blocks."""

    facility: Facility
    geo: Geo
    times: object

    @property
    def same_for_all_types(self) -> bool:
        return not isinstance(self.times, ScheduledTimes)

    def steps(self, kind: str, fields=FIELDS):
        """From "block" to the fields; parts that have none of them are not parsed."""
        parts = [p for p, own in zip((self.facility, self.geo, self.times), PARTS) if not set(own).isdisjoint(fields)]
        # names of their own, so that parts do not read each other's
        own = lambda make, n: lambda c: {_own(k, n): e for k, e in make(lambda name: c(_own(name, n))).items()}
        return _together(*[[own(make, n) for make in p.steps(kind)] for n, p in enumerate(parts)])

    def columns(self, blocks: Column, kind: str, fields=FIELDS) -> Column:
        return run_steps(_as_structs(blocks), self.steps(kind, fields), fields)


def parse_together(blocks: Column, parsers, kind: str) -> tuple[Column, list[dict]]:
    """The blocks read by several BlockStops in one pass, and per BlockStop the name that each of FIELDS has in it.

    Parts that are equal by value are evaluated once; so are the candidates of a facility pattern, the zone of a place
    pattern and its clearing, whichever parts go on from them.
    """
    first, cleared, made = {}, {}, {}

    def source(known: dict, key, name: str, column) -> str:
        return known.setdefault(key, (f"{name}{len(known)}", column))[0]

    def steps_of(part):
        if isinstance(part, Facility):
            found = source(first, (Facility, part.pattern), "found", lambda c: part.candidates(c("block")))
            return [lambda c: {}, *part.steps_from(found)]
        if isinstance(part, Geo) and part.kind != "labelled":
            zone = source(first, (Geo, part.zone), "found", lambda c: part.zone_text(c("block")))
            clear = source(cleared, (part.zone, part.removals), "cleared", lambda c: part.cleared(c(zone)))
            return [lambda c: {}, lambda c: {}, *part.steps_from(clear)]
        return part.steps(kind)

    def own_names(make, prefix: str):
        common = {"block", *(n for n, _ in first.values()), *(n for n, _ in cleared.values())}
        here = lambda c: lambda name: c(name if name in common else prefix + name)
        return lambda c: {prefix + name: e for name, e in make(here(c)).items()}

    for parser in parsers:
        for part in (parser.facility, parser.geo, parser.times):
            if part not in made:
                made[part] = f"p{len(made)}_", steps_of(part)
    shared = [lambda c, s=s: {name: column(c) for name, column in s.values()} for s in (first, cleared)]
    steps = _together(shared, *[[own_names(m, prefix) for m in makes] for prefix, makes in made.values()])
    names = []
    for parser in parsers:
        prefix = lambda part: made[part][0]
        place = {f: prefix(parser.geo) + f for f in ("address", "city", "state", "zipcode")}
        moments = {f: prefix(parser.times) + f for f in ("start_datetime", "end_datetime")}
        names.append({"customer": prefix(parser.facility) + "customer", **place, **moments})
    every = tuple(dict.fromkeys(n for of_one in names for n in of_one.values()))
    return run_steps(_as_structs(blocks), steps, every), names


def _as_structs(blocks: Column) -> Column:
    return F.transform(blocks, lambda b: F.struct(b.alias("block")))


@dataclass(frozen=True)
class LabelledStop:
    """Stops whose fields follow fixed labels; one pattern per field and type."""

    patterns: dict  # type -> {customer, address, place, zipcode, date, times}
    address_removals: dict  # type -> steps
    same_for_all_types = False

    def steps(self, kind: str, fields=FIELDS):
        p = self.patterns[kind]

        def find(c):
            return {
                "customer": extract(c("block"), p["customer"]),
                "address": strip(replace_all(extract(c("block"), p["address"]), self.address_removals[kind])),
                "zipcode": extract(c("block"), p["zipcode"]),
                "_place": captured(c("block"), p["place"], 2),
                "_date": extract(c("block"), p["date"]),
                "_times": captured(c("block"), p["times"], 2),
            }

        def split(c):
            return {
                "_parts": F.split(c("_date"), "/"),
                "_from": F.get(c("_times"), F.lit(1)),
                "_to": F.get(c("_times"), F.lit(2)),
                "city": group(c("_place"), 1),
                "state": group(c("_place"), 2),
            }

        def parts(c):
            clocks = ("24h", "12h", "24h+s", "12h+s")
            return {
                "_day": iso_date(c("_date"), MONTH_FIRST, c("_parts")),
                "_start": iso_time(c("_from"), clocks),
                "_end": iso_time(c("_to"), clocks),
            }

        return [find, split, parts, _moments]

    def columns(self, blocks: Column, kind: str, fields=FIELDS) -> Column:
        return run_steps(_as_structs(blocks), self.steps(kind, fields), fields)


@dataclass(frozen=True)
class NumberedStop:
    """One all-or-nothing pattern per stop number over the whole text."""

    pattern: str  # with {label} and {number}
    labels: dict  # type -> label
    guard: str | None = None  # the same placeholders; holds for every text that the pattern matches

    def _captured(self, text: Column, kind: str, number: str) -> Column:
        fill = lambda p: p and p.replace("{label}", self.labels[kind]).replace("{number}", number)
        return F.struct(captured(text, fill(self.pattern), 8, guard=fill(self.guard)).alias("_m"))

    def columns_from_text(self, text: Column, kind: str, cap: int) -> Column:
        """One item per number; a number that is not found gives empty strings."""
        return self._fields(F.array(*[self._captured(text, kind, str(k)) for k in range(1, cap + 1)]))

    def blocks_from_text(self, text: Column, kind: str) -> Column:
        """The stops of a type that the text has: number, and the text from its marker to the next one of any type.

        A number that occurs again is the same stop; its first marker counts.
        """
        marker = lambda labels: rf"(?:{labels})\s*#\s*(\d+)\s+Customer:"
        pieces = F.split(F.regexp_replace(text, rx(marker("|".join(self.labels.values()))), SEP + "$0"), SEP)
        own = lambda p: F.regexp_extract(p, rx(r"\A" + marker(self.labels[kind])), 1)
        items = F.filter(F.transform(pieces, lambda p: F.struct(own(p).alias("number"), p.alias("block"))), lambda x: x["number"] != "")
        return let(items, lambda xs: F.filter(xs, lambda x, i: F.array_position(xs["number"], x["number"]) == i + 1))

    def columns_from_blocks(self, blocks: Column, kind: str) -> Column:
        return self._fields(F.transform(blocks, lambda b: self._captured(b["block"], kind, r"\d+")))

    def _fields(self, items: Column) -> Column:
        order = {"customer": 1, "address": 3, "city": 6, "state": 7, "zipcode": 8}

        def find(c):
            clock = lambda g: extract(F.get(c("_m"), F.lit(g)), r"(\d{1,2}:\d{2}:\d{2})")
            return {
                **{name: group(c("_m"), g) for name, g in order.items()},
                "_date": extract(F.get(c("_m"), F.lit(2)), r"(\d{1,2}/\d{1,2}/\d{4})"),
                "_from": clock(4),
                "_to": clock(5),
            }

        def fields(c):
            day = iso_date(c("_date"), MONTH_FIRST)
            return {
                "start_datetime": _iso(day, iso_time(c("_from"), ("24h+s",))),
                "end_datetime": _iso(day, iso_time(c("_to"), ("24h+s",))),
            }

        return run_steps(items, [find, fields])

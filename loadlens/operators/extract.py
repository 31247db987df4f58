"""Rule rows -> Columns, and whole rule sets -> one wide row per document."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.datetimes import processed_at
from ..sources.documents import Reader
from . import segment, stops

DOC_TEXT = "_text"


@dataclass(frozen=True)
class Rule:
    """One field: patterns tried in order in a scope, then a clean-up and a default."""

    field: str
    patterns: tuple
    scope: str = "text"
    flags: str = "i"
    clean: str = "strip"
    default: str = ""

    def column(self, scope: Column, text: Column) -> Column:
        found = [tx.extract(scope, p, flags=self.flags) for p in self.patterns]
        value = CLEANUPS[self.clean](tx.first_filled(*found))
        if self.default:
            # an empty document keeps empty fields
            value = tx.let(value, lambda v: F.when((v == "") & (text != ""), F.lit(self.default)).otherwise(v))
        return value


@dataclass(frozen=True)
class Fallback:
    """A field read from a scope, else from the whole text, else a constant."""

    field: str
    scope: str
    pattern: str
    text_patterns: tuple
    default: str

    def column(self, scope: Column, text: Column) -> Column:
        value = tx.first_filled(
            tx.extract(scope, self.pattern), *[tx.extract(text, p) for p in self.text_patterns], F.lit(self.default)
        )
        return F.when(text != "", value).otherwise("")


@dataclass(frozen=True)
class Group:
    """Several fields from the groups of one pattern: all of them or none."""

    fields: tuple
    pattern: str
    scope: str = "text"
    flags: str = "i"
    clean: dict = field(default_factory=dict)
    guard: str | None = None  # holds for every text that the pattern matches

    def captures(self, scope: Column) -> Column:
        return tx.captured(scope, self.pattern, len(self.fields), self.flags, self.guard)


@dataclass(frozen=True)
class Parts:
    """Several fields from the entries 1, 2, ... of an array, null if there are none."""

    fields: tuple
    function: object
    scope: str = "text"
    clean: dict = field(default_factory=dict)

    def captures(self, scope: Column) -> Column:
        return self.function(scope)


@dataclass(frozen=True)
class Computed:
    """A field from a Column function over its scope."""

    field: str
    function: object
    scope: str = "text"

    def column(self, scope: Column, text: Column) -> Column:
        return self.function(scope)


CLEANUPS = {
    "strip": lambda c: c,
    "money": lambda c: tx.strip(tx.money(c)),
    "no_spaces": lambda c: tx.strip(F.replace(c, F.lit(" "), F.lit(""))),
    "collapse": tx.collapse,
}


@dataclass(frozen=True)
class Ruleset:
    """Everything that turns one vendor's document text into columns."""

    name: str
    profile: str
    fields: tuple
    header: tuple
    constants: dict = field(default_factory=dict)
    splitter: segment.Splitter | None = None
    stop: object = None
    caps: dict = field(default_factory=dict)
    stamp: str | None = None  # 'utc', 'local' or None
    reader: Reader = Reader()


def header(df: DataFrame, rules, text: str = DOC_TEXT, constants=None) -> DataFrame:
    """Add the header fields of the rules to a frame holding normalised text."""
    doc = F.col(text)
    scopes = sorted({r.scope for r in rules} - {"text"})
    df = df.withColumns({f"_{s}": segment.section(doc, s) for s in scopes})
    scope = lambda r: doc if r.scope == "text" else F.col(f"_{r.scope}")
    groups = [r for r in rules if isinstance(r, (Group, Parts))]
    df = df.withColumns({f"_g{i}": r.captures(scope(r)) for i, r in enumerate(groups)})
    out = {r.field: r.column(scope(r), doc) for r in rules if not isinstance(r, (Group, Parts))}
    for i, r in enumerate(groups):
        for g, name in enumerate(r.fields, 1):
            out[name] = CLEANUPS[r.clean.get(name, "strip")](tx.group(F.col(f"_g{i}"), g))
    for name, value in (constants or {}).items():
        out[name] = F.when(doc != "", F.lit(value)).otherwise("")
    return df.withColumns(out)


def stop_arrays(df: DataFrame, ruleset: Ruleset, text: str = DOC_TEXT, capped: bool = True, fields=stops.FIELDS) -> DataFrame:
    """Add one array of parsed stops per type, cut at the rule set's caps or whole, with the fields at least.

    In the layout whose stops have numbers, the slots are looked up by number; the whole adds every other number that
    the text has, and <type>_numbers tells them.
    """
    doc = F.col(text)
    if isinstance(ruleset.stop, stops.NumberedStop):
        slots = {f"{t}_stops": ruleset.stop.columns_from_text(doc, t, ruleset.caps[t]) for t in segment.TYPES}
        return df.withColumns(slots) if capped else _all_numbered(df.withColumns(slots), ruleset, doc)
    df = segment.blocks_by_type(df, text, ruleset.splitter)
    kept = {t: F.slice(f"{t}_blocks", 1, ruleset.caps[t]) if capped else F.col(f"{t}_blocks") for t in segment.TYPES}
    if not ruleset.stop.same_for_all_types:
        return df.withColumns({f"{t}_stops": ruleset.stop.columns(kept[t], t, fields) for t in segment.TYPES})
    # one pass over both types, then cut where the pickups end
    df = df.withColumns(
        {"_stops": ruleset.stop.columns(F.concat(*kept.values()), "any", fields), "_pickups": F.size(kept["pickup"])}
    )
    return df.withColumns(
        {
            "pickup_stops": F.slice("_stops", F.lit(1), F.col("_pickups")),
            "delivery_stops": F.slice("_stops", F.col("_pickups") + 1, F.size("_stops")),
        }
    )


def _slot_numbers(ruleset: Ruleset, kind: str) -> Column:
    return F.array(*[F.lit(str(k)) for k in range(1, ruleset.caps[kind] + 1)])


def _all_numbered(df: DataFrame, ruleset: Ruleset, doc: Column) -> DataFrame:
    """The slots that the text has, then its other numbers, each read from its own part of the text."""
    stop, types = ruleset.stop, segment.TYPES
    df = df.withColumns({f"_{t}_blocks": stop.blocks_from_text(doc, t) for t in types})
    here = lambda t, number: F.array_contains(F.col(f"_{t}_blocks")["number"], number)
    others = lambda t: F.filter(f"_{t}_blocks", lambda b: ~F.array_contains(_slot_numbers(ruleset, t), b["number"]))
    df = df.withColumns({f"_{t}_others": others(t) for t in types})
    found = {}
    for t in types:
        slots = F.filter(f"{t}_stops", lambda s, i: here(t, (i + 1).cast("string")))
        found[f"{t}_stops"] = F.concat(slots, stop.columns_from_blocks(F.col(f"_{t}_others"), t))
        numbers = F.concat(F.filter(_slot_numbers(ruleset, t), lambda n: here(t, n)), F.col(f"_{t}_others")["number"])
        found[f"{t}_numbers"] = F.transform(numbers, lambda n: n.try_cast("int"))
    return df.withColumns(found)


def stop_fields(df: DataFrame, ruleset: Ruleset, text: str = DOC_TEXT) -> DataFrame:
    """Add <type>_<field>_<k> for every slot of the rule set; '' where there is no stop."""
    if isinstance(ruleset.stop, stops.NumberedStop):
        return _slots(stop_arrays(df, ruleset, text), ruleset)
    keep, slots = df.columns, {}
    df = segment.blocks_by_type(df, text, ruleset.splitter)
    every = [(t, k) for t in segment.TYPES for k in range(1, ruleset.caps[t] + 1)]
    for t, k in every:
        slots[f"_{t}{k}_"] = ruleset.stop.steps(t), stops.FIELDS, {"block": f"_{t}{k}_block"}
    df = df.select(*keep, *[F.get(f"{t}_blocks", F.lit(k - 1)).alias(f"_{t}{k}_block") for t, k in every])
    df = stops.add_steps(df, slots, keep)
    named = [F.coalesce(f"_{t}{k}_{f}", F.lit("")).alias(f"{t}_{f}_{k}") for t, k in every for f in stops.FIELDS]
    return df.select(*keep, *named)


def _slots(df: DataFrame, ruleset: Ruleset) -> DataFrame:
    slot = lambda t, k, f: F.expr(f"coalesce(get({t}_stops, {k - 1}).{f}, '')")
    return df.withColumns(
        {
            f"{t}_{f}_{k}": slot(t, k, f)
            for t in segment.TYPES
            for k in range(1, ruleset.caps[t] + 1)
            for f in stops.FIELDS
        }
    )


def stop_rows(
    df: DataFrame, ruleset: Ruleset, text: str = "text", keep=("source_file",), capped: bool = False, fields=stops.FIELDS
) -> DataFrame:
    """One row per stop: the keep columns, type, rk and the stop fields, all or those named.

    All stops of a document, or with capped those that have a slot in the wide row. rk counts the stops of a type; where
    stops have numbers it is the number, and the capped rows are all slots, found or not.
    """
    docs = df.select(*keep, tx.normalise(F.col(text), ruleset.profile).alias(DOC_TEXT))
    if not isinstance(ruleset.stop, stops.NumberedStop):
        return _block_rows(docs, ruleset, keep, capped, fields)
    docs = stop_arrays(docs, ruleset, capped=capped, fields=fields)

    def ranked(kind):
        rk = lambda i: F.get(f"{kind}_numbers", i) if f"{kind}_numbers" in docs.columns else i + 1
        item = lambda s, i: F.struct(
            F.lit(kind).alias("type"), rk(i).alias("rk"), *[F.coalesce(s[f], F.lit("")).alias(f) for f in fields]
        )
        return F.transform(f"{kind}_stops", item)

    return docs.select(*keep, F.inline(F.concat(*[ranked(t) for t in segment.TYPES])))


def _block_rows(docs: DataFrame, ruleset: Ruleset, keep, capped: bool, fields) -> DataFrame:
    """stop_rows() of layouts with stop blocks: a block becomes a row first and is parsed then."""
    docs = segment.blocks_by_type(docs, DOC_TEXT, ruleset.splitter)

    def ranked(kind):
        blocks = F.slice(f"{kind}_blocks", 1, ruleset.caps[kind]) if capped else F.col(f"{kind}_blocks")
        return F.transform(blocks, lambda b, i: F.struct(F.lit(kind).alias("type"), (i + 1).alias("rk"), b.alias("_block")))

    rows = docs.select(*keep, F.inline(F.concat(*[ranked(t) for t in segment.TYPES])))
    kinds = ("any",) if ruleset.stop.same_for_all_types else segment.TYPES
    if len(kinds) > 1:
        # the steps of a type see no block of the other one
        rows = rows.withColumns({f"_{t}_block": F.when(F.col("type") == t, F.col("_block")) for t in kinds}).drop("_block")
    block = lambda t: {"block": "_block" if t == "any" else f"_{t}_block"}
    rows = stops.add_steps(rows, {f"_{t}_": (ruleset.stop.steps(t, fields), fields, block(t)) for t in kinds}, [*keep, "type", "rk"])
    value = lambda f: F.coalesce(*[F.col(f"_{t}_{f}") for t in kinds], F.lit(""))
    if len(kinds) > 1:
        value = lambda f: F.coalesce(*[F.when(F.col("type") == t, F.col(f"_{t}_{f}")) for t in kinds], F.lit(""))
    return rows.select(*keep, "type", "rk", *[value(f).alias(f) for f in fields])


def stops_beyond_slots(df: DataFrame, ruleset: Ruleset, text: str = "text", keep=("source_file",)) -> DataFrame:
    """Per document and stop type: its stops, the slots of the wide row, and how many stops have none."""
    docs = df.select(*keep, tx.normalise(F.col(text), ruleset.profile).alias(DOC_TEXT))
    numbered = isinstance(ruleset.stop, stops.NumberedStop)
    if numbered:
        docs = docs.withColumns({f"{t}_blocks": ruleset.stop.blocks_from_text(F.col(DOC_TEXT), t) for t in segment.TYPES})
    else:
        docs = segment.blocks_by_type(docs, DOC_TEXT, ruleset.splitter)

    def counted(kind):
        found, slots = F.size(f"{kind}_blocks"), F.lit(ruleset.caps[kind])
        beyond = F.greatest(found - slots, F.lit(0))
        if numbered:
            beyond = F.size(F.array_except(F.col(f"{kind}_blocks")["number"], _slot_numbers(ruleset, kind)))
        return F.struct(F.lit(kind).alias("type"), found.alias("stops"), slots.alias("slots"), beyond.alias("beyond"))

    return docs.select(*keep, F.inline(F.array(*[counted(t) for t in segment.TYPES])))


def extract(df: DataFrame, ruleset: Ruleset, text: str = "text", keep=("source_file",)) -> DataFrame:
    """One wide row per document: the keep columns, then the rule set's fields.

    The plan has no shuffle and no Python worker: a document is read, parsed and
    written by one task.
    """
    docs = df.select(*keep, tx.normalise(F.col(text), ruleset.profile).alias(DOC_TEXT))
    docs, out = _fields(docs, ruleset)
    if ruleset.stamp:
        out["processed_at"] = processed_at(local=ruleset.stamp == "local")
    return docs.select(*keep, *[c.alias(f) for f, c in out.items()])


def _fields(docs: DataFrame, ruleset: Ruleset) -> tuple[DataFrame, dict]:
    """docs with the rule set's columns added, and the output columns by name."""
    docs = header(stop_fields(docs, ruleset), ruleset.header, constants=ruleset.constants)
    known = set(docs.columns)
    return docs, {f: F.col(f) if f in known else F.lit("") for f in ruleset.fields}


def extract_each(df: DataFrame, rulesets, text: str = "text", keep=("source_file",)) -> DataFrame:
    """One row per document and rule set; fields a rule set does not have are null.

    The rule sets, which share one text profile, run over the same row, so documents
    are read and normalised once however many rule sets are compared.
    """
    (profile,) = {r.profile for r in rulesets}
    every = list(dict.fromkeys(f for r in rulesets for f in r.fields))
    docs = df.select(*keep, tx.normalise(F.col(text), profile).alias(DOC_TEXT))
    # header rules that several rule sets have are evaluated once
    rules = {id(rule): rule for r in rulesets for rule in r.header}
    of_rule, shared = {}, []
    for i, (key, rule) in enumerate(rules.items()):
        names = rule.fields if isinstance(rule, (Group, Parts)) else (rule.field,)
        of_rule[key] = {n: f"_h{i}_{n}" for n in names}
        found = header(docs, (rule,))
        docs = found.select(*keep, DOC_TEXT, *shared, *[F.col(n).alias(c) for n, c in of_rule[key].items()])
        shared += of_rule[key].values()
    # and so are splitters, and the parts of stops that several rule sets have
    docs, arrays = _shared_stops(docs, rulesets)
    shared += [c for c in docs.columns if c not in {*keep, DOC_TEXT, *shared}]
    done = []
    for r in rulesets:
        null = F.lit(None).cast("string")
        docs = _slots(docs.withColumns(arrays[r.name]) if r.name in arrays else stop_arrays(docs, r), r)
        out = {}
        for rule in r.header:
            out |= {n: F.col(c) for n, c in of_rule[id(rule)].items()}
        out |= {n: F.when(F.col(DOC_TEXT) != "", F.lit(v)).otherwise("") for n, v in r.constants.items()}
        known = set(docs.columns)
        value = lambda f: out.get(f, F.col(f) if f in known else F.lit("") if f in r.fields else null)
        row = F.struct(F.lit(r.name).alias("ruleset"), *[value(f).alias(f) for f in every])
        docs = docs.select(*keep, DOC_TEXT, *shared, *done, row.alias(r.name))
        done.append(r.name)
    return docs.select(*keep, F.inline(F.array(*done)))


def _shared_stops(docs: DataFrame, rulesets) -> tuple[DataFrame, dict]:
    """Stops of the rule sets that cut a document at the same markers, parsed in one pass over the blocks.

    Adds the pass to docs and returns, by name of rule set, the arrays of stops that stop_arrays would add. Only blocks
    that have a slot in one of the rule sets are parsed. Rule sets alone with their markers are left to stop_arrays.
    """
    by_kind, arrays = {}, {}
    for r in rulesets:
        if isinstance(r.stop, stops.BlockStop) and r.stop.same_for_all_types and r.splitter.kind != "typed":
            by_kind.setdefault(r.splitter.kind, []).append(r)
    for kind, members in by_kind.items():
        if len(members) == 1:
            continue
        cut, marks, read = f"_{kind}_cut", f"_{kind}_marks", f"_{kind}_read"
        docs = docs.withColumn(cut, segment.blocks(F.col(DOC_TEXT), segment.Splitter(kind)))
        need_address = any(r.splitter.require_address for r in members)
        mark = lambda b, i: F.struct(
            i.alias("at"),
            segment.is_pickup(b).alias("pickup"),
            (segment.has_address(b) if need_address else F.lit(True)).alias("address"),
        )
        docs = docs.withColumn(marks, F.transform(cut, mark))

        def kept(r, kind_of_stop):
            wanted = lambda m: m["pickup"] if kind_of_stop == "pickup" else ~m["pickup"]
            ok = lambda m: wanted(m) & m["address"] if r.splitter.require_address else wanted(m)
            return F.slice(F.filter(marks, ok), 1, r.caps[kind_of_stop])["at"]

        at = {(r.name, t): f"_{kind}_{t}_{i}" for i, r in enumerate(members) for t in segment.TYPES}
        docs = docs.withColumns({at[r.name, t]: kept(r, t) for r in members for t in segment.TYPES})
        docs = docs.withColumn(f"_{kind}_used", F.array_distinct(F.concat(*at.values())))
        docs = docs.withColumn(cut, F.transform(f"_{kind}_used", lambda i: F.get(cut, i)))
        parsed, names = stops.parse_together(F.col(cut), [r.stop for r in members], "any")
        docs = docs.withColumn(read, parsed).drop(cut, marks)

        def stop_at(at_block, name):
            found = F.get(read, F.array_position(f"_{kind}_used", at_block).cast("int") - 1)
            return tx.let(found, lambda s: F.struct(*[s[name[f]].alias(f) for f in stops.FIELDS]))

        for r, name in zip(members, names):
            arrays[r.name] = {f"{t}_stops": F.transform(at[r.name, t], lambda i: stop_at(i, name)) for t in segment.TYPES}
    return docs, arrays


def extract_routed(df: DataFrame, rulesets: dict, source: str = "source", text: str = "text", keep=("source_file",)) -> DataFrame:
    """Each row goes through the rule set of its source; missing columns become ''.

    Rows of any other source, null included, are kept with empty fields; `routed` tells them apart. The input is read
    once, whether source is a partition column or not: every rule set stands beside the others on the row, and sees an
    empty text where the row is not its own.
    """
    docs = df.select(source, *keep, F.col(text).alias("_raw"))
    own = {name: F.col(source) == name for name in rulesets}
    order, rows = {}, {}
    for i, (name, rules) in enumerate(rulesets.items()):
        mine = F.when(own[name], tx.normalise(F.col("_raw"), rules.profile)).otherwise("")
        docs, out = _fields(docs.withColumn(DOC_TEXT, mine), rules)
        if rules.stamp:
            out["processed_at"] = processed_at(local=rules.stamp == "local")
        before = [c for _, columns in rows.values() for c in columns.values()]
        # columns of their own, not a struct, so that fields nobody reads are not extracted
        rows[i] = name, {f: f"_row{i}_{f}" for f in out}
        docs = docs.select(source, *keep, "_raw", *before, *[out[f].alias(c) for f, c in rows[i][1].items()])
        order |= dict.fromkeys(out)
        order.setdefault("routed")

    def value(field: str) -> Column:
        chosen = F.when(F.lit(False), None)
        for name, columns in rows.values():
            if field in columns:
                chosen = chosen.when(own[name], F.col(columns[field]))
        return chosen if field == "processed_at" else F.coalesce(chosen, F.lit(""))

    routed = F.coalesce(F.col(source).isin(list(rulesets)), F.lit(False))
    return docs.select(source, *keep, *[(routed if f == "routed" else value(f)).alias(f) for f in order])

"""Personal data: every entity gets a keyed surrogate of its own, the same one everywhere.

1. Entities are found in every text and reduced to (kind, value), the value without case or separators.
2. Each distinct entity gets a surrogate from a keyed hash: an address stays an address, a card number keeps
   its length and checksum, a name its script, and a given name the gender of the title before it.
3. Surrogates that two entities share, or that are real entities of the corpus, are drawn again, until none
   are left; so different entities stay different and no surrogate points at somebody in the corpus.
4. Mentions are replaced in the form in which they were written: separators and case stay.

Texts without entities are never shuffled; the others meet their surrogates by row.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

#: Titles before a name, and the gender they tell.
TITLES = {
    "m": ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "г-н", "господин"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "г-жа", "госпожа"),
    "": ("Dr", "Prof"),
}
_GENDER = {t.lower(): g for g, titles in TITLES.items() for t in titles}
_TITLE = "|".join(sorted(map(re.escape, (t for titles in TITLES.values() for t in titles)), key=len, reverse=True))
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERN = re.compile(
    r"(?P<email>[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<key>\bAKIA[0-9A-Z]{16}\b)"
    r"|(?P<secret>(?:(?<=(?i:password)=)|(?<=(?i:secret)=)|(?<=(?i:api_key)=)|(?<=(?i:token) = \"))[^\s\"']{6,})"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<card>(?<![\d.+-])\d(?:[ -]?\d){12,18}(?!\.?\d))"
    rf"|(?P<ip>(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d))"
    r"|(?P<phone>\+\d{1,3}(?:[ .-]?\(\d{1,4}\)(?:[ .-]?\d{2,4}){2}|[ .-]\d(?:[ .-]\d\d){4}|(?:[ .-]?\d{1,5}){2,3})(?!\d)|\(\d{3}\) ?\d{3}-\d{4}\b|(?<![\d.+-])\d{3}-\d{3}-\d{4}(?![\d-]))"
    rf"|\b(?P<title>{_TITLE})\.? (?P<name>[^\W\d_a-z]['’\w-]*[^\W\d_](?: [^\W\d_a-z]['’\w-]*[^\W\d_])?)"
)
#: The same without what a checksum decides.
UNCHECKED = re.compile(re.sub(r"\(\?P<(?:iban|card)>", r"\g<0>(?!)", PATTERN.pattern))
_RUN = re.compile(r"\d+(?:[ -]\d+)*")
#: Lengths of the groups in which card numbers are written.
_CARD_GROUPS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3), (4, 4, 4, 1), *((n,) for n in range(13, 20))}
#: What a text needs to hold any of these.
HINT = re.compile(rf"[@\d]|(?i:password=|token = |secret=|api_key=)|\b(?:{_TITLE})\.? ")
_DIGITS = ("card", "phone", "ssn")
_ONSETS, _VOWELS = "bdfghklmnprstvz", "aeiou"
_SCRIPTS = (("а", "я"), ("α", "ω"), ("א", "ת"), ("ا", "ي"), ("あ", "ん"), ("ア", "ン"), ("가", "힣"), ("一", "龥"))


def luhn(digits: str) -> bool:
    total = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def cards(text: str, start: int) -> tuple[list[tuple[int, int]], int]:
    """The card numbers in the run of digit groups from start, as (start, end), and the end of the run.

    Numbers in the usual groups come first, wherever in the run they begin; what is left of the run before them is
    one if it, or its start up to one of its separators, has the checksum.
    """
    run = _RUN.match(text, start)
    groups = [(start + m.start(), start + m.end()) for m in re.finditer(r"\d+", run[0])]
    ends = len(groups) - bool(re.match(r"\.\d", text[run.end() : run.end() + 2]))
    good = lambda i, j: 13 <= sum(b - a for a, b in groups[i:j]) <= 19 and luhn(re.sub(r"\D", "", text[groups[i][0] : groups[j - 1][1]]))
    found, i = [], 0
    while i < ends:
        # the longest first
        usual = (j for j in range(min(ends, i + 5), i, -1) if tuple(b - a for a, b in groups[i:j]) in _CARD_GROUPS and good(i, j))
        if j := next(usual, 0):
            found.append((i, j))
        i = max(j, i + 1)
    first = found[0][0] if found else ends
    if j := next((j for j in range(min(first, 19), 0, -1) if good(0, j)), 0):
        found.insert(0, (0, j))
    return [(groups[i][0], groups[j - 1][1]) for i, j in found], run.end()


def iban_end(text: str, start: int, end: int) -> int:
    """Where an IBAN from start ends: at the end or at a space before it; start if nowhere."""
    while end - start >= 15:
        value = text[start:end].replace(" ", "")
        if iban_check(value[:2], value[4:]) == value[2:4]:
            return end
        end = max(text.rfind(" ", start, end), start)
    return start


def _matches(text: str):
    """(match, kind, start, end) of every entity, in order; a number that fails its checksum hides nothing that is in it."""
    at = 0
    while m := PATTERN.search(text, at):
        kind, start, end = m.lastgroup, m.start(), m.end()
        if kind == "iban":
            end = iban_end(text, start, end)
            if end > start:
                yield m, kind, start, end
            elif other := UNCHECKED.match(text, start):
                yield other, other.lastgroup, other.start(other.lastgroup), other.end(other.lastgroup)
                end = other.end()
            else:
                end = start + 4
        elif kind == "card":
            found, end = cards(text, start)
            at = start
            for a, b in [*found, (end, end)]:
                # other kinds begin where a group of digits does
                for begin in [at + group.start() for group in re.finditer(r"\d+", text[at:a])]:
                    if begin >= at and (other := UNCHECKED.match(text, begin, a if a < end else len(text))):
                        yield other, other.lastgroup, other.start(other.lastgroup), other.end(other.lastgroup)
                        at = other.end()
                if a < b:
                    yield None, kind, a, b
                    at = b
            end = max(at, end)
        else:
            yield m, kind, m.start(kind), m.end(kind)
        at = end


def mentions(text: str):
    """(start, end, kind, value) of every entity, in order. A name gives one for each of its words."""
    if not HINT.search(text):
        return
    for m, kind, start, end in _matches(text):
        if kind == "name":
            words, at = m["name"].split(" "), m.start("name")
            gender = _GENDER[m["title"].lower()]
            for i, w in enumerate(words):
                yield at, at + len(w), "given_" + gender if i < len(words) - 1 else "surname", w.lower()
                at += len(w) + 1
            continue
        value = text[start:end]
        if kind in _DIGITS:
            value = re.sub(r"[^\d+]", "", value)
        elif kind == "email":
            value = value.lower()
        elif kind == "iban":
            value = value.replace(" ", "")
        yield start, end, kind, value


class _Draws:
    """Numbers that key, entity and attempt fix."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.key, self.of, self.n, self.pool = key, f"{kind}\0{value}\0{attempt}\0".encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hmac.new(self.key, self.of + str(self.n).encode(), hashlib.sha256).digest()
            self.n += 1
        out, self.pool = int.from_bytes(self.pool[:4], "big") % n, self.pool[4:]
        return out


def _alike(c: str, draws: _Draws) -> str:
    """A character of the same class and script."""
    if c.isascii():
        for first, last in (("0", "9"), ("a", "z"), ("A", "Z")):
            if first <= c <= last:
                return chr(ord(first) + draws.below(ord(last) - ord(first) + 1))
        return c
    for first, last in _SCRIPTS:
        if first <= c <= last:
            return chr(ord(first) + draws.below(ord(last) - ord(first) + 1))
    near = _neighbours(c)
    return near[draws.below(len(near))]


@lru_cache(4096)
def _neighbours(c: str) -> str:
    """The letters or digits of its kind among the 64 code points around a character, which share its script."""
    kind, first = unicodedata.category(c), ord(c) & ~63
    if kind[0] not in "LN":
        return c
    return "".join(chr(x) for x in range(first, first + 64) if unicodedata.category(chr(x)) == kind)


#: From this attempt on a surrogate may leave the form of its value, from the next one on it grows.
FREE, GROWS = 4, 6


def _changes(c: str) -> bool:
    """Whether _alike() has more than one character for this one."""
    return c.isalnum() if c.isascii() else any(a <= c <= b for a, b in _SCRIPTS) or len(_neighbours(c)) > 1


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """Another value of the same kind and form.

    Values whose form allows too few others (******, names of two letters, a block of numbers that is used up) get any
    letters and digits from the fifth attempt on, and one more with every attempt from the seventh on: the number of
    possible surrogates grows without bound, so drawing again comes to an end.
    """
    draws = _Draws(key, kind, value, attempt)
    more = max(0, attempt - GROWS + 1)
    if more:
        return _longer(_formed(key, kind, value, attempt, draws), kind, more, draws)
    return _formed(key, kind, value, attempt, draws)


def _longer(new: str, kind: str, more: int, draws: _Draws) -> str:
    digits = "".join(str(draws.below(10)) for _ in range(more))
    if kind == "ip":
        return new + "." + ".".join(digits)
    if kind == "email":
        return digits + new
    if kind == "card":
        body = new[:-1] + digits
        return next(body + str(c) for c in range(10) if luhn(body + str(c)))
    if kind == "iban":
        return new[:2] + iban_check(new[:2], new[4:] + digits) + new[4:] + digits
    letters = "abcdefghijklmnopqrstuvwxyz"
    if kind in ("surname", "secret") or kind.startswith("given"):
        return new + "".join(letters[draws.below(26)] for _ in range(more))
    return new + digits


def _formed(key: bytes, kind: str, value: str, attempt: int, draws: _Draws) -> str:
    if attempt >= FREE and kind in ("email", "secret", "surname", "given_", "given_f", "given_m"):
        value = "".join(c if c in "@." and kind == "email" else c if _changes(c) else "a" for c in value)
    if kind == "email":
        local, _, domain = value.partition("@")
        host, _, top = domain.rpartition(".")
        return "".join(_alike(c, draws) for c in local) + "@" + "".join(_alike(c, draws) for c in host) + "." + top
    if kind == "ip":
        return ".".join(str(1 + draws.below(254)) for _ in range(4))
    if kind == "card":
        body = value[0] + "".join(str(draws.below(10)) for _ in value[2:])
        return next(body + str(c) for c in range(10) if luhn(body + str(c)))
    if kind == "phone":
        keep = min(2 if value.startswith("+") else 0, len(value) - 4)
        return value[:keep] + "".join(str(draws.below(10)) for _ in value[keep:])
    if kind == "iban":
        rest = "".join(_alike(c, draws) for c in value[4:])
        return value[:2] + iban_check(value[:2], rest) + rest
    if kind == "key":
        return value[:4] + "".join(_alike(c, draws) for c in value[4:])
    if kind == "surname" or kind.startswith("given"):
        if not any("a" <= c <= "z" for c in value):
            return "".join(_alike(c, draws) for c in value)  # another script
        size = 2 + draws.below(2) + attempt // 4  # more syllables when short names run out
        word = "".join(_ONSETS[draws.below(len(_ONSETS))] + _VOWELS[draws.below(len(_VOWELS))] for _ in range(size))
        ending = {"given_f": "a", "given_m": "o"}.get(kind, "nrsl"[draws.below(4)])
        return word[:-1] + ending if kind in ("given_f", "given_m") else word + ending
    if kind == "secret" and (m := re.fullmatch("([0-9a-f]+)|[0-9A-F]+", value)):
        return "".join(("0123456789abcdef" if m[1] else "0123456789ABCDEF")[draws.below(16)] for _ in value)
    return "".join(_alike(c, draws) for c in value)


def written(mention: str, kind: str, new: str) -> str:
    """A surrogate in the form of a mention: its separators, its case."""
    if kind in (*_DIGITS, "iban"):
        chars = iter(c for c in new if c != "+")
        return "".join(next(chars, "") if c.isalnum() else c for c in mention) + "".join(chars)
    if kind == "email":
        return "".join(n.upper() if m.isupper() else n for m, n in zip(mention, new)) if len(mention) == len(new) else new
    if kind == "surname" or kind.startswith("given"):
        return new.upper() if len(mention) > 1 and mention.isupper() else new[:1].upper() + new[1:]
    return new


_ENTITIES = pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string())]))


def _with_entities(batches):
    """(row, id, text) -> the rows whose text has entities, with the distinct ones."""
    for batch in batches:
        keep, found = [], []
        for text in batch.column(2):
            seen = dict.fromkeys((k, v) for _, _, k, v in mentions(text.as_py() or ""))
            keep.append(bool(seen))
            if seen:
                found.append([{"kind": k, "value": v} for k, v in seen])
        rows = batch.filter(pa.array(keep, pa.bool_()))
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(found, _ENTITIES)], ["row", "doc_id", "text", "entities"])


def _without_entities(batches):
    for batch in batches:
        keep = [next(mentions(t.as_py() or ""), None) is None for t in batch.column(1)]
        yield batch.filter(pa.array(keep, pa.bool_()))


def _drawn(key: bytes):
    def run(batches):
        for batch in batches:
            new = [surrogate(key, *x) for x in zip(*(batch.column(i).to_pylist() for i in range(3)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], ["kind", "value", "attempt", "surrogate"])

    return run


def _replaced(batches):
    for batch in batches:
        texts, counts = [], []
        for text, pairs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            new = {(p["kind"], p["value"]): p["surrogate"] for p in pairs}
            out, at, n = [], 0, 0
            for a, b, kind, value in mentions(text):
                out += [text[at:a], written(text[a:b], kind, new[kind, value])]
                at, n = b, n + 1
            texts.append("".join(out) + text[at:])
            counts.append(n)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "n_entities", "text"])


def surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, surrogate) for distinct (kind, value): surrogates differ and are no values of that kind."""
    draw = lambda df: df.mapInArrow(_drawn(key), "kind string, value string, attempt int, surrogate string")
    entities = stored(entities, "entities")
    now = stored(draw(entities.withColumn("attempt", F.lit(0))), "surrogates")
    real = entities.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("real"))
    while True:
        # of those that share one, the earliest drawn keeps it; nobody keeps one that is real
        first = now.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "value")).alias("first"), F.count(F.lit(1)).alias("n"))
        marked = now.join(first, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        again = F.coalesce("real", F.lit(False)) | (F.col("first.value") != F.col("value"))
        marked = stored(marked.select("kind", "value", "attempt", "surrogate", again.alias("again")), "marked")
        again = marked.filter("again")
        if again.isEmpty():
            return now.select("kind", "value", "surrogate")
        kept = marked.filter("NOT again").drop("again")
        more = draw(again.select("kind", "value", (F.col("attempt") + 1).alias("attempt")))
        now = stored(kept.unionByName(more), "surrogates")


def replace_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", key: bytes = b"loadlens") -> DataFrame:
    """One row per document: doc_id, n_entities (mentions replaced), text.

    Null texts come out as ''. Texts without entities come out as they are. Rows that repeat are replaced alike. Other
    columns are not read; a table without rows gives none. The same key gives the same surrogates for the same
    documents. A surrogate has the domain's last part, a card's first digit, a telephone number's first country
    digit, and the length, separators and case of what it replaces; names have the script and the gender of their title.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    hits = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(
        _with_entities, f"row long, doc_id {kind}, text string, entities array<struct<kind:string,value:string>>"
    )
    hits = stored(hits, "hits")
    each = hits.select("row", F.inline("entities"))
    new = surrogates(each.select("kind", "value").distinct(), key)
    pairs = each.join(new, ["kind", "value"]).groupBy("row").agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias("pairs"))
    changed = hits.select("row", "doc_id", "text").join(pairs, "row").select("doc_id", "text", "pairs").mapInArrow(
        _replaced, f"doc_id {kind}, n_entities long, text string"
    )
    same = docs.mapInArrow(_without_entities, docs.schema).select("doc_id", F.lit(0).cast("long").alias("n_entities"), "text")
    return same.unionByName(changed)

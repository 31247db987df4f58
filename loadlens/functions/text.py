"""Text and path scalars: plain Column -> Column functions on built-in expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separates captured groups inside one string. U+FDD0 is a Unicode noncharacter:
# it never occurs in interchanged text.
SEP = "\ufdd0"

# The characters that count as white space at the ends of a value.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# An address can start only at the beginning of a run of its characters, or where the
# previous match ended, so no run is scanned twice.
EMAIL = r"(?<![\w.\-](?!\G))[\w.\-]++@[\w.\-]+\.\w+"


def rx(pattern: str, flags: str = "i") -> str:
    """Pattern with Unicode classes, LF as the only line end, and the given flags."""
    return f"(?dU{flags})" + (quick_start(pattern) if "i" in flags else pattern)


def quick_start(pattern: str) -> str:
    """The same pattern, for any case, with its first letter as a class, which fails faster than a word does.

    Only letters whose other forms are ASCII, and only those that nothing repeats.
    """
    return re.sub(r"\A([A-HJLM-RT-Za-hjlm-rt-z])(?=[\w\s])", r"[\1]", pattern)


def strip(c: Column) -> Column:
    """Remove white space of any kind at both ends (plain trim() removes spaces only)."""
    return F.trim(c, F.lit(WHITE_SPACE))


def filled(c: Column) -> Column:
    """Whether something is left of a value when it is stripped; a null is empty."""
    return F.coalesce(c, F.lit("")).rlike(rx(f"[!-~]|[^{WHITE_SPACE}]", ""))


# White space that is to become one space; a space alone in front of a visible character is passed over.
RUNS = r"(?=[^!-~])(?! [!-~])\s+"


def collapse(c: Column) -> Column:
    """White-space runs become one space; both ends are stripped."""
    return F.trim(F.regexp_replace(c, rx(RUNS, ""), " "))


def extract(c: Column, pattern: str, group: int = 1, flags: str = "i") -> Column:
    """Group of the first match, stripped; '' without a match."""
    return strip(F.regexp_extract(c, rx(pattern, flags), group))


def in_order(*pieces: str) -> str:
    """A pattern that holds only if the pieces come one after the other.

    Each piece is looked for once, after the one before, and never again: one pass over any text.
    """
    return r"\A" + "".join(rf"(?>(?s:.*?)(?:{p}))" for p in pieces)


def after_first(label: str, rest: str) -> str:
    """A pattern for rest right after the first label, which is looked for once.

    The same as label + rest wherever rest, if it holds after a later label, holds after the first one too: then no
    other label has to be tried, and a text without a match is given up in one pass.
    """
    return rf"\A(?>(?s:.*?)(?:{label}))(?:{rest})"


def captures(c: Column, pattern: str, groups: int, flags: str = "i", guard: str | None = None) -> Column:
    """Groups 1..n of the first match as an array read with get(a, g).

    One search serves all groups. Without a match every get(a, g >= 1) is null.
    Keep the result in a column of its own before reading several groups. guard: a cheap
    pattern that every text with a match fulfils; other texts are not tried.
    """
    # what lies before a match is no value
    blank = lambda a: F.when(F.size(a) > 1, F.concat(F.array(F.lit("")), F.slice(a, 2, groups))).otherwise(a)
    return let(captured(c, pattern, groups, flags, guard), blank)


# Fixed value: characters of a text up to which no guard is asked.
UNGUARDED = 1500


def captured(c: Column, pattern: str, groups: int, flags: str = "i", guard: str | None = None) -> Column:
    """captures() that spares blanking entry 0, the text before the match."""
    # a plain search: a lazy gap in front costs several times as much
    rest = rx("(?:" + (quick_start(pattern) if "i" in flags else pattern) + r")(?s:.*)\z", flags)
    found = F.split(F.regexp_replace(c, rest, "".join(f"{SEP}${g}" for g in range(1, groups + 1))), SEP)
    # in a short text the pattern costs less than its guard, with or without a match
    return found if guard is None else F.when((F.length(c) <= UNGUARDED) | c.rlike(rx(guard, flags)), found)


def group(caps: Column, g: int) -> Column:
    """Stripped group g of captures(), '' without a match."""
    return F.coalesce(strip(F.get(caps, F.lit(g))), F.lit(""))


# What street numbers, streets and cities of an invoice address are made of.
STREET = r"[A-Za-z0-9#.,\s]"
CITY = r"[A-Za-z\s]"
STATE_AND_ZIP = r",\s*([A-Z]{2})\s*(\d{5})"


def invoice_address(c: Column) -> Column:
    """Street, city, state and zip code as captures() would give them for
    (\\d{1,6}\\s+[street]+?)\\s*(?:\\n|,)?\\s*([city]+),\\s*([A-Z]{2})\\s*(\\d{5}), in time linear in the text.

    All of a match lies in one run of street characters, and if any number of the run starts a match, its first one does.
    So each run is taken from its first number on, searched for ', ST 12345' behind a city character, and the city is
    then read backwards from there.
    """
    runs = F.regexp_extract_all(c, F.lit(rx(rf"\d{{1,6}}\s{STREET}*+")), F.lit(0))
    # a number, white space and one more character; without one, a space of its own counts as such
    found = F.transform(
        runs,
        lambda r: captures(r, rf"\A(?:(\d{{1,6}}\s++{STREET})((?s:.*?){CITY})|(\d{{1,6}}\s+\s)({CITY})){STATE_AND_ZIP}", 6),
    )
    first = F.get(F.filter(found, lambda f: F.size(f) > 1), F.lit(0))

    def parts(f: Column) -> Column:
        head = F.concat(F.get(f, F.lit(1)), F.get(f, F.lit(3)))
        rest = F.concat(F.get(f, F.lit(2)), F.get(f, F.lit(4)))
        city = F.reverse(F.regexp_extract(F.reverse(rest), rx(rf"\A{CITY}++"), 0))
        before = F.left(rest, F.length(rest) - F.length(city))
        street = F.concat(head, F.regexp_replace(before, rx(r",\z", ""), ""))
        return F.array(F.lit(""), street, city, F.get(f, F.lit(5)), F.get(f, F.lit(6)))

    return F.when(first.isNotNull(), let(first, parts))


def first_filled(*cols: Column) -> Column:
    """First value that is neither null nor ''; else ''."""
    if not cols:
        return F.lit("")
    # each column is in the plan once, and the next one is tried only if it is empty
    return let(F.coalesce(cols[0], F.lit("")), lambda v: F.when(v != "", v).otherwise(first_filled(*cols[1:])))


def replace_all(c: Column, steps) -> Column:
    """Apply (pattern, replacement, flags) steps in order.

    Where several steps have nothing to replace, one search for all of them tells so.
    """
    if len(steps) < 3:
        return replace_each(c, steps)
    some = rx("|".join(f"(?{s[2]}:{quick_start(s[0]) if 'i' in s[2] else s[0]})" for s in steps), "")
    return let(c, lambda t: F.when(t.rlike(some), replace_each(t, steps)).otherwise(t))


def replace_each(c: Column, steps) -> Column:
    """replace_all() by a search per step: on a few words that costs less than one search for all of them."""
    return reduce(lambda acc, s: F.regexp_replace(acc, rx(s[0], s[2]), s[1]), steps, c)


# Normalisation steps (pattern, replacement, flags, literals), in order. A step with literals is skipped
# for text that contains none of them; a step (literal, replacement) needs no pattern. Most texts need few of the steps,
# and looking for a literal costs a fraction of a search by a pattern.
SPACES = [
    # a space alone stays as it is
    (r"[\t\u00A0][ \t\u00A0]*+| [ \t\u00A0]++", " ", "", ("\t", "\u00A0", "  ")),
    ("\r\n", "\n"),
    ("\r", "\n"),
    (r"\n{3,}", "\n\n", "", ("\n\n\n",)),
]
MARKS = (r"\*{2,}", "", "", ("**",))
# captures() relies on text without its separator
NO_SEPARATOR = (SEP, "")
BLOCK_STEPS = [NO_SEPARATOR, MARKS, *SPACES]
LINE_STEPS = [
    NO_SEPARATOR,
    MARKS,
    # a class is tried faster than the first letter of a word
    (r"[P]ickUp\b", "Pickup", "i", None),
    (r"Del\.\s*Date", "Delivery Date", "i", ("l.", "L.")),
    # a long s is an s to a pattern that ignores case
    (r"Miami Lake,s", "Miami Lakes", "i", (",s", ",S", ",\u017F")),
    *SPACES,
    # looks back only from a line end
    (r"(?=\n)(?<=\w)\n(?=[A-Z0-9])", " ", "", ("\n",)),
    # trims every line and drops the blank ones; the leading checks skip other positions, a space inside a line and a
    # line end that stays as it is
    (r"(?=[^!-~])(?![ \n][!-~])(?=[\s\u001C-\u001E])\s*[\n\u000B\u000C\u001C-\u001E\u0085\u2028\u2029]\s*", "\n", "", None),
]
FLAT_STEPS = [
    NO_SEPARATOR,
    ("*", ""),
    (RUNS, " ", "", None),
]

NORMALISERS = {"blocks": BLOCK_STEPS, "lines": LINE_STEPS, "flat": FLAT_STEPS}


def let(value: Column, use) -> Column:
    """use(value), with value computed once however often use() reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def normalise(c: Column, profile: str = "blocks") -> Column:
    """Clean document text with the 'blocks', 'lines' or 'flat' profile; null becomes ''."""
    text = F.coalesce(c, F.lit(""))
    for step in NORMALISERS[profile]:
        if len(step) == 2:
            literals, clean = step[:1], lambda t: F.replace(t, F.lit(step[0]), F.lit(step[1]))
        else:
            pattern, by, flags, literals = step
            clean = lambda t: F.regexp_replace(t, rx(pattern, flags), by)
        if literals is None:
            text = clean(text)
        else:
            some = lambda t: reduce(lambda a, b: a | b, [F.contains(t, F.lit(x)) for x in literals])
            text = let(text, lambda t: F.when(some(t), clean(t)).otherwise(t))
    return strip(text)


def money(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(""))


def first_amount(text: Column, patterns) -> Column:
    """Amount of the first pattern that matches, without thousands commas."""
    return money(first_filled(*[extract(text, p) for p in patterns]))


def emails(text: Column) -> Column:
    """All e-mails in order. Only the words next to an '@' go through the pattern."""
    near = F.transform(
        F.split(text, "@"),
        lambda p: F.when(
            F.contains(p, F.lit(" ")),
            F.concat_ws(" ", F.substring_index(p, " ", 1), F.substring_index(p, " ", -1)),
        ).otherwise(p),
    )
    return F.regexp_extract_all(F.array_join(near, "@"), F.lit(rx(EMAIL, "")), F.lit(0))


def emails_joined(text: Column, fold: bool = False) -> Column:
    """Distinct e-mails, sorted, joined by '; '; fold lower-cases after sorting."""
    joined = F.array_join(F.array_sort(F.array_distinct(emails(text))), "; ")
    return F.lower(joined) if fold else joined


def first_email_outside(text: Column, domain: str) -> Column:
    """First e-mail that does not contain the domain; '' if there is none."""
    outside = F.filter(emails(text), lambda e: ~F.contains(F.lower(e), F.lit(domain)))
    return F.coalesce(F.get(outside, F.lit(0)), F.lit(""))


def canonical_path(path: Column, steps) -> Column:
    """Path rewriting with an ordered list of (pattern, replacement)."""
    return reduce(lambda acc, s: F.regexp_replace(acc, s[0], s[1]), steps, path)


# Path rewriting per reader generation (pattern, replacement), in order.
# Only %20 is decoded, so '+' and other escapes stay as they are.
PATH_STEPS = {
    "current": [
        (r"^dbfs:", ""),
        (r"^file:", ""),
        (r"/txt_pymupdf4llm/", "/pdf/"),
        (r"\.txt$", ".pdf"),
        (r"%20", " "),
    ],
    "no_file_prefix": [
        (r"^dbfs:", ""),
        (r"/txt_pymupdf4llm/", "/pdf/"),
        (r"\.txt$", ".pdf"),
        (r"%20", " "),
    ],
    "any_folder": [
        (r"^dbfs:", ""),
        (r"raw/cy/[^/]+/", "raw/cy/pdf/"),
        (r"\.txt$", ".pdf"),
        (r"%20", " "),
    ],
    "flat": [
        (r"dbfs:", ""),
        (r"txt_llm", "pdf"),
        (r"\.txt$", ".pdf"),
        (r"%20", " "),
    ],
    "raw": [],
}

# Literal, un-anchored replacements applied before comparing paths.
COMPARE_PATH_LITERALS = [("dbfs:", ""), ("/txt_pymupdf4llm/", "/pdf/"), (".txt", ".pdf")]


def comparable_path(path: Column) -> Column:
    """Path form used when comparing a target with the truth."""
    replaced = reduce(
        lambda acc, s: F.replace(acc, F.lit(s[0]), F.lit(s[1])),
        COMPARE_PATH_LITERALS,
        F.coalesce(path, F.lit("")),
    )
    return strip(replaced)


def output_path(path: Column, input_root: str, output_root: str) -> Column:
    """Text path for a source file: sub-directory kept, extension replaced by .txt."""
    relative = F.substring(path, F.lit(len(input_root.rstrip("/")) + 2), F.length(path))
    # a leading dot belongs to the name and is no extension
    stem = F.regexp_replace(relative, r"([^/.]\.*)\.[^./]*$", "$1")
    return F.concat(F.lit(output_root.rstrip("/") + "/"), stem, F.lit(".txt"))


def compare_key(c: Column) -> Column:
    """Value form used when comparing fields: null and '' are equal, case is ignored."""
    return F.lower(strip(F.coalesce(c, F.lit(""))))

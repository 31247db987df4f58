"""Main text of web pages: blocks labelled content or boilerplate by a minimum cut.

A page is cut into blocks, the runs of text between block-level tags. A linear classifier gives each block a score; a
positive score is the capacity from the source (what it costs to call the block boilerplate), a negative one the capacity
to the sink. Blocks that follow each other are linked, the more the closer they are in the document tree, and every block
is linked with its containers, so blocks of one container hold together. The minimum cut is the labelling of least cost.

Nodes whose score outweighs all their links are settled first, which passes their links on as scores; only nodes that
stay open go into the maximum flow. This changes no minimum. One page is one row, at any size: the parser and the settling
are linear, and what is open after it is short runs between settled blocks.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
RAW = frozenset("script style noscript template textarea select button iframe object svg canvas audio video title head xmp noframes".split())
#: Of these, the ones whose content is not markup: only their own end tag ends them.
PLAIN = frozenset("script style textarea title iframe noscript xmp noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody"
    " td tfoot th thead tr ul".split()
)
#: A start tag that ends an open element, up to the nearest of the elements that hold it.
PARAGRAPHS, NONE = frozenset(["p"]), (frozenset(), frozenset())
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    **{t: (frozenset(["dt", "dd"]), frozenset(["dl"])) for t in ("dt", "dd")},
    **{t: (frozenset(["td", "th"]), frozenset(["tr", "table"])) for t in ("td", "th")},
    "tr": (frozenset(["tr"]), frozenset(["table", "tbody", "thead", "tfoot"])),
}
#: Elements nested deeper hang on the element of this depth, as in browsers; their text stays.
DEEPEST = 512
#: Elements that a paragraph's implied end does not reach beyond.
HOLDS_P = frozenset("td th caption table button object html body article section div li aside main".split())

# The words below are fixed values: what elements, roles and names of classes say.
AWAY_TAGS = frozenset("nav footer aside menu dialog search".split())
AWAY_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
MAIN_ROLES = frozenset("main article".split())
AWAY_WORDS = frozenset(
    "ad ads adbox adslot adv nav navbar topnav menu header masthead topbar footer sidebar aside cookie cookies gdpr consent notice"
    " notification alert banner popup modal overlay dialog share sharing social follow related recommended trending promo promotion"
    " sponsor sponsored newsletter subscribe subscription signup login breadcrumb breadcrumbs pagination pager comment comments"
    " commentlist disqus respond reply replies discussion toolbar widget widgets search form teaser outbrain taboola copyright".split()
)
AWAY_STEMS = ("advert", "sponsor", "comment", "cookie", "sidebar", "breadcrumb", "newsletter", "navigation", "promot", "disclaimer")
MAIN_WORDS = frozenset("article post entry story content main body text prose".split())
NEGATED = frozenset("has no with without not is".split())
LEGAL = re.compile(r"©|\bcopyright\b|all rights reserved|\bprivacy policy\b|\bterms of (?:use|service)\b|\baccept (?:all )?cookies\b", re.I)

#: Scores of the classifier and capacities of the links.
AWAY, MAIN, MAIN_CLASS, OUTSIDE = -1000, 400, 200, -250
PLAIN_BLOCK, WORD, MOST_WORDS, SENTENCE, PARAGRAPH, HEADING, LINKS, LEGAL_WORDS = -60, 12, 30, 40, 60, 40, -180, -300
FOLLOWS, CONTAINS, CONTAINER, APART = 60, 40, 20, 4

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
NAME = re.compile(r"(?:class|id|role|itemprop|hidden|aria-hidden|style)\b", re.I)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORDS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Page:
    """Elements by number (tag, parent, what they say), and blocks (element, texts, characters in links)."""

    tags: list = field(default_factory=lambda: ["#"])
    parents: list = field(default_factory=lambda: [0])
    says: list = field(default_factory=lambda: [0])  # -2: by its tag, -1: by a class or form, 1: class of content, 2: main text
    owner: list = field(default_factory=list)
    texts: list = field(default_factory=list)
    linked: list = field(default_factory=list)


def said(tag: str, attributes: str) -> int:
    """What an element says of its text; see Page.says."""
    says = -2 if tag in AWAY_TAGS else 2 if tag in ("article", "main") else -1 if tag == "form" else 0
    if not attributes or not NAME.search(attributes):
        return says
    words, best = [], says
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), values[0] or values[1] or values[2]
        if name in ("class", "id"):
            words += WORDS.findall(CAMEL.sub(" ", value).lower()) + ["."]
        elif name == "role":
            roles = set(value.lower().split())
            best = -2 if roles & AWAY_ROLES else max(best, 2) if roles & MAIN_ROLES else best
        elif name == "itemprop":
            best = max(best, 2) if "articlebody" in value.lower() else -2 if "comment" in value.lower() else best
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return -2
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return -2
    if best <= -2 or tag in ("html", "body"):
        return best
    main = not MAIN_WORDS.isdisjoint(words)
    before = "."
    for w in words:
        away = w in AWAY_WORDS or w.startswith(AWAY_STEMS)
        # the header of an article is its title; has-sidebar speaks of the page
        if away and before not in NEGATED and not (w == "header" and main):
            return -1
        before = w
    return max(best, 1) if main and best >= 0 else best


def parse(text: str) -> Page:
    """The elements and blocks of a page, whatever is wrong with its markup."""
    page = Page()
    stack, links, beyond = [0], 0, 0
    pieces, in_links = [], 0
    at, size, quoted = 0, len(text), True
    skipped, inside = None, 0  # the element whose text is left out, and how many of its name are open

    def close_block():
        nonlocal pieces, in_links
        if pieces:
            # references may stand across pieces only where markup parts them, so each is decoded by itself
            whole = " ".join("".join(pieces).split())
            if whole:
                page.owner.append(stack[-1])
                page.texts.append(whole)
                page.linked.append(in_links / len(whole))
            pieces, in_links = [], 0

    def put(piece: str):
        nonlocal in_links
        if skipped:
            return
        if "&" in piece:
            piece = html.unescape(piece)
        pieces.append(piece)
        if links:
            in_links += len(piece)

    while at < size:
        lt = text.find("<", at)
        if lt < 0:
            put(text[at:])
            break
        if lt > at:
            put(text[at:lt])
        mark = text[lt + 1 : lt + 2]
        if mark in "!?" and mark:
            if text.startswith("<!--", lt):
                end = text.find("-->", lt + 4)
                at = size if end < 0 else end + 3
            else:
                end = text.find(">", lt)
                at = size if end < 0 else end + 1
            continue
        if not (mark.isascii() and mark.isalpha() or mark == "/" and text[lt + 2 : lt + 3].isalpha()):
            if mark == "/":  # </ and no name: a comment up to >
                end = text.find(">", lt)
                at = size if end < 0 else end + 1
            else:
                put("<")
                at = lt + 1
            continue
        m = TAG.match(text, lt) if quoted else None
        if m:
            closing, tag, attributes, at = m[1], m[2].lower(), m[3], m.end()
        else:  # a quote without its end: the tag goes up to the next >
            quoted = False
            end = text.find(">", lt)
            if end < 0:
                break
            closing = "/" if mark == "/" else ""
            name = re.match(r"/?([^\s/>]*)", text[lt + 1 : end])
            tag, attributes, at = name[1].lower(), text[lt + 1 + name.end() : end], end + 1
        if skipped and (tag == skipped or closing and tag in BLOCK and not beyond and _open(page, stack, tag)):
            # it ends by its own end tag, or with the element around it
            inside += (tag != skipped and -inside) or (-1 if closing else 1)
            if not inside:
                skipped = None
            if tag == skipped or tag in RAW or tag not in BLOCK:
                continue
        if tag in PLAIN and not closing:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(text, at)
            at = text.find(">", end.end() - 1) + 1 if end else 0
            if not at:
                break
            continue
        if skipped:
            continue
        if closing:
            if tag in BLOCK:
                close_block()
                if beyond:
                    beyond -= 1
                else:
                    i = _open(page, stack, tag)
                    if i:
                        del stack[i:]
            elif tag == "a":
                links = 0
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                skipped, inside = tag, 1
        elif tag in BLOCK:
            close_block()
            if tag == "hr":
                continue
            _imply(page, stack, tag)
            if len(stack) > DEEPEST:
                beyond += 1
                continue
            page.tags.append(tag)
            page.parents.append(stack[-1])
            page.says.append(said(tag, attributes))
            stack.append(len(page.tags) - 1)
        elif tag == "br":
            pieces.append(" ")
        elif tag == "a":
            links = 1
        elif tag not in VOID and attributes and NAME.search(attributes) and said(tag, attributes) == -2:
            skipped, inside = tag, 1  # hidden words within a line
    close_block()
    return page


def _open(page: Page, stack: list, tag: str) -> int:
    """The place in the stack of the innermost open element of this name, 0 if there is none."""
    return next((i for i in range(len(stack) - 1, 0, -1) if page.tags[stack[i]] == tag), 0)


def _imply(page: Page, stack: list, tag: str) -> None:
    """End what this start tag ends."""
    for ended, held in (ENDS.get(tag, NONE), (PARAGRAPHS, HOLDS_P)):
        for i in range(len(stack) - 1, 0, -1) if ended else ():
            t = page.tags[stack[i]]
            if t in ended:
                del stack[i:]
                break
            if t in held:
                break


def scores(page: Page) -> tuple[list[int], list[int]]:
    """The classifier's score of each block, and what holds of each element: -1 away, 1 main text, 0 neither."""
    tags, parents, says = page.tags, page.parents, list(page.says)
    n = len(tags)
    # a wrapper that holds the main text says nothing, whatever it is called
    main, titled = [False] * n, [False] * n
    for i in range(n - 1, 0, -1):
        titled[i] = titled[i] or tags[i] == "h1"
        own = says[i] == 2 and (tags[i] == "main" or titled[i])
        main[i] = main[i] or own
        if says[i] == -1 and main[i]:
            says[i] = 0
        if says[i] >= 0:
            titled[parents[i]] |= titled[i]
            main[parents[i]] |= main[i]
    state, kind = [0] * n, [0] * n
    for i in range(1, n):
        up, own = state[parents[i]], says[i]
        if own == 0 and tags[i] == "header" and up != 1:
            own = -2
        state[i] = -1 if up < 0 or own < 0 else 1 if up == 1 or own == 2 else 0
        kind[i] = max(kind[parents[i]], own == 1)
    has_main = any(s == 1 for s in state)
    out = []
    for owner, text, linked in zip(page.owner, page.texts, page.linked):
        if state[owner] < 0:
            out.append(AWAY)
            continue
        tag = tags[owner]
        words = text.count(" ", 0, 400) + 1
        score = PLAIN_BLOCK + WORD * min(words, MOST_WORDS) + int(LINKS * min(linked, 1.0))
        if text[-1] in ".!?…。！？»”\"'":
            score += SENTENCE
        score += PARAGRAPH if tag in ("p", "blockquote", "pre", "figcaption") else HEADING if tag[0] == "h" and tag[1:].isdigit() else 0
        if state[owner]:
            score += MAIN
        else:
            score += MAIN_CLASS * kind[owner] + OUTSIDE * has_main
            if words < 60 and LEGAL.search(text):
                score += LEGAL_WORDS
        out.append(score)
    return out, state


def links(page: Page, state: list[int]) -> tuple[list[dict], int]:
    """Capacities by node: blocks first, then elements with blocks below; and the number of nodes."""
    blocks = len(page.owner)
    number, near = {}, [{} for _ in range(blocks)]
    parents = page.parents

    def link(a: int, b: int, capacity: int) -> None:
        near[a][b] = near[a].get(b, 0) + capacity
        near[b][a] = near[b].get(a, 0) + capacity

    depth = [0] * len(parents)
    for i in range(1, len(parents)):
        depth[i] = depth[parents[i]] + 1
    for k, owner in enumerate(page.owner):
        below, capacity = k, CONTAINS
        e = parents[owner]
        while True:
            known = e in number
            if not known:
                number[e] = len(near)
                near.append({})
            link(below, number[e], capacity)
            if known or not e:
                break
            below, capacity = number[e], CONTAINER if state[e] == state[parents[e]] else APART
            e = parents[e]
        if k:
            a, b, apart = page.owner[k - 1], owner, 0
            while a != b and apart < 6:
                if depth[a] >= depth[b]:
                    a = parents[a]
                else:
                    b = parents[b]
                apart += 1
            link(k - 1, k, FOLLOWS // max(1, apart - 1) if state[page.owner[k - 1]] == state[owner] else APART)
    return near, len(near)


def minimum_cut(score: list[int], near: list[dict]) -> list[bool]:
    """Which nodes lie on the source's side of a minimum cut; nodes that may lie on either side do not.

    score: capacity from the source if positive, to the sink if negative; near: capacities between nodes, both ways.
    """
    n = len(score)
    value, side = list(score), [None] * n
    open_links = [sum(x.values()) for x in near]
    # a node that outweighs its open links is settled, and its links weigh on its neighbours
    queue = deque(i for i in range(n) if abs(value[i]) >= open_links[i])
    while queue:
        i = queue.popleft()
        if side[i] is not None or not (value[i] > open_links[i] or -value[i] >= open_links[i]):
            continue
        side[i] = value[i] > open_links[i]
        for j, c in near[i].items():
            if side[j] is None:
                value[j] += c if side[i] else -c
                open_links[j] -= c
                if abs(value[j]) >= open_links[j]:
                    queue.append(j)
    left = [i for i in range(n) if side[i] is None]
    if left:
        for i, s in zip(left, _flow(left, value, near, side)):
            side[i] = s
    return side


def _flow(left: list[int], value: list[int], near: list[dict], side: list) -> list[bool]:
    """Maximum flow by shortest augmenting levels; True for nodes that the source still reaches."""
    at = {i: k for k, i in enumerate(left)}
    rest = [{at[j]: c for j, c in near[i].items() if side[j] is None} for i in left]
    extra = [max(value[i], 0) for i in left]
    room = [max(-value[i], 0) for i in left]
    while True:
        level = [0 if x else -1 for x in extra]
        queue = deque(k for k, x in enumerate(extra) if x)
        found = False
        while queue:
            k = queue.popleft()
            if room[k]:
                found = True
            for j, c in rest[k].items():
                if c and level[j] < 0:
                    level[j] = level[k] + 1
                    queue.append(j)
        if not found:
            return [x >= 0 for x in level]
        after = [iter(list(r)) for r in rest]
        for k, x in enumerate(extra):
            path = [k]
            while x and path:
                here = path[-1]
                if room[here]:
                    amount = min([x, room[here]] + [rest[a][b] for a, b in zip(path, path[1:])])
                    x -= amount
                    room[here] -= amount
                    for a, b in zip(path, path[1:]):
                        rest[a][b] -= amount
                        rest[b][a] += amount
                    full = next((i for i, (a, b) in enumerate(zip(path, path[1:])) if not rest[a][b]), None)
                    if full is not None:
                        del path[full + 1 :]
                    continue
                for j in after[here]:
                    if rest[here][j] and level[j] == level[here] + 1:
                        path.append(j)
                        break
                else:
                    path.pop()
            extra[k] = x


def labelled(text: str | None) -> list[tuple[str, str, int, bool]]:
    """(tag, text, score, content) of the blocks of a page in page order; null and empty have none."""
    if not text:
        return []
    page = parse(text)
    if not page.owner:
        return []
    score, state = scores(page)
    near, nodes = links(page, state)
    side = minimum_cut(score + [0] * (nodes - len(score)), near)
    return [(page.tags[o], t, s, c) for o, t, s, c in zip(page.owner, page.texts, score, side)]


def main_text(text: str | None) -> str:
    return "\n\n".join(t for _, t, _, content in labelled(text) if content)


def _batches(rows: Iterator[tuple], columns: tuple, types: tuple, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows as batches that end after `most` characters of text (third column)."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[2] or "") + 64
        if chars > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=columns)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=columns)


def _mapped(pages: DataFrame, rows, added: list) -> DataFrame:
    """rows(page_id, url, html) -> tuples that begin with page_id and url, over all pages."""
    from pyspark.sql.pandas.types import to_arrow_schema

    read = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    schema = T.StructType([*read.schema.fields[:2], *added])
    arrow = to_arrow_schema(schema)

    def run(batches):
        each = (row for b in batches for values in zip(*(c.to_pylist() for c in b.columns)) for row in rows(*values))
        return _batches(each, tuple(schema.names), tuple(arrow.types))

    return read.mapInArrow(run, schema)


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: the main text, one row per row of pages.

    Character references are decoded, white space within a block becomes one space, and blocks are joined by an empty
    line. Null, empty and textless pages give the empty text; page_id and url, null or not, go through; equal rows give
    equal rows; an empty table gives none; columns of other names are not read.
    """
    added = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return _mapped(pages, lambda i, u, h: [(i, u, t := main_text(h), len(t))], added)


def label_blocks(pages: DataFrame) -> DataFrame:
    """page_id, url, text, block (number in the page), tag, score, content: every block with its label."""
    kinds = (("text", T.StringType()), ("block", T.LongType()), ("tag", T.StringType()), ("score", T.LongType()), ("content", T.BooleanType()))
    rows = lambda i, u, h: ((i, u, t, k, tag, s, c) for k, (tag, t, s, c) in enumerate(labelled(h)))
    return _mapped(pages, rows, [T.StructField(*x) for x in kinds])

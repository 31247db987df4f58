"""HTML extraction: the cut against all labellings, the query against a plain reading of the test pages."""

import html as h
import itertools
import random
import re
import time

import pytest

from loadlens.llm import html_text as ht


def cost(score, near, side):
    return sum(-min(s, 0) if c else max(s, 0) for s, c in zip(score, side)) + sum(
        c for i, x in enumerate(near) for j, c in x.items() if side[i] and not side[j]
    )


def test_cut_is_minimal():
    rnd = random.Random(1)
    for _ in range(300):
        n = rnd.randrange(1, 10)
        score = [rnd.choice([0, 0, rnd.randrange(-90, 90)]) for _ in range(n)]
        near = [{} for _ in range(n)]
        for a, b in itertools.combinations(range(n), 2):
            if rnd.random() < 0.5:
                near[a][b] = near[b][a] = rnd.randrange(1, 50)
        side = ht.minimum_cut(score, near)
        best = min(itertools.product([False, True], repeat=n), key=lambda s: (cost(score, near, s), sum(s)))
        assert cost(score, near, side) == cost(score, near, best)


def article(page):
    """The article of a test page, read with patterns that its one form allows."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S)
    if not inside:
        return ""
    blocks = [" ".join(h.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inside[1])]
    return "\n\n".join(b for b in blocks if b)


def test_query_on_all_pages(spark, sf):
    df = spark.read.parquet(f"{sf}/pages.parquet")
    want = {r.page_id: (r.url, t := article(r.html), len(t)) for r in df.collect()}
    assert {r.page_id: (r.url, r.text, r.n_chars) for r in ht.extract_text(df).collect()} == want


NOISE = [
    "<nav><ul><li><a href='/a'>Home</a><li><a href='/b'>World news of today and tomorrow.</a></ul></nav>",
    "<header><h1>The Daily Site</h1><p>All the news that we have got for you today.</p></header>",
    "<div class='site-footer'><p>Some words on who we are and what we do all day long.</p></div>",
    "<footer><p>&copy; 2020 Someone. All rights reserved.</p></footer>",
    "<aside><h2>Most read</h2><p>A teaser that is a whole sentence of some length, really.</p></aside>",
    "<div id='sidebar'><p>Another teaser with quite a few words in it, to look like text.</p></div>",
    "<div class='cookie-notice'><p>We use cookies to give you the best experience on our site.</p><button>OK</button></div>",
    "<div class='ad'>Buy now, this is the best product that anyone has ever made.</div>",
    "<div class='adSlot advertBox'><p>Buy now, this is the best product that anyone has ever made.</p></div>",
    "<form action='/s'><label>Your mail address</label><input name='q'><select><option>One</select><textarea>Write</textarea></form>",
    "<section id='comments'><h2>3 comments</h2><p>I do not agree with the author of this text at all.</p></section>",
    "<div class='reader-comment'><p>What a lovely article, I have read it several times over.</p></div>",
    "<script>var a = '<p>not text</p>';</script><style>p { color: red }</style><!-- <p>no text</p> -->",
    "<noscript><p>Please turn on scripts.</p></noscript><template><p>hidden</p></template>",
    "<div role='navigation'><a href='/'>Start</a> <a href='/2'>Next</a></div><div hidden><p>Not to be seen by readers.</p></div>",
    "<ul class='breadcrumbs'><li>Home<li>News<li>Today</ul><div style='display:none'><p>Unseen words of a page, many.</p></div>",
]
STORY = ["A headline of some words", "The first paragraph tells what has happened, and where it did.", "Short.", "Then more & more was said: a < b, they wrote."]


def marked(parts):
    title, *rest = (h.escape(p) for p in parts)
    return f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>\n" for p in rest)


@pytest.mark.parametrize("frame", ["<article>%s</article>", "<main><article class='post'>%s</article></main>", "<div role=main>%s</div>", "<div class='entry-content'>%s</div>", "<div>%s</div>"])
def test_only_the_story_stays(frame):
    rnd = random.Random(frame)
    for _ in range(20):
        before, after = rnd.sample(NOISE, 4), rnd.sample(NOISE, 4)
        page = "<html><head><title>T</title></head><body>" + "\n".join(before) + frame % marked(STORY) + "\n".join(after) + "</body></html>"
        assert ht.main_text(page) == "\n\n".join(STORY), page


def test_noise_inside_the_article():
    for noise in NOISE:
        if "<header" in noise:
            continue
        page = f"<body><article>{marked(STORY[:2])}{noise}{marked(STORY[2:])}</article></body>"
        assert ht.main_text(page) == "\n\n".join(STORY), page


def test_broken_markup():
    assert ht.main_text("<article><p><b>One.<br><p>Two <i>words</b> here<ul><li>a point.<li>b point</ul>tail &amp; end") == "One.\n\nTwo words here\n\na point.\n\nb point\n\ntail & end"
    assert ht.main_text("<article><p title='a > b'>A <a href=\"x\">link</a>ed word &#233;&#x41;&nbsp;B &am &amp</p>") == "A linked word éA B &am &"
    assert ht.main_text("<article><p>Left <a href='x>open</p><p>Second one.</p>").endswith("Second one.")
    assert ht.main_text("<article><p>1 < 2 and 3 > 2 </ > x <p>Words<") == "1 < 2 and 3 > 2 x\n\nWords<"
    assert ht.main_text("Only plain text, no tags at all.") == "Only plain text, no tags at all."
    for page in (None, "", " \n", "<p>", "<", "</", "<!--", "<script>", "<a href='"):
        assert ht.main_text(page) in ("", "<"), page


def test_left_out_elements():
    page = "<article><p>One <button>press <b>me</b></button>two <svg><g><text>drawn</text></g><svg></svg></svg>three.</p>%s<p>Last one.</p></article>"
    for inner in ("<div><button>never closed</div>", "<select><option>a<option>b</select>", "<template><p>x</p><template>y</template>z</template>", "<noscript><p>n</noscript>", "<span hidden>h <span>i</span> j</span>"):
        assert ht.main_text(page % inner) == "One two three.\n\nLast one.", inner
    assert ht.main_text("<article><p>One.</p><script>never closed <p>Two.</p>") == "One."


def test_deep_pages_keep_their_text():
    deep = "<div>" * 2000
    assert ht.main_text(f"<article>{deep}<p>Down here.</p>{'</div>' * 2000}<p>And back.</p></article>") == "Down here.\n\nAnd back."


def test_wrappers_that_hold_the_article():
    for wrapper in ("<form id='aspnetForm'>%s</form>", "<div class='has-sidebar'>%s</div>", "<div id='header-and-sidebar'>%s</div>"):
        assert ht.main_text("<body>" + wrapper % f"<article>{marked(STORY)}</article>" + "</body>") == "\n\n".join(STORY)


def test_links_decide_by_their_neighbours():
    links = "<ul>" + "".join(f"<li><a href='/{i}'>Chapter {i}</a>" for i in range(8)) + "</ul>"
    page = f"<body>{links}<div>{marked(STORY)}<p><a href='/s'>The source</a></p>{marked(STORY)}</div></body>"
    assert ht.main_text(page) == "\n\n".join([*STORY, "The source", *STORY])


def test_long_and_hostile_pages_take_linear_time():
    for unit in ("<p>A line of a story.", "<div>", "<a href='", "</p>", "<p class='x'>w", "<b", "<!-", "&amp", "<li><a href=x>l</a>", "<select>", "<svg>", "<ul><li>", "<table><tr><td>x", "<div></p></li>", "<span hidden>", "<button></div>"):
        start = time.perf_counter()
        ht.main_text("<body>" + unit * (200_000 // len(unit)))
        assert time.perf_counter() - start < 6, unit


def test_frames(spark):
    rows = [(1, "u", f"<article>{marked(STORY)}</article>"), (1, "u", f"<article>{marked(STORY)}</article>"), (None, None, None), (2, "v", ""), (3, None, "<p></p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' AS text", "1 AS n_chars", "2 AS block")
    story = "\n\n".join(STORY)
    got = sorted(map(tuple, ht.extract_text(df).collect()), key=str)
    assert got == sorted([(1, "u", story, len(story))] * 2 + [(None, None, "", 0), (2, "v", "", 0), (3, None, "", 0)], key=str)
    assert ht.extract_text(df.limit(0)).collect() == []
    blocks = ht.label_blocks(df.limit(1)).collect()
    assert [(b.block, b.tag, b.text, b.content) for b in blocks] == [(i, "p" if i else "h1", t, True) for i, t in enumerate(STORY)]

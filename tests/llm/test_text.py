"""Quality, licences, URLs, personal data and mixing against plain Python."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from loadlens.llm import language_model, licence_texts, licences, mixing, pii, quality, url_filter, words
from loadlens.llm.shared import word_count

WORD = r"[^\x20\x09-\x0D]+"


def base(text):
    w = re.findall(WORD, text or "")
    windows = Counter(zip(w, w[1:], w[2:]))
    marked, seen, dup = [False] * len(w), set(), 0
    for i in range(len(w) - 2):
        if windows[w[i], w[i + 1], w[i + 2]] > 1:
            marked[i : i + 3] = [True] * 3
    for line in (text or "").split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * sum(marked) > 50 * len(w)
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, sum(marked), failed


ODD = [None, "", " \n", "a", "a b c a b c\n\nx\nx\n \n \nx ", "é#ü |<>\r\nq\r\nq", "\x1c a\x85b\u00a0c", "z " * 60_000]


def test_quality_base_and_verdict(documents, docs_of):
    fields = "n_words n_word n_symbols n_dup_lines n_repeat_words base_failed".replace("n_word ", "word_chars ").split()
    rows = {r.doc_id: r.text for r in documents.collect()}
    got = quality.judge_quality(documents).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[f] for f in fields) == base(rows[r.doc_id])
        assert not (r.kept and r.base_failed)
    df = docs_of([(i, t, None) for i, t in enumerate(ODD)] + [(None, "x"), (1, "")])
    texts = dict(enumerate(ODD))
    for r in quality.judge_quality(df).collect():
        if r.doc_id is not None and r.n_words:
            assert tuple(r[f] for f in fields) == base(texts[r.doc_id])
    assert quality.judge_quality(df.limit(0)).count() == 0
    assert quality.keep_good(documents).count() == sum(r.kept for r in got)


def test_quality_finds_junk_and_keeps_prose(spark):
    """On labelled rows: junk that passes the plain limits is rejected, prose is kept."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    got = quality.judge_quality(spark.read.parquet(f"{folder}/documents.parquet")).join(labels, "doc_id")
    good, bad = (got.filter(f"quality = {q} AND NOT base_failed") for q in (1, 0))
    assert good.filter("NOT kept").count() <= 0.01 * good.count()
    assert bad.filter("kept").count() <= 0.03 * bad.count()


def test_quality_every_language_has_a_reference(docs_of, monkeypatch):
    """Clean texts of rare or unknown scripts are kept beside many larger languages, whichever way references travel."""
    rnd = np.random.default_rng(4)
    prose = lambda first, n: " ".join("".join(chr(first + k) for k in rnd.integers(0, 20, 5)) for _ in range(n))
    rows = [(i, prose(ord("a"), 1_300), f"l{i:03d}") for i in range(205)]
    rows += [(900, prose(0x4E00, 1_100), "zh"), (901, prose(0x4E00, 300), None), (902, prose(0x0430, 300), "rare")]
    df = docs_of(rows)
    got = {r.doc_id: r for r in quality.judge_quality(df).collect()}
    assert len(got) == len(rows) and all(r.kept for r in got.values())
    assert got[900].char_distance == 0 and got[901].char_distance > quality.MOST_CHAR_DISTANCE
    monkeypatch.setattr(quality, "SENT_LANGUAGES", 0)
    again = {r.doc_id: r for r in quality.judge_quality(df).collect()}
    assert again == got and quality.keep_good(df).count() == len(rows)


def test_js_distance():
    p, q = np.array([[1.0, 0.0], [5.0, 5.0]]), np.array([[0.0, 2.0], [1.0, 1.0]])
    assert quality.distance(p, q) == pytest.approx([1.0, 0.0])


def test_licences(spark, docs_of, documents):
    mit = "The MIT Licence\n\n  Copyright (c) 2021 A. Person. All rights reserved.\n" + licence_texts.MIT.upper().replace('"', "''")
    rows = [(1, mit), (2, None), (3, ""), (4, "(c) 2020 x"), (5, licence_texts.ISC.replace("\n", "  ")), (None, mit + " x"),
            (6, "prose\n* released under the MIT license\r\nLicensed under the Apache Licence Version 2.0"), (6, "q " * 50_000)]
    df = docs_of(rows)
    got = sorted(((r.doc_id or 0, r.licence, r.notices) for r in licences.scan_licences(df).collect()), key=str)
    assert got == sorted([(1, "MIT", ""), (2, None, ""), (3, None, ""), (4, None, ""), (5, "ISC", "ISC"), (0, None, ""),
                          (6, None, "Apache-2.0,MIT"), (6, None, "")], key=str)
    assert licences.scan_licences(df.limit(0)).count() == 0
    own = spark.createDataFrame([("X", "My Terms, v1")], "name string, text string")
    assert [r.licence for r in licences.scan_licences(docs_of([(1, "my terms (V1)")]), licences=own).collect()] == ["X"]


def rank(edges, seeds, steps=60):
    out = Counter(u for u, _ in edges.elements())
    r = dict(seeds)
    for _ in range(steps):
        now = Counter({h: 0.15 * m for h, m in seeds.items()})
        for (u, v), n in edges.items():
            now[v] += 0.85 * r.get(u, 0) * n / out[u]
        r = now
    return r


def test_url_filter(spark):
    rows = [
        (1, "http://Good.example.net/en/a", '<a href="https://nice.example.com/x"> <a href="/rel">'),
        (2, "http://bad.net/x", "<p>"), (3, "http://nice.example.com/y", ""), (None, None, None), (6, "no url", "x"), (6, "no url", "x"),
        (4, "http://shady.com/y", '<a href="//BAD.net/q"> <a href=http://bad.net/1><a HREF = \'http://nice.example.com\'>'),
        (7, "http://plain.com?x=1", None), (8, "http://a.org/fr/z#top", ""), (9, "http://two.com/", '<img src="//shady.com/q">'),
        (10, "http://net/", ""), (11, "http://xnet/", ""), (12, "http://a.net", ""), (13, "ftp://u://v/w?://z", "a" * 100_000),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'k' AS host", "1 AS rule", "2 AS kind")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(df).collect()}
    assert got[1] == ("good.example.net", "/en/a", "example.net/en/", "allow")
    assert got[2] == ("bad.net", "/x", "net/", "block") and got[10][2:] == ("net/", "block")
    assert got[11][2:] == (None, "allow") and got[12] == ("a.net", "", None, "allow") and got[13][:2] == ("u:", "//v/w")
    assert got[None] == ("", "", None, "allow") and got[6] == ("", "", None, "allow")
    assert [got[i][3] for i in (3, 4, 7, 8, 9)] == ["allow", "block", "allow", "allow", "block"]
    assert url_filter.filter_urls(df).count() == len(rows) and url_filter.filter_urls(df.limit(0)).count() == 0


def test_propagation_against_plain_iteration(spark):
    edges = Counter({("a", "b"): 2, ("a", "c"): 1, ("b", "c"): 1, ("c", "a"): 1, ("c", "d"): 3})
    out = Counter(u for u, _ in edges.elements())
    e = spark.createDataFrame([("allow", u, v, n / out[u]) for (u, v), n in edges.items()], "kind string, src string, dst string, share double")
    s = spark.createDataFrame([("allow", "a", 0.75), ("allow", "b", 0.25)], "kind string, host string, mass double")
    got = {r.host: r["rank"] for r in url_filter.propagate(e, s, steps=60).collect()}
    want = rank(edges, {"a": 0.75, "b": 0.25})
    assert set(got) == set(want) and all(abs(got[h] - want[h]) < 1e-4 for h in want)


def test_pii_forms_distinctness_and_coreference(docs_of, documents):
    card = "4111 1111 1111 1111"
    rows = [
        (1, f"Mr. John Smith met Mrs. Anna SMITH, г-жа Иванова. john@x.com JOHN@X.COM +1 (649) 555-0375, +1 649 555 0375 {card}"),
        (2, None), (3, ""), (4, f"Mr. Smith {card.replace(' ', '-')} password=abcdef1234 at 10.0.0.1."), (None, "x"), (4, "Mr. Smith"),
    ]
    out = {(r.doc_id, r.n_entities): r.text for r in pii.replace_pii(docs_of(rows)).collect()}
    one, four = out[1, 10], out[4, 4]
    new = {k: [one[a:b] for a, b, kind, _ in pii.mentions(one) if kind == k] for k in ("given_m", "given_f", "surname", "email", "phone", "card")}
    assert new["given_m"][0].endswith("o") and new["given_f"][0].endswith("a")
    assert new["surname"][0].upper() == new["surname"][1] and f"Mr. {new['surname'][0]} " in four and out[4, 1] == f"Mr. {new['surname'][0]}"
    assert re.fullmatch("[а-я]+", new["surname"][2].lower())
    assert new["email"][0].upper() == new["email"][1] and new["card"][0].replace(" ", "-") in four
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", new["phone"][0])
    assert re.sub(r"\D", "", new["phone"][0]) == re.sub(r"\D", "", new["phone"][1])
    assert pii.luhn(new["card"][0].replace(" ", "")) and out[2, 0] == out[3, 0] == ""
    texts = {r.doc_id: r.text for r in documents.collect()}
    got = pii.replace_pii(documents).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    to, back = {}, {}
    for r in got:
        old, now = list(pii.mentions(texts[r.doc_id])), list(pii.mentions(r.text))
        assert len(old) == len(now) == r.n_entities
        for (*_, kind, a), (*_, k, b) in zip(old, now):
            assert kind == k and to.setdefault((kind, a), b) == b and back.setdefault((kind, b), a) == a
    assert not {(k, v) for k, v in back} & set(to)


CARD, IBAN = "4111 1111 1111 1111", "ES91 2100 0418 4502 0005 1332"


@pytest.mark.parametrize("text, want", [
    (f"{CARD} 123", [("card", CARD)]), (f"{CARD} 12/25", [("card", CARD)]), (f"{CARD}-12-2025", [("card", CARD)]),
    (f"123-45-6789 {CARD}", [("ssn", "123-45-6789"), ("card", CARD)]), (f"42 {CARD} 7 x", [("card", CARD)]),
    (f"{CARD} 5500 0055 5555 5559 9", [("card", CARD), ("card", "5500 0055 5555 5559")]),
    (f"3782 822463 10005 {CARD}", [("card", "3782 822463 10005"), ("card", CARD)]), (f"{CARD.replace(' ', '')} 123", [("card", CARD.replace(" ", ""))]),
    (f"{CARD} 555 10.0.0.1", [("card", CARD), ("ip", "10.0.0.1")]), (f"1 2 3 {CARD}.5 4111", []),
    (f"{CARD} 123-45-6789", [("card", CARD), ("ssn", "123-45-6789")]),
    (f"{IBAN} EUR", [("iban", IBAN)]), (f"{IBAN} 2024", [("iban", IBAN)]), (f"{IBAN} PAID 12 A", [("iban", IBAN)]),
    (f"GB00 {CARD}", [("card", CARD)]), (f"ID12 3456 7890 1234 {IBAN}", [("iban", IBAN)]),
    (f"{IBAN} {CARD}", [("iban", IBAN), ("card", CARD)]), ("1234 5678 9012 3456 x 4111111111111112", []),
])
def test_pii_numbers_beside_other_digits_and_capitals(text, want):
    assert [(k, text[a:b]) for a, b, k, _ in pii.mentions(text)] == want


def test_pii_collisions_are_drawn_again(spark, monkeypatch):
    few = [("surname", f"name{i}") for i in range(300)] + [("ssn", f"{i:09d}") for i in range(50)]
    monkeypatch.setattr(pii, "_VOWELS", "a")
    monkeypatch.setattr(pii, "_ONSETS", "bd")
    got = pii.surrogates(spark.createDataFrame(few, "kind string, value string"), b"k").collect()
    assert len(got) == 350 == len({(r.kind, r.surrogate) for r in got})


def shares(sizes):
    weights, order = (5.0, 2.0, 1.0), sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        target = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if target[s] > 2 * sizes[s] + 1e-9}
        if not over:
            return target | {s: 2.0 * sizes[s] for s in full}
        full |= over


def test_mixing(documents, docs_of):
    for df in (documents, docs_of([(i, "w " * (i * 7), "en", [None, "b", "a", "ü", "empty"][i % 5] if i % 5 < 4 else "c") for i in range(1, 60)]
                                  + [(None, None, "en", "empty"), (70, "", "en", "empty"), (1, "w " * 7, "en", "b"), (71, "v " * 40_000, "en", "b")])):
        rows = df.select("doc_id", "text", "source").collect()
        got = mixing.mix(df).collect()
        again = mixing.mix(df.repartition(5)).collect()
        assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
        sizes = Counter()
        for r in rows:
            sizes[r.source] += len(re.findall(WORD, r.text or ""))
        want = shares(sizes)
        assert sorted(round(r.target, 6) for r in got) == sorted(round(want[r.source], 6) for r in rows)
        assert sorted(r.size for r in got) == sorted(len(re.findall(WORD, r.text or "")) for r in rows)
        assert all(0 <= r.taken <= 2 * r.size for r in got)
        for target in set(want.values()):
            taken = sum(r.taken for r in got if abs(r.target - target) < 1e-9)
            n = sum(abs(t - target) < 1e-9 for t in want.values())
            assert abs(taken - n * target) <= 0.05 * n * target + 4 * mixing.BLOCK
    assert mixing.mix(df.limit(0)).count() == 0


def test_mixed_texts_hold_what_is_taken(documents):
    taken = {r.doc_id: r.taken for r in mixing.mix(documents).collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    mixed = mixing.mix_texts(documents)
    assert mixed.columns == documents.columns
    words = Counter()
    for r in mixed.withColumn("n", word_count("text")).collect():
        words[r.doc_id] += r.n
        if r.n == len(re.findall(WORD, texts[r.doc_id])):
            assert r.text == texts[r.doc_id].lstrip("\x20\x09\x0a\x0b\x0c\x0d")
    assert words == Counter({i: n for i, n in taken.items() if n})


def test_language_model(documents, docs_of):
    def plain(rows):
        tokens = [(i, re.findall(WORD, re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) + [None]) for i, t in rows]
        c = Counter(w for i, ws in tokens if not language_model.held_out(i) for w in ws)
        n, v = sum(c.values()), len(c)
        return [(i, language_model.held_out(i), len(ws), sum(c[w] > 0 for w in ws), n,
                 sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for i, ws in tokens]

    odd = docs_of([(1, None), (2, ""), (3, "A a \t b"), (3, "A a \t b"), (None, "z"), (4, "a b " * 40_000)])
    for df in (documents, odd):
        got = language_model.score_texts(df).collect()
        want = plain([(r.doc_id, r.text) for r in df.collect()])
        for g, w in zip(sorted(got, key=lambda r: (str(r.doc_id), r.n_tokens)), sorted(want, key=lambda r: (str(r[0]), r[2]))):
            assert tuple(g)[:5] == w[:5] and g.base_score == pytest.approx(w[5], rel=1e-9) and -math.inf < g.score < 0
    held = [r for r in language_model.score_texts(documents).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert language_model.score_texts(odd.limit(0)).count() == 0


def test_language_model_probabilities_sum_to_one(documents):
    """For any context, all words of training and one unknown word share probability one."""
    rng = np.random.default_rng(0)
    of, context = np.repeat(np.arange(40), 5), np.tile(np.arange(5), 40)
    c = rng.geometric(0.2, 200)
    pairs = (np.arange(40, dtype=np.uint64), of, context, c)
    customers, tables = (np.bincount(context, x, language_model.CONTEXTS) for x in (c, np.ones(200)))
    totals = {"customers": customers, "tokens": int(c.sum()), "words": 40, "tables": tables, "top_tables": 40, "d": 0.6, "d_top": 0.5, "first": True}
    seating = language_model.Seating(pairs, totals, 1)
    seating.sweep(20)
    s = seating.sample()
    assert np.all((seating.t >= 1) & (seating.t <= c)) and s["parent"].sum() + s["unknown"] == pytest.approx(1)
    for k in range(5):
        assert s["seen"][context == k].sum() + s["back"][k] * s["unknown"] == pytest.approx(1)
    assert s["back"][77] == pytest.approx(1)  # a context that never came: the parent alone


def test_gibbs_tables_against_exact_distribution():
    """Tables of one dish of 5 customers: the share of each number over many steps is that of the model."""
    r = language_model.Restaurant(0.5)
    rng = np.random.default_rng(1)
    n, c, q = 40_000, 5, 1.3
    t = np.ones(n)
    for _ in range(40):
        t = r.step(np.full(n, float(c)), t, np.full(n, q), rng)
    stirling = {1: {1: 1.0}}
    for m in range(2, c + 1):
        stirling[m] = {k: stirling[m - 1].get(k - 1, 0) + (m - 1 - 0.5 * k) * stirling[m - 1].get(k, 0) for k in range(1, m + 1)}
    want = np.array([stirling[c][k] * q**k for k in range(1, c + 1)])
    assert np.bincount(t.astype(int), minlength=c + 1)[1:] / n == pytest.approx(want / want.sum(), abs=0.01)


def test_a_sweep_reseats_every_customer():
    """Tables of a dish of 600 customers after a few sweeps are spread as the model has them, wherever they began."""
    d, c, q, n = 0.5, 600, 30.0, 4_000
    parts = list(language_model.rounds(np.array([1, 2, 64, c])))
    done = Counter()
    for at, m in parts:
        for i, k in zip(at, np.ones(len(at), int) if m is None else m):
            done[int(i)] += int(k)
    assert done == {1: 2, 2: 64, 3: c}
    log = np.full((c + 1, c + 2), -np.inf)
    log[1, 1] = 0.0
    for m in range(2, c + 1):
        t = np.arange(1, m + 1)
        with np.errstate(divide="ignore"):
            log[m, 1 : m + 1] = np.logaddexp(log[m - 1, t - 1], np.log(np.maximum(m - 1 - d * t, 1e-300)) + log[m - 1, t])
    k = np.arange(1, c + 1)
    p = np.exp((x := log[c, 1 : c + 1] + k * np.log(q)) - x.max())
    p /= p.sum()
    mean, spread = (p * k).sum(), np.sqrt((p * k * k).sum() - (p * k).sum() ** 2)
    r, rng = language_model.Restaurant(d), np.random.default_rng(2)
    for start in (1.0, 300.0):
        t = np.full(n, start)
        for _ in range(language_model.BURN_IN):
            for at, m in language_model.rounds(np.full(n, c)):
                t[at] = r.step(np.full(len(at), float(c)), t[at], np.full(len(at), q), rng, m)
        assert t.mean() == pytest.approx(mean, rel=0.02) and t.std() == pytest.approx(spread, rel=0.1)


def test_contexts_are_words_not_classes(docs_of):
    """What follows a word is not mixed with what follows other words that share the first 13 bits of its hash."""
    names = [f"v{i}" for i in range(30_000)]
    block = next(words.blocks(pa.array([" ".join(names)])))
    keys = words.words_in(block, block.data).key
    of = {}
    for n, k in zip(names, keys.tolist()):
        of.setdefault(k >> 51, []).append(n)
    alike = next(x for x in of.values() if len(x) >= 12)[:12]
    unlike = [x[0] for x in of.values()][:12]
    scores = []
    for firsts in (alike, unlike):
        rows = [(i, f"{firsts[i % 12]} f{i % 12}") for i in range(1_200)]
        got = language_model.score_texts(docs_of(rows)).collect()
        scores.append(sum(r.score for r in got) / len(got))
    assert scores[0] == pytest.approx(scores[1], abs=0.1)


def test_scoring_goes_on_from_the_stored_seating():
    c = np.array([500, 3, 1])
    pairs = (np.arange(2, dtype=np.uint64), np.array([0, 0, 1]), np.array([0, 1, 1]), c)
    totals = {"customers": np.array([500, 4]), "tokens": 504, "words": 2, "tables": np.array([77, 3]), "top_tables": 6, "d": 0.6, "d_top": 0.5}
    seating = language_model.Seating(pairs, totals, 1, (np.array([77, 2, 1]), np.array([5, 1])))
    assert seating.t.tolist() == [77, 2, 1] and seating.top_t.tolist() == [5, 1] and seating.customers.tolist() == [79, 1]
    seating.sweep(3)
    assert seating.tables.sum() == seating.t.sum() == seating.customers.sum() == pytest.approx(seating.all_tables)
    assert np.all((seating.t >= 1) & (seating.t <= c)) and seating.top_tables == pytest.approx(seating.top_t.sum())

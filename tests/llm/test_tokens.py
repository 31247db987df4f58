"""Token counts and ids against the public library."""

import hashlib
import random

import numpy as np
import pytest

from loadlens.llm.bpe import ByteBPE, encode, encode_digests
from loadlens.llm.queries import vocabulary
from loadlens.llm.token_counts import count_tokens

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary())


@pytest.fixture(scope="module")
def bpe():
    return ByteBPE(vocabulary())


def odd_texts():
    rnd = random.Random(1)
    wild = lambda: chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(160, 0x250), rnd.randrange(0x370, 0xD7FF), 0x1F600 + rnd.randrange(50)]))
    return [
        "", " ", "  a  b", "a<|endoftext|>b <|endoftext|>", "x" * 3000, "aaaa" * 500, "!!!" * 200, "   x\x1c\x1dy\x85z", "don't I'll we've",
        "1234567 \u00bd \u00b2x", "\t\t\n\n  \r\nq", "<|endoftext", "_a_b_", "\u00e9tude e\u0301", "\u200b\ufeff \u3000\u3000x",
        *("".join(wild() for _ in range(rnd.randrange(1, 80))) for _ in range(400)),
        *("".join(rnd.choice("the in on ing er aAbB 'stx") for _ in range(300)) for _ in range(100)),
    ]


def test_ids_of_odd_texts(bpe, library):
    texts = odd_texts()
    want = library.encode_batch(texts, add_special_tokens=False)
    for text, w, got in zip(texts, want, bpe.encode_all(texts)):
        assert np.frombuffer(got, "<u4").tolist() == w.ids, text[:50]
        assert bpe.decode(got).decode() == library.decode(w.ids, skip_special_tokens=False) == text


def test_pairs_are_compatible_exactly_if_merging_leaves_them_alone(bpe):
    rnd = random.Random(2)
    a, b = (np.array([rnd.randrange(50_256) for _ in range(4000)]) for _ in range(2))
    whole = [bpe.merged(bpe.bytes[x]) == [x] for x in range(0, 50_256, 97)]
    assert all(whole)
    for x, y, good in zip(a.tolist(), b.tolist(), bpe.compatible(a, b).tolist()):
        assert good == (bpe.merged(bpe.bytes[x] + bpe.bytes[y]) == [x, y])


def test_long_words_merge_like_short_ones(bpe, library):
    rnd = random.Random(3)
    for n in (49, 200, 2000):
        word = "".join(rnd.choice("abcdeingthers") for _ in range(n))
        assert bpe.merged(word.encode()) == library.encode(word, add_special_tokens=False).ids


def test_documents(documents, docs_of, library):
    odd = docs_of([(None, None), (1, ""), (2, "a<|endoftext|>b"), (2, "a<|endoftext|>b"), (3, "x " * 60_000), (4, "\u65e5\u672c\u8a9e")])
    for df in (documents, odd):
        rows = df.select("doc_id", "text").collect()
        key = lambda t: tuple(map(str, t))
        ids = [library.encode(r.text or "", add_special_tokens=False).ids for r in rows]
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want = sorted(((r.doc_id, len(x), sha(np.array(x, "<u4").tobytes()), sha((r.text or "").encode())) for r, x in zip(rows, ids)), key=key)
        assert sorted(map(tuple, encode_digests(df, vocabulary()).collect()), key=key) == want
        counted = sorted(((r.doc_id, len((r.text or "").encode()), len(x), len(x) > 512) for r, x in zip(rows, ids)), key=key)
        assert sorted(map(tuple, count_tokens(df, vocabulary()).collect()), key=key) == counted
    full = encode(odd, vocabulary()).collect()
    assert sorted(len(r.ids) for r in full) == sorted(len(x) for x in ids) and all(r.decoded is not None for r in full)
    assert [r.ids for r in full if r.doc_id == 2][0] == [x for r, x in zip(rows, ids) if r.doc_id == 2][0]
    assert encode_digests(odd.limit(0), vocabulary()).count() == 0 and count_tokens(odd.limit(0), vocabulary()).count() == 0

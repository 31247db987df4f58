"""Quality rules: plain limits, then how far a document's histograms are from its language's.

Two histograms per document: character classes, and the most common words of its language with all
other words as one more bin. Each is compared with the same histogram over all documents of the language
that pass the plain limits and have few symbols, by Jensen-Shannon distance (base 2, 0 to 1). A document too
short for its histograms to mean anything is not judged by them, nor one without a language or of a language with
too few words for a reference: its distances are those from all languages together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .packing import pack, unpack
from .shared import stored
from .words import LOWER, Block, Words, blocks, mixed, range_keys, words_in

CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "other", "beyond_ascii")
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of words in repeated windows
MOST_SYMBOLS = 10  # for 100 words, in documents that count for a reference
#: Guards: a histogram of fewer characters or words is not judged.
LEAST_CHARS_JUDGED = 200
LEAST_WORDS_JUDGED = 50
#: A document is rejected when both of its distances are above these limits. They lie between what labelled good
#: and bad documents show; the histogram of n words is off by chance alone, which NOISE / sqrt(n) allows for.
MOST_CHAR_DISTANCE = 0.18
MOST_WORD_DISTANCE = 0.28
NOISE = 0.5
COMMON = 50
#: A language whose reference has fewer words is not judged by it, nor is a document without a language.
LEAST_REFERENCE_WORDS = 1_000
#: Up to so many languages the references travel with the tasks; more are joined to the documents.
SENT_LANGUAGES = 10_000
COPIES = 64  # of each reference that is joined, so that no task gets all documents of a language

_CLASS = np.full(256, len(CLASSES) - 2, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[0x20, *range(0x09, 0x0E)]] = 3
_CLASS[np.frombuffer(b".,;:!?'\"()-", np.uint8)] = 4
_CLASS[np.frombuffer(SYMBOLS.encode(), np.uint8)] = 5
_CLASS[0x80:] = 7
_CLASS[0x80:0xC0] = len(CLASSES)  # continuation bytes: no characters of their own


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[at[1:]] - sums[at[:-1]]


def _repeats(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which keys come twice or more within their text."""
    own = mixed(key ^ mixed(doc.astype(np.uint64)))
    order = np.sort(own)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    return np.isin(own, twice) if len(twice) else np.zeros(len(own), bool)


def _first_in_text(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    own = mixed(key ^ mixed(doc.astype(np.uint64)))
    out = np.zeros(len(own), bool)
    out[np.unique(own, return_index=True)[1]] = True
    return out


def _base(block: Block, words: Words) -> dict[str, np.ndarray]:
    data, at = block.data, block.at
    n = np.diff(words.docs)
    lead = (data & 0xC0) != 0x80
    inside = np.zeros(len(data) + 1, np.int8)
    inside[words.start] += 1
    np.subtract.at(inside, words.end, 1)
    inside = np.cumsum(inside[:-1]) > 0
    # three-word windows that come twice mark their words
    m = max(0, len(words.key) - 2)
    step = np.array([3, 5, 7], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    window = mixed(words.key[:m] * step[0] + words.key[1 : m + 1] * step[1] + words.key[2 : m + 2] * step[2])
    whole = words.doc[:m] == words.doc[2 : m + 2]
    twice = np.zeros(m, bool)
    twice[whole] = _repeats(window[whole], words.doc[:m][whole])
    marked = np.zeros(len(words.key), bool)
    for i in range(3):
        marked[i : m + i] |= twice
    # lines: from the start of a text or after a line end
    new = np.flatnonzero(data == 10) + 1
    start = np.union1d(at[:-1][np.diff(at) > 0], new[new < len(data)])
    end = np.append(start[1:], len(data)) if len(start) else start
    line_doc = np.searchsorted(at, start, side="right") - 1
    end = np.minimum(end, at[1:][line_doc]) if len(start) else end
    end = np.where((end > start) & (data[end - 1] == 10), end - 1, end) if len(start) else end
    has_word = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end, line_doc = start[has_word], end[has_word], line_doc[has_word]
    first = _first_in_text(range_keys(data, start, end), line_doc)
    out = {
        "n_words": n,
        "word_chars": _per_text(lead & inside, at),
        "n_symbols": _per_text(_CLASS[data] == 5, at),
        "n_dup_lines": np.bincount(line_doc[~first], minlength=block.n),
        "n_repeat_words": np.bincount(words.doc[marked], minlength=block.n),
    }
    out["base_failed"] = (n < LEAST_WORDS) | (100 * out["n_repeat_words"] > MOST_REPEATED * n)
    return out


def _class_counts(block: Block) -> np.ndarray:
    k = len(CLASSES) + 1
    doc = np.repeat(np.arange(block.n), np.diff(block.at))
    return np.bincount(doc * k + _CLASS[block.data], minlength=block.n * k).reshape(block.n, k)[:, :-1]


def _by_language(of: list):
    """Each language and which texts have it."""
    number = {lang: i for i, lang in enumerate(dict.fromkeys(of))}
    which = np.array([number[x] for x in of])
    for lang, i in number.items():
        yield lang, which == i


def _references(batches):
    """(lang, text) -> (lang, key, count): words by key, character classes by kind 1."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        found: dict = {}
        classes: dict = {}
        for block in blocks(batch.column(1)):
            words = words_in(block, LOWER[block.data])
            base = _base(block, words_in(block, block.data))
            good = ~base["base_failed"] & (100 * base["n_symbols"] <= MOST_SYMBOLS * base["n_words"])
            counts = _class_counts(block)
            of = langs[block.first : block.first + block.n]
            for lang, docs in _by_language(of):
                docs &= good
                classes[lang] = classes.get(lang, 0) + counts[docs].sum(axis=0)
                key, n = np.unique(words.key[docs[words.doc]], return_counts=True)
                found.setdefault(lang, []).append((key, n))
        for lang, parts in found.items():
            key, which = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            n = np.bincount(which, np.concatenate([c for _, c in parts])).astype(np.int64)
            key, n = np.append(key.view(np.int64), np.arange(len(CLASSES))), np.append(n, classes[lang])
            kind = np.zeros(len(key), np.int32)
            kind[len(key) - len(CLASSES) :] = 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(key), pa.string()), pa.array(kind), pa.array(key, pa.int64()), pa.array(n, pa.int64())],
                ["lang", "kind", "key", "n"],
            )


def distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts from the reference row beside it."""
    with np.errstate(divide="ignore", invalid="ignore"):
        p = np.nan_to_num(counts / counts.sum(axis=1, keepdims=True))
        q = np.nan_to_num(reference / reference.sum(axis=1, keepdims=True))
        m = (p + q) / 2
        part = lambda a: np.where(a > 0, a * np.log2(a / m), 0).sum(axis=1)
        return np.sqrt(np.clip((part(p) + part(q)) / 2, 0, 1))


def _judge(references: dict, char_limit: float, word_limit: float):
    """references: lang -> (common word keys, sorted; their counts and the rest; class counts); None is the pool.

    Batches with a fourth column, the language's reference or null, bring those of named languages themselves.
    """
    sent = references

    def run(batches):
        for batch in batches:
            ids, langs, references = batch.column(0), batch.column(1).to_pylist(), dict(sent)
            if batch.num_columns > 3:
                own = batch.column(3)
                for lang, i in {x: i for i, x in enumerate(langs) if x is not None}.items():
                    if own[i].is_valid:
                        references[lang] = _unpacked(own[i].as_py())
            parts = []
            for block in blocks(batch.column(2)):
                exact = words_in(block, block.data)
                out = _base(block, exact)
                words = words_in(block, LOWER[block.data])
                classes = _class_counts(block)
                n = out["n_words"]
                of = [x if x in references else None for x in langs[block.first : block.first + block.n]]
                chars, common = np.zeros(block.n), np.zeros(block.n)
                for lang, docs in _by_language(of):
                    keys, word_ref, class_ref = references[lang]
                    mine = docs[words.doc]
                    bin_ = np.searchsorted(keys, words.key[mine])
                    bin_[bin_ == len(keys)] = 0
                    hit = keys[bin_] == words.key[mine] if len(keys) else np.zeros(len(bin_), bool)
                    k = len(keys) + 1
                    counts = np.bincount(words.doc[mine] * k + np.where(hit, bin_, k - 1), minlength=block.n * k).reshape(block.n, k)
                    common[docs] = distance(counts[docs], np.broadcast_to(word_ref, (docs.sum(), k)))
                    chars[docs] = distance(classes[docs], np.broadcast_to(class_ref, (docs.sum(), len(CLASSES))))
                judged_c, judged_w = classes.sum(axis=1) >= LEAST_CHARS_JUDGED, n >= LEAST_WORDS_JUDGED
                chance = NOISE / np.sqrt(np.maximum(n, 1))
                own = np.array([x is not None for x in of], bool)
                far = own & judged_c & (chars > char_limit) & judged_w & (common > word_limit + chance)
                out |= {"char_distance": chars, "word_distance": common, "kept": ~out["base_failed"] & ~far}
                parts.append(out)
            if parts:
                cols = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, cols.values())], ["row", *cols])

    return run


def _keeping(judge, schema):
    """The same judgement, but what comes out are the input rows that it keeps."""

    def run(batches):
        for batch in batches:
            of = [pa.array(np.arange(batch.num_rows)), batch.column("_lang"), batch.column("_text")]
            of += [batch.column("_ref")] if "_ref" in batch.schema.names else []
            of = pa.RecordBatch.from_arrays(of, ["row", "lang", "text", "ref"][: len(of)])
            for out in judge(iter([of])):
                yield batch.select(schema).filter(out.column("kept"))

    return run


def keep_good(
    docs: DataFrame, text: str = "text", lang: str = "lang",
    char_limit: float = MOST_CHAR_DISTANCE, word_limit: float = MOST_WORD_DISTANCE,
) -> DataFrame:
    """The rows of docs that judge_quality keeps, with all their columns; none may be named `_lang`, `_text` or `_ref`."""
    own = docs.withColumns({"_lang": F.col(lang).cast("string"), "_text": F.col(text)})
    own, references = _with_references(own, "_lang", "_text", "_ref")
    return own.mapInArrow(_keeping(_judge(references, char_limit, word_limit), docs.columns), docs.schema)


def _packed(batches):
    """(lang, words, parts) -> (lang, ref): the common words, their counts and the rest, the class counts as bytes."""
    for batch in batches:
        out = []
        for total, parts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            words = sorted((p["key"] % (1 << 64), p["n"]) for p in parts if p["kind"] == 0)
            classes = np.zeros(len(CLASSES), np.int64)
            for p in parts:
                if p["kind"] == 1:
                    classes[p["key"]] = p["n"]
            out.append(pack(np.array([k for k, _ in words], np.uint64), np.array([*(n for _, n in words), total - sum(n for _, n in words)]), classes))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["lang", "ref"])


def _unpacked(ref: bytes):
    keys, n, classes = unpack(ref)
    return keys.view(np.uint64), n.astype(float), classes.astype(float)


def _with_references(docs: DataFrame, lang: str, text: str, ref: str) -> tuple[DataFrame, dict]:
    """docs, and the references that go with tasks: under None that of everything together, and those of all languages that
    have enough words. Where these are too many to send, docs get a column ref with the one of their language."""
    counts = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(
        _references, "lang string, kind int, key long, n long"
    )
    counts = stored(counts.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")), "histograms")
    sizes = counts.filter("kind = 0 AND lang IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("words"))
    sizes = sizes.filter(F.col("words") >= LEAST_REFERENCE_WORDS)
    everything = counts.groupBy("kind", "key").agg(F.sum("n").alias("n"))
    top = W.partitionBy("lang", "kind").orderBy(F.desc("n"), "key")
    common = lambda df: df.withColumn("place", F.row_number().over(top)).filter(F.col("place") <= COMMON).groupBy("lang").agg(
        F.collect_list(F.struct("kind", "key", "n")).alias("parts")
    )
    named = common(counts.filter("lang IS NOT NULL")).join(sizes, "lang").select("lang", "words", "parts")
    named = stored(named.mapInArrow(_packed, "lang string, ref binary"), "references")
    pool = common(everything.select(F.lit(None).cast("string").alias("lang"), "kind", "key", "n")).crossJoin(
        everything.filter("kind = 0").agg(F.sum("n").alias("words"))
    )
    pool = pool.select("lang", F.coalesce("words", F.lit(0)).alias("words"), "parts").mapInArrow(_packed, "lang string, ref binary").collect()
    nothing = (np.zeros(0, np.uint64), np.zeros(1), np.zeros(len(CLASSES)))
    references = {None: _unpacked(pool[0].ref) if pool else nothing}
    if named.count() <= SENT_LANGUAGES:
        return docs, references | {r.lang: _unpacked(r.ref) for r in named.collect()}
    copies = named.select(F.col("lang").alias("_of"), F.col("ref").alias(ref), F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("_copy"))
    own = docs.withColumn("_salt", F.pmod(F.xxhash64(text), F.lit(COPIES)).cast("int"))
    joined = own.join(copies, (F.col(lang) == F.col("_of")) & (F.col("_salt") == F.col("_copy")), "left")
    return joined.select(*docs.columns, ref), references


def judge_quality(
    docs: DataFrame, row="doc_id", text: str = "text", lang: str = "lang",
    char_limit: float = MOST_CHAR_DISTANCE, word_limit: float = MOST_WORD_DISTANCE,
) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, char_distance, word_distance, kept.

    base_failed: fewer than 50 words, or over half of the words in three-word windows that come twice. The
    references count all documents that pass this and have at most one symbol for ten words. Null and empty texts have no words and fail; with a null
    language or one of fewer than 1,000 reference words, distances are those from all languages together and reject nothing; repeated rows count as often as they
    come; a table without rows gives none. Other columns are not read. `row` may be any column of docs; it comes out
    as doc_id.
    """
    docs = docs.select(F.col(row).alias("row"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    docs, references = _with_references(docs, "lang", "text", "ref")
    long_ = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
    kind = docs.schema["row"].dataType.simpleString()
    judged = docs.mapInArrow(
        _judge(references, char_limit, word_limit),
        f"row {kind}, {long_}, char_distance double, word_distance double, kept boolean",
    )
    return judged.withColumnRenamed("row", "doc_id")

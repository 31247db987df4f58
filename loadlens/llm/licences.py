"""Licence scan by canonical digest.

A text is brought to a canonical form: lower case, no copyright lines, no punctuation, one of several equivalent
spellings, single spaces. Its digest is looked up among the digests of known licences, brought to the same form.
The text of a document is looked up as a whole, and so is each of its lines, which finds notices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .licence_texts import DIGESTS, NOTICES, TEXTS
from .shared import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A line that only says whose the copyright is: a (c), or the word followed by a year, a (c) or a blank to fill in.
COPYRIGHT_LINE = r"^[^\p{L}\p{N}(©]*(copyright[^\p{L}(]*(\(c\)|©|[0-9<\[{])|\(c\)|©)"
RESERVED_LINE = r"^[^\p{L}\p{N}]*all rights reserved[^\p{L}\p{N}]*$"
PUNCTUATION = r"[^\p{L}\p{N}\n]+"
#: Equivalent spellings, as parts of words.
SPELLINGS = (
    ("licenc", "licens"), ("organisation", "organization"), ("authoris", "authoriz"), ("recognis", "recogniz"),
    ("favour", "favor"), ("fulfil ", "fulfill "), ("judgement", "judgment"), ("acknowledgement", "acknowledgment"),
    ("per cent", "percent"), ("copyright owner", "copyright holder"), ("non commercial", "noncommercial"), ("https ", "http "),
)
#: Known licences up to which their table is sent to every task: 32 kB of digests and names.
MOST_BROADCAST = 10_000
#: Different lengths of known texts up to which lines are compared with them first.
MOST_SIZES = 1_000


def _spelt(words: Column) -> Column:
    for old, new in SPELLINGS:
        words = F.replace(words, F.lit(old), F.lit(new))
    return words


def canonical_lines(text: Column) -> Column:
    """The lines of a text in lower case without punctuation, copyright lines and empty lines."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER + "\r", _LOWER + " ")
    own = lambda line: ~line.rlike(COPYRIGHT_LINE) & ~line.rlike(RESERVED_LINE)
    signs = plain.contains("copyright") | plain.contains("(c)") | plain.contains("©") | plain.contains("all rights reserved")
    plain = F.when(signs, F.array_join(F.filter(F.split(plain, "\n"), own), "\n")).otherwise(plain)
    lines = F.transform(F.split(F.regexp_replace(plain, PUNCTUATION, " "), "\n"), lambda x: F.trim(x))
    return F.filter(lines, lambda x: x != "")


def canonical(lines: Column) -> Column:
    """Lines as one text, spelt one way; '' if there are none."""
    return F.rtrim(_spelt(F.concat(F.array_join(lines, " "), F.lit(" "))))


def digest(words: Column) -> Column:
    """The digest of canonical words; null where there are none."""
    return F.when(words != "", F.sha2(words, 256))


def known_digests(spark: SparkSession, licences, digests=()) -> DataFrame:
    """(digest, licence, size) from (name, text) pairs or a DataFrame of name and text; of equal texts the first name.

    digests are licences known by (name, digest, size) alone, of canonical texts.
    """
    if not isinstance(licences, DataFrame):
        licences = spark.createDataFrame(list(licences), "name string, text string")
    words = canonical(canonical_lines(F.col("text")))
    known = licences.select("name", words.alias("words")).filter("words <> ''")
    known = known.select("name", digest(F.col("words")).alias("digest"), F.length("words").alias("size"))
    if digests:
        known = known.unionByName(spark.createDataFrame(list(digests), "name string, digest string, size int"))
    return known.groupBy("digest").agg(F.min("name").alias("licence"), F.max("size").alias("size"))


def scan_licences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", licences=None) -> DataFrame:
    """One row per document: doc_id, digest, licence, notices.

    digest is that of the whole text, null if no words are left; licence the known licence with this digest, or null;
    notices the names of the licences whose text is one line of the document, in order, joined by commas, '' if none.
    Null and empty texts have no digest. Repeated rows are rows like any other. Other columns are not read; a table
    without rows gives none. licences: (name, text) pairs or a DataFrame of them; by default the texts, notices and
    digests of licence_texts.
    """
    spark = docs.sparkSession
    default = (TEXTS + NOTICES, DIGESTS)
    known = stored(known_digests(spark, *(default if licences is None else (licences,))), "licences")
    small = known.count() <= MOST_BROADCAST
    # a line can only be a known text if it is as long as one
    sizes = [r.size for r in known.select("size").distinct().limit(MOST_SIZES + 1).collect()]
    known = F.broadcast(known.drop("size")) if small else known.drop("size")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), canonical_lines(F.col(text)).alias("lines")
    )
    spelt = F.split(_spelt(F.concat(F.array_join("lines", " \n "), F.lit(" "))), "\n")
    spelt = F.transform(spelt, lambda x: F.trim(x))
    if len(sizes) <= MOST_SIZES:
        spelt = F.filter(spelt, lambda x: F.length(x).isin(sizes))
    found = stored(
        rows.select(
            "row", "doc_id", digest(canonical(F.col("lines"))).alias("digest"),
            F.array_distinct(F.transform(spelt, digest)).alias("of_lines"),
        ),
        "digests",
    )
    lines = found.select("row", F.explode("of_lines").alias("digest")).join(known, "digest")
    notices = lines.groupBy("row").agg(F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("notices"))
    whole = found.select("row", "doc_id", "digest").join(known, "digest", "left")
    return whole.join(notices, "row", "left").select("doc_id", "digest", "licence", F.coalesce("notices", F.lit("")).alias("notices"))


def oracle() -> str:
    """The same in DuckDB's SQL."""

    def lines(text):
        plain = f"translate(coalesce({text}, ''), '{_UPPER}' || chr(13), '{_LOWER} ')"
        own = f"NOT regexp_matches(x, '{COPYRIGHT_LINE}') AND NOT regexp_matches(x, '{RESERVED_LINE}')"
        clean = f"trim(regexp_replace(x, '{PUNCTUATION}', ' ', 'g'))"
        kept = f"list_filter(string_split({plain}, chr(10)), lambda x: {own})"
        return f"list_filter(list_transform({kept}, lambda x: {clean}), lambda x: x <> '')"

    def spelt(words):
        for old, new in SPELLINGS:
            words = f"replace({words}, '{old}', '{new}')"
        return words

    canon = lambda lines: f"rtrim({spelt(f"concat(array_to_string({lines}, ' '), ' ')")})"
    digests = ", ".join(f"('{n}', '{d}')" for n, d, _ in DIGESTS)
    values = ", ".join("('" + n + "', '" + t.replace("'", "''") + "')" for n, t in TEXTS + NOTICES)
    return f"""
        WITH known AS (
            SELECT digest, min(name) AS licence FROM (
                SELECT name, sha256({canon(lines("t"))}) AS digest FROM (VALUES {values}) v(name, t)
                UNION ALL SELECT * FROM (VALUES {digests}) d(name, digest)
            ) GROUP BY 1
        ), canon AS (SELECT doc_id, row_number() OVER () AS r, {lines("text")} AS lines FROM documents
        ), whole AS (SELECT r, doc_id, {canon("lines")} AS words FROM canon
        ), noted AS (
            SELECT r, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices
            FROM (SELECT r, sha256({canon("[x]")}) AS digest FROM (SELECT r, unnest(lines) AS x FROM canon)) JOIN known USING (digest)
            GROUP BY r
        )
        SELECT doc_id, d.digest, licence, coalesce(notices, '') AS notices
        FROM (SELECT r, doc_id, CASE WHEN words <> '' THEN sha256(words) END AS digest FROM whole) d
        LEFT JOIN known ON known.digest = d.digest LEFT JOIN noted USING (r)
    """

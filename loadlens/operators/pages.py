"""Page rows -> document text, and the conversion ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Pages of a document whose texts are joined in one task first. The result is the same for
# any number; it only bounds what has to be sorted together.
PAGES_PER_RANGE = 1_000


def _assemble(pages: DataFrame, doc, page: str, text: Column, by: str, pages_per_range: int, any_of=()) -> DataFrame:
    """One row per document: its pages in order, those without a number last, in order of their text.

    any_of: boolean columns of pages that hold for a document if they do for any of its pages.

    The pages of a range are joined first, then the few ranges of the document, so a long
    document is one row like any other.
    """
    number = F.col(page)
    item = F.when(text.isNotNull(), F.struct(number.isNull().alias("last"), number.alias("page"), text.alias("text")))
    span = F.floor(number / pages_per_range).alias("_range")
    # collect_list leaves nulls out, so a document of left-out pages keeps its row
    joined = pages.groupBy(*doc, span).agg(F.array_sort(F.collect_list(item)).alias("_pages"), *[F.max(c).alias(c) for c in any_of])
    part = F.when(F.size("_pages") > 0, F.array_join("_pages.text", by))
    ranges = joined.select(*doc, F.struct(F.col("_range").isNull().alias("last"), "_range", part.alias("text")).alias("_part"), *any_of)
    whole = F.array_sort(F.collect_list(F.when(F.col("_part.text").isNotNull(), F.col("_part"))))
    docs = ranges.groupBy(*doc).agg(whole.alias("_parts"), *[F.max(c).alias(c) for c in any_of])
    return docs.select(*doc, F.array_join("_parts.text", by).alias("text"), *any_of)


def assemble(pages: DataFrame, doc, page="page_no", text="text", pages_per_range=PAGES_PER_RANGE, any_of=()) -> DataFrame:
    """Pages joined by a blank line; a failed (null) page is '' and keeps its slot."""
    return _assemble(pages, doc, page, F.coalesce(F.col(text), F.lit("")), "\n\n", pages_per_range, any_of)


def assemble_filled(pages: DataFrame, doc, page="page_no", text="text", pages_per_range=PAGES_PER_RANGE) -> DataFrame:
    """Pages with text only, each followed by a line end."""
    filled = F.when(F.coalesce(F.col(text), F.lit("")) != "", F.concat(text, F.lit("\n")))
    return _assemble(pages, doc, page, filled, "", pages_per_range)


def ledger(files: DataFrame, ok: Column, by=()) -> DataFrame:
    """Converted and failed files, one row per group."""
    return files.groupBy(*by).agg(
        F.count_if(ok).alias("converted"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("failed")
    )


def require_converted(counts: DataFrame | int) -> int:
    """Number of converted files, from a ledger or as it is; raises if there is none."""
    total = counts if isinstance(counts, int) else counts.agg(F.coalesce(F.sum("converted"), F.lit(0))).first()[0]
    if total == 0:
        raise ValueError("no document was converted")
    return total


def source_audit(files: DataFrame, path: str, text: str, by) -> DataFrame:
    """Which sources were read and how much: counts and sizes, never a list of all paths."""
    return files.groupBy(*by).agg(
        F.count(F.lit(1)).alias("files"),
        F.min(path).alias("first_file"),
        F.max(path).alias("last_file"),
        F.sum(F.length(text)).alias("characters"),
    )

"""Mixing sources to target weights by drawing fixed-length blocks of words.

The words of a source, document after document, are packed into blocks of one length. A shard of
the output has a fixed number of slots; how many of them each source gets is drawn per shard: the
whole part of the expectation is certain, the rest is a multinomial draw. The k-th slot of a source
takes block P(k), where P is a pseudorandom permutation of the source's block numbers, so a block
comes again only after all others have come. Slots and blocks join by (source, block).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import let
from .shared import SPACES, WORD, stored, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5  # of all words
MOST = 2.0  # times a source's words
BLOCK = 64
SLOTS = 1024  # of an output shard
ROUNDS = 8
ROWS_PER_BIN = 20_000
SHARDS_PER_BIN = 16_384
CELLS = 1024  # of a look-up by range


def _uniform(*parts: Column | int) -> Column:
    """A number in [0, 1) that the parts fix."""
    return F.shiftrightunsigned(F.xxhash64(*[p if isinstance(p, Column) else F.lit(p) for p in parts]), 11) / float(1 << 53)


def permuted(k: Column, n: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """The image of k under a permutation of 0 .. n-1 chosen by key (swap-or-not rounds)."""

    def turn(x, i):
        other = F.pmod(F.pmod(F.xxhash64(key, i), n) - x, n)
        return F.when(F.xxhash64(key, i, F.greatest(x, other)) % 2 == 0, other).otherwise(x)

    return F.aggregate(F.array(*[F.lit(i) for i in range(rounds)]), k, turn)


def sources_table(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, weight, source_size, target): weights repeat in code-point order, null last.

    Targets share `share` of all words by weight; none exceeds `most` times its source's words, and
    what is above goes to the others by weight until none is above. Sources are few against documents:
    the table has one row per source, aggregated before anything is ordered.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    pick = (F.row_number().over(order) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), pick + 1))
    # A source is full when the level (words per unit of weight) passes its own limit. By rising limit,
    # the level is what is left after the sources before, over the weights from this one on.
    per = per.withColumn("limit", most * F.col("source_size") / F.col("weight"))
    rising = W.orderBy("limit", F.col("source").asc_nulls_last())
    before = rising.rowsBetween(W.unboundedPreceding, -1)
    onward = rising.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total = F.lit(share) * F.sum("source_size").over(everything)
    taken = F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0.0))
    per = per.withColumn("level", (total - taken) / F.sum("weight").over(onward))
    reached = F.min(F.when(F.col("level") <= F.col("limit"), F.struct("limit", "source", "level"))).over(everything)
    level = F.coalesce(reached["level"], F.lit(float("inf")))
    target = F.least(F.col("weight") * level, most * F.col("source_size"))
    return per.select("source", "weight", "source_size", target.alias("target"))


def running(df: DataFrame, key: str, bin: str, value: str, order: list[str], name: str) -> DataFrame:
    """df with the sum of `value` over the rows before each row of the same key, in order of (bin, order).

    Sums go over the bins of a key first, then within a bin, so no task holds a key's rows, only those of
    one bin or one row per bin.
    """
    sums = df.groupBy(key, bin).agg(F.sum(value).alias("_sum"))
    before = W.partitionBy(key).orderBy(bin).rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(
        F.col(key).alias("_key"), F.col(bin).alias("_bin"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before")
    )
    within = W.partitionBy(key, bin).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    placed = df.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col(bin) == F.col("_bin"))
    return placed.join(sums, same).withColumn(name, F.col("_before") + F.col("_within")).drop(
        "_key", "_bin", "_before", "_within"
    )


def _looked_up(df: DataFrame, at: Column, lots: DataFrame, low: str, high: str, end: float) -> DataFrame:
    """df joined to the one row of lots with low <= at < high; an equi-join on CELLS cells of [0, end)."""
    cell = lambda c: F.least(F.floor(c * CELLS / F.lit(float(end))), F.lit(CELLS - 1)).cast("int")
    cells = lots.filter(F.col(high) > F.col(low)).withColumn("_cell", F.explode(F.sequence(cell(F.col(low)), cell(F.col(high)))))
    df = df.withColumn("_at", at).withColumn("_cell", cell(F.col("_at")))
    return df.join(cells, "_cell").filter((F.col("_at") >= F.col(low)) & (F.col("_at") < F.col(high))).drop("_at", "_cell")


def draw_slots(per_source: DataFrame, block: int, slots: int, most: float, seed: int) -> DataFrame:
    """(source, blocks, shard, k): every slot of every output shard; k counts the slots of a source.

    A shard has the whole part of each source's expected count for certain; its other slots draw a
    source each by the fractions, so their counts are multinomial. Slots beyond `most` times the blocks
    of a source, which only rounding or the draw can bring, stay empty.
    """
    spark = per_source.sparkSession
    blocks = F.ceil(F.col("source_size") / block)
    wanted = F.when(F.col("source_size") > 0, F.col("target") * blocks / F.col("source_size")).otherwise(0.0)
    per = stored(per_source.select("source", blocks.cast("long").alias("blocks"), wanted.alias("wanted")), "wanted")
    total = per.agg(F.coalesce(F.sum("wanted"), F.lit(0.0))).first()[0]
    n_shards = max(1, -(-round(total) // slots))
    room = round(total / n_shards)
    expected = F.col("wanted") * F.lit(room / total if total else 0.0)
    per = per.withColumn("sure", F.floor(expected + 1e-9).cast("long"))
    per = per.withColumn("rest", F.greatest(expected - F.col("sure"), F.lit(0.0)))
    upto = W.orderBy(F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, W.currentRow)
    per = per.withColumn("sure_to", F.sum("sure").over(upto)).withColumn("rest_to", F.sum("rest").over(upto))
    per = per.withColumn("sure_from", F.col("sure_to") - F.col("sure")).withColumn("rest_from", F.col("rest_to") - F.col("rest"))
    lots = stored(per, "lots")
    n_sure, n_rest = lots.agg(F.coalesce(F.sum("sure"), F.lit(0)), F.coalesce(F.sum("rest"), F.lit(0.0))).first()
    sure = spark.range(n_shards * n_sure).select(
        F.floor(F.col("id") / max(n_sure, 1)).cast("long").alias("shard"), (F.col("id") % max(n_sure, 1)).alias("slot")
    )
    sure = _looked_up(sure, F.col("slot"), lots, "sure_from", "sure_to", max(n_sure, 1)).select(
        "source", "blocks", "shard", (F.col("shard") * F.col("sure") + F.col("slot") - F.col("sure_from")).alias("k")
    )
    left = max(room - n_sure, 0) if n_rest > 0 else 0
    drawn = spark.range(n_shards * left).select(
        F.floor(F.col("id") / max(left, 1)).cast("long").alias("shard"), (F.col("id") % max(left, 1)).alias("slot")
    )
    drawn = _looked_up(drawn, _uniform(F.col("shard"), F.col("slot"), seed) * n_rest, lots, "rest_from", "rest_to", n_rest or 1.0)
    drawn = drawn.select(
        "source", "blocks", "sure", "shard", "slot", F.floor(F.col("shard") / SHARDS_PER_BIN).alias("bin"), F.lit(1).alias("one")
    )
    drawn = running(drawn, "source", "bin", "one", ["shard", "slot"], "rank").select(
        "source", "blocks", "shard", (F.lit(n_shards) * F.col("sure") + F.col("rank")).alias("k")
    )
    return sure.unionByName(drawn).filter(F.col("k") < F.floor(most * F.col("blocks")))


def draw_blocks(per_source: DataFrame, block: int, slots: int, most: float, seed: int) -> DataFrame:
    """(source, shard, k, block, epoch): the block that each slot takes, and how often it came before."""
    k = F.col("k") % F.col("blocks")
    epoch = F.floor(F.col("k") / F.col("blocks")).cast("long")
    key = F.xxhash64(F.col("source"), epoch, F.lit(seed))
    return draw_slots(per_source, block, slots, most, seed).select(
        "source", "shard", "k", permuted(k, F.col("blocks"), key).alias("block"), epoch.alias("epoch")
    )


def _sized(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    return stored(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sizes",
    )


def _taken_pieces(sizes: DataFrame, per_source: DataFrame, block: int, slots: int, most: float, seed: int) -> DataFrame:
    """(row, epoch, first, words): runs of a document's words that the mix takes; first counts from 0."""
    n_bins = sizes.agg((F.count(F.lit(1)) / ROWS_PER_BIN).cast("long") + 1).first()[0]
    # documents in a fixed random order; rows alike in id and size are interchangeable
    binned = sizes.withColumn("bin", F.pmod(F.xxhash64("doc_id", "size", F.lit("bin")), F.lit(n_bins)))
    placed = running(binned, "source", "bin", "size", ["doc_id", "size", "row"], "start").filter(F.col("size") > 0)
    end = F.col("start") + F.col("size")
    spread = placed.select(
        "row", "source", "start", "size",
        F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))).alias("block"),
    )
    # `first` and `words`: the part of the block that lies in this document
    low = F.greatest(F.col("block") * block, F.col("start"))
    high = F.least((F.col("block") + 1) * block, end)
    spread = spread.select(
        "row", F.col("source").alias("of"), "block", (low - F.col("start")).alias("first"), (high - low).alias("words")
    )
    drawn = draw_blocks(per_source, block, slots, most, seed).select("source", F.col("block").alias("at"), "epoch")
    return spread.join(drawn, F.col("of").eqNullSafe(F.col("source")) & (F.col("block") == F.col("at"))).select(
        "row", "epoch", "first", "words"
    )


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS,
    share: float = SHARE, most: float = MOST, block: int = BLOCK, slots: int = SLOTS, seed: int = 7,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    taken counts the words the mix takes from the document, repeats included, at most `most` times its
    size. Null and empty texts have size 0 and take nothing; a source without words has target 0; null is a
    source of its own, after all others; null and repeated ids are rows like any other. The same rows give the
    same result however they are partitioned. Other columns of docs are not read.
    """
    sizes = _sized(docs, doc_id, text, source)
    per_source = stored(sources_table(sizes, weights, share, most), "sources")
    taken = _taken_pieces(sizes, per_source, block, slots, most, seed).groupBy("row").agg(F.sum("words").alias("taken"))
    per_source = per_source.select(F.col("source").alias("of"), "source_size", "target")
    return (
        sizes.join(taken, "row", "left")
        .join(per_source, F.col("source").eqNullSafe(F.col("of")))
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def mix_texts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS,
    share: float = SHARE, most: float = MOST, block: int = BLOCK, slots: int = SLOTS, seed: int = 7,
) -> DataFrame:
    """The mix itself, in the columns of docs: a row per document and epoch, holding the words that are taken.

    Words keep the white space that follows them. A document of which nothing is taken has no row; one that is
    taken twice has two. A column of docs may have any name but the four that start with `_mix_`.
    """
    kept = stored(docs.withColumn("_mix_row", F.monotonically_increasing_id()), "mixed")
    sizes = stored(
        kept.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
            F.col("_mix_row").alias("row"),
        ),
        "sizes",
    )
    per_source = stored(sources_table(sizes, weights, share, most), "sources")
    pieces = _taken_pieces(sizes, per_source, block, slots, most, seed)
    pieces = pieces.groupBy(F.col("row").alias("_mix_row"), F.col("epoch").alias("_mix_epoch")).agg(
        F.array_sort(F.collect_list(F.struct((F.col("first") + 1).cast("int").alias("first"), F.col("words").cast("int").alias("words")))).alias("_mix_pieces")
    )
    words = F.regexp_extract_all(F.col(text), F.lit(f"({WORD}[{SPACES}]*)"))
    taken = lambda w: F.transform("_mix_pieces", lambda p: F.array_join(F.slice(w, p["first"], p["words"]), ""))
    cut = let(words, lambda w: F.array_join(taken(w), ""))  # a text is cut into words once, not once a piece
    mixed = kept.join(pieces, "_mix_row")
    return mixed.select(*[cut.alias(c) if c == text else F.col(c) for c in docs.columns])

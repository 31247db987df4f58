"""Exact de-duplication over an extendible-hash index kept in shared files.

The key of a text is its 64-bit hash. A directory maps the leading bits of a key to a bucket. It
starts with one bucket and doubles: every bucket with more distinct keys than its capacity splits
in two by the next bit, until none is overfull. Each bucket is a range of keys; the task that owns
it chains the texts that share a key and tells them apart by their bytes.

Hot texts do no harm: copies collapse map-side before the only shuffle of texts, and the narrow
index rows of a hot key meet their copies in a join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import stored

#: Depth of the finest directory: 2^16 entries of 16 bytes, about 1 MB, whatever the corpus.
MAX_DEPTH = 16


def _prefix(key: Column, depth: int) -> Column:
    """The leading bits of a key, as a number from 0 to 2^depth - 1."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int, max_depth: int = MAX_DEPTH) -> tuple[DataFrame, int]:
    """(prefix, bucket, local_depth) for every prefix of the global depth, and that depth.

    keys: distinct keys in column `key`. The counts by finest prefix are at most 2^max_depth rows.
    A bucket is the first prefix of its range at the finest depth. At max_depth buckets may stay
    overfull; they only grow longer, nothing is dropped.
    """
    fine = stored(
        keys.groupBy(_prefix(F.col("key"), max_depth).alias("fine")).agg(F.count(F.lit(1)).alias("fill")), "fills"
    )
    depth = 0
    while depth < max_depth:
        bucket = F.shiftright("fine", max_depth - depth)
        overfull = fine.groupBy(bucket.alias("b")).agg(F.sum("fill").alias("fill")).filter(F.col("fill") > capacity)
        if overfull.isEmpty():
            break
        depth += 1
    # the depth at which the bucket of a prefix stops being overfull, for all depths up to the global one
    sums = [
        F.sum("fill").over(W.partitionBy(F.shiftright("fine", max_depth - d))).alias(f"fill_{d}") for d in range(depth)
    ]
    by_prefix = fine.groupBy(F.shiftright("fine", max_depth - depth).alias("fine")).agg(F.sum("fill").alias("fill"))
    by_prefix = by_prefix.select(F.shiftleft("fine", max_depth - depth).alias("fine"), "fill").select("fine", *sums)
    local = F.lit(depth)
    for d in reversed(range(depth)):
        local = F.when(F.col(f"fill_{d}") <= capacity, F.lit(d)).otherwise(local)
    out = by_prefix.select(
        F.shiftright("fine", max_depth - depth).alias("prefix"), "fine", local.cast("int").alias("local_depth")
    )
    below = F.pow(F.lit(2), max_depth - F.col("local_depth")).cast("long")
    return out.select("prefix", (F.col("fine") - F.col("fine") % below).alias("bucket"), "local_depth"), depth


def _text_key(text: Column) -> Column:
    return F.xxhash64(text)


def exact_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", key=_text_key, capacity: int = 20_000,
    max_depth: int = MAX_DEPTH,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, bucket, chain.

    Texts are equal when their bytes are; null counts as empty, and all empty texts are one group.
    Of equal texts the row with the largest doc_id stays (a null id is the smallest). Rows that
    repeat id and text are one group like any other: exactly one of them stays. `chain` is the place
    of a text among the texts of its key, 0 unless hashes collide. No documents give no rows. Other
    columns of docs, whatever their names, are not read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), key(body).cast("long").alias("key"), F.sha2(body, 256).alias("sha"),
        F.monotonically_increasing_id().alias("row"),
    )
    entries = stored(rows, "entries")
    lookup, depth = directory(entries.select("key").distinct(), capacity, max_depth)
    lookup = F.broadcast(stored(lookup, "directory"))  # at most 2^max_depth rows

    def placed(df):
        """df with the bucket of each key."""
        return df.withColumn("prefix", _prefix(F.col("key"), depth)).join(lookup, "prefix").drop("prefix")

    # what owners compare: the texts of a key, byte by byte, each once
    texts = docs.select(key(body).cast("long").alias("key"), body.alias("body")).groupBy("key", "body").agg(
        F.count(F.lit(1)).alias("copies")
    )
    chains = placed(texts.select("key", F.sha2("body", 256).alias("sha"), "copies")).select(
        "key", "sha", "bucket", "copies",
        (F.row_number().over(W.partitionBy("bucket", "key").orderBy("sha")) - 1).alias("chain"),
    )
    stays = entries.groupBy("key", "sha").agg(F.max(F.struct("doc_id", "row")).alias("stays"))
    index = stored(chains.join(stays, ["key", "sha"]).repartitionByRange("bucket", "key"), "index")
    found = entries.join(index, ["key", "sha"])
    return found.select(
        "doc_id", F.col("stays.doc_id").alias("keep_id"), F.col("copies").alias("group_size"),
        (F.col("row") == F.col("stays.row")).alias("kept"), F.col("sha").alias("text_sha256"), "bucket", "chain",
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of docs that stay, with all their columns; of rows alike in id and text, one.

    No column of docs may begin with `_stay_`.
    """
    judged = exact_dedup(docs, doc_id, text, **options).filter("kept")
    stays = judged.select(F.xxhash64("doc_id").alias("_stay_id"), F.col("text_sha256").alias("_stay_sha"))
    marked = docs.withColumns(
        {"_stay_id": F.xxhash64(doc_id), "_stay_sha": F.sha2(F.coalesce(F.col(text), F.lit("")), 256)}
    )
    # the join deals rows out by id and text, so the window over the same two needs no other exchange
    same = W.partitionBy("_stay_id", "_stay_sha").orderBy(F.lit(0))
    first = marked.join(stays, ["_stay_id", "_stay_sha"]).withColumn("_stay_n", F.row_number().over(same))
    return first.filter("_stay_n = 1").select(*docs.columns)

"""Token counts: pieces once per distinct pre-token, times how often each document has it.

Documents give, by chunk, their pre-token frequencies, dealt out by a hash of the pre-token to buckets. The task
of a bucket counts the pieces of each of its pre-tokens once, multiplies by the frequencies and sends one vector
of sums back to each chunk; there the vectors of all buckets add up. Ids exist only while the pieces of a
pre-token are counted. A pre-token that every document has costs each chunk one list of documents, like any other.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import ByteBPE
from .packing import pack, unpack

CHUNK_CHARS = 1 << 24
#: Buckets: as many as the input has partitions, within these bounds. More would only cut the lists of a chunk smaller.
BUCKETS = (12, 4096)
LIMIT = 512
MOST_REMEMBERED = 1_000_000



def _frequencies(path: str, buckets: int, kind: pa.DataType):
    """(row, text) -> a header per chunk, and per chunk and bucket its pre-tokens and who has them how often."""

    def run(batches):
        from pyspark import TaskContext

        bpe, part, chunk = ByteBPE(path), TaskContext.get().partitionId(), 0
        names = ["chunk", "bucket", "rows", "sizes", "words", "lists"]

        def out(rows, sizes, numbers, found):
            nonlocal chunk
            key = (part << 32) + chunk
            chunk += 1
            words = list(numbers)
            doc = np.repeat(np.arange(len(found)), [len(x) for x in found])
            flat = np.concatenate(found) if found else np.zeros(0, np.int64)
            pair, n = np.unique(flat * len(rows) + doc, return_counts=True)  # by pre-token, then document
            word, doc = pair // max(len(rows), 1), pair % max(len(rows), 1)
            place = np.array([zlib.crc32(w.encode("utf-8", "replace")) % buckets for w in words], np.int64)
            in_bucket = place[word]
            order = np.argsort(in_bucket, kind="stable")
            word, doc, n = word[order], doc[order], n[order]
            cut = np.searchsorted(in_bucket[order], np.arange(buckets + 1))
            of_bucket = np.argsort(place, kind="stable")
            word_cut = np.searchsorted(place[of_bucket], np.arange(buckets + 1))
            none = pa.array([None], pa.list_(kind))
            yield pa.RecordBatch.from_arrays(
                [pa.array([key], pa.int64()), pa.array([key % buckets], pa.int32()), pa.array([rows], pa.list_(kind)),
                 pa.array([sizes], pa.list_(pa.int64())), pa.array([None], pa.binary()), pa.array([None], pa.binary())], names,
            )
            for b in range(buckets):
                if cut[b] == cut[b + 1]:
                    continue
                own = [words[i].encode("utf-8", "replace") for i in of_bucket[word_cut[b] : word_cut[b + 1]]]
                span = slice(cut[b], cut[b + 1])
                holders = np.unique(word[span], return_counts=True)[1]
                text = b"".join(own)
                packed = pack(np.array([len(w) for w in own]), np.frombuffer(text, np.uint8))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key], pa.int64()), pa.array([b], pa.int32()), none, pa.array([None], pa.list_(pa.int64())),
                     pa.array([packed], pa.binary()), pa.array([pack(holders, doc[span], n[span])], pa.binary())], names,
                )

        rows, sizes, numbers, found, chars = [], [], {}, [], 0
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                pieces = bpe.pieces(text)
                for p in set(pieces).difference(numbers):
                    numbers[p] = len(numbers)
                rows.append(row)
                sizes.append(len(text.encode()))
                found.append(np.fromiter(map(numbers.__getitem__, pieces), np.int64, len(pieces)))
                chars += len(text) + 64
                if chars >= CHUNK_CHARS:
                    yield from out(rows, sizes, numbers, found)
                    rows, sizes, numbers, found, chars = [], [], {}, [], 0
        if rows:
            yield from out(rows, sizes, numbers, found)

    return run


def _sums(path: str, kind: pa.DataType):
    """Headers as they are; the lists of a chunk and bucket -> the tokens that they bring each document of the chunk."""

    def run(batches):
        bpe, pieces = ByteBPE(path), {}
        special = {s.encode() for s in bpe.special}
        for batch in batches:
            done = []
            parts = [
                None if packed is None else unpack(packed) for packed in batch.column("words").to_pylist()
            ]
            texts = []
            for part in parts:
                body = part[1].astype(np.uint8).tobytes() if part else b""
                end = np.cumsum(part[0]).tolist() if part else []
                texts.append([body[a:b] for a, b in zip([0, *end], end)])
            if len(pieces) > MOST_REMEMBERED:
                pieces.clear()
            new = list(set().union(*texts).difference(pieces))
            pieces.update(zip(new, bpe.count_words(new)))
            pieces.update({s: 1 for s in special})
            for words, part, lists in zip(texts, parts, batch.column("lists").to_pylist()):
                if part is None:
                    done.append(None)
                    continue
                holders, doc, n = unpack(lists)
                each = np.repeat(np.array([pieces[w] for w in words], np.int64), holders)
                done.append(pack(np.bincount(doc, n * each).astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("chunk"), batch.column("rows"), batch.column("sizes"), pa.array(done, pa.binary())],
                ["chunk", "rows", "sizes", "sums"],
            )

    return run


def _added(kind: pa.DataType, limit: int):
    def run(table: pa.Table) -> pa.Table:
        head = next(i for i, r in enumerate(table.column("rows")) if r.is_valid)
        rows, sizes = table.column("rows")[head].values, table.column("sizes")[head].values
        total = np.zeros(len(rows), np.int64)
        for packed in table.column("sums").to_pylist():
            if packed is not None:
                part = unpack(packed)[0]
                total[: len(part)] += part
        return pa.table({"doc_id": rows, "n_bytes": sizes, "n_tokens": pa.array(total), "over_limit": pa.array(total > limit)})

    return run


def count_tokens(docs: DataFrame, path: str, row: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens).

    Null and empty texts have no tokens; a special string inside a text is one token; nothing is added or cut. Repeated
    rows and null ids are rows like any other. Only `row` and `text` are read; `row` comes out as doc_id. A table
    without rows gives none. docs must give the same rows in the same order when a task is repeated, as tables do.
    """
    docs = docs.select(F.col(row).alias("row"), F.col(text).alias("text"))
    spark_kind = docs.schema["row"].dataType
    kind = pa.int64() if spark_kind.simpleString() == "bigint" else pa.int32() if spark_kind.simpleString() == "int" else pa.string()
    if pa.types.is_string(kind):
        docs = docs.withColumn("row", F.col("row").cast("string"))
    type_ = docs.schema["row"].dataType.simpleString()
    buckets = min(max(docs.rdd.getNumPartitions(), BUCKETS[0]), BUCKETS[1])
    lists = docs.mapInArrow(
        _frequencies(path, buckets, kind),
        f"chunk long, bucket int, rows array<{type_}>, sizes array<long>, words binary, lists binary",
    )
    sums = lists.repartition(buckets, "bucket").mapInArrow(
        _sums(path, kind), f"chunk long, rows array<{type_}>, sizes array<long>, sums binary"
    )
    out = sums.groupBy("chunk").applyInArrow(
        _added(kind, limit), f"doc_id {type_}, n_bytes long, n_tokens long, over_limit boolean"
    )
    return out

"""Near-duplicates by MinHash with tensored banding.

Two collections of a few MinHash groups each are computed per document, and a table key is a pair of one
group from either: 12 + 12 groups of 3 make 144 tables of 6 hashes from 72 hash functions instead of 864.
Two documents of similarity 0.8 miss each other in all tables with probability 4e-4, of 0.85 with 2e-5.

- Documents with equal shingle sets are one class; only classes are compared, copies cost nothing more.
- A class goes to a table only by groups that it shares with another class, so documents unlike all
  others (nearly all of them) have no table rows at all.
- In a bucket every class is compared with the head of the bucket, not with every other; most groups of
  copies are one component then and done.
- Classes that buckets connect but links do not (yet) are compared with each other, in pairs of blocks of
  bounded size: a task skips whoever it has already found connected and returns only links that connect
  more. No candidate is dropped by number.
- Candidates are compared by their 72 hashes first, then confirmed on their full shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored
from .words import LOWER, blocks, mixed, words_in

GROUPS = 12  # in a collection
PER_GROUP = 3
BLOCK = 400  # classes of one connected group that are compared with each other in one task
#: Share of equal hashes from which a pair is confirmed on its sets. 72 hashes of a pair of similarity 0.8
#: fall below with probability 1e-6.
LEAST_EQUAL = 0.58
#: Comparisons with one head that share a copy of its set.
PER_HEAD_COPY = 2_000
_FACTORS = mixed(np.arange(1, 2 * GROUPS * PER_GROUP + 1, dtype=np.uint64)) | np.uint64(1)
_ADDED = mixed(np.arange(1001, 2 * GROUPS * PER_GROUP + 1001, dtype=np.uint64))


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingles as 64-bit hashes; the whole text is one if it has fewer words."""
    steps = mixed(np.arange(size, dtype=np.uint64) + np.uint64(77)) | np.uint64(1)
    for block in blocks(texts):
        words = words_in(block, LOWER[block.data])
        key, docs = words.key, words.docs
        n = max(0, len(key) - size + 1)
        runs = np.zeros(n, np.uint64)
        for i in range(size):
            runs += key[i : n + i] * steps[i]
        runs = mixed(runs)
        for d in range(block.n):
            a, b = docs[d], docs[d + 1]
            if b - a >= size:
                found = np.sort(runs[a : b - size + 1])
                yield found if len(found) < 2 else found[np.concatenate(([True], found[1:] != found[:-1]))]
            elif b > a:
                yield mixed(np.array([(key[a:b] * steps[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def _set_id(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _signatures(size: int):
    """Batches of (doc_id, text) -> the signature of every text, by whole Arrow columns."""
    group_steps = mixed(np.arange(PER_GROUP, dtype=np.uint64) + np.uint64(5)) | np.uint64(1)

    def run(batches):
        for batch in batches:
            ids, counts, keys, sketches = [], [], [], []
            for found in shingle_sets(batch.column(1), size):
                counts.append(len(found))
                if not len(found):
                    ids.append(None)
                    keys.append(None)
                    sketches.append(None)
                    continue
                least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
                for i in range(0, len(found), 4096):
                    part = found[i : i + 4096]
                    least = np.minimum(least, (part[None, :] * _FACTORS[:, None] + _ADDED[:, None]).min(axis=1))
                least = mixed(least)
                ids.append(_set_id(found))
                groups = mixed((least.reshape(-1, PER_GROUP) * group_steps).sum(axis=1, dtype=np.uint64))
                keys.append(groups.view(np.int64))
                sketches.append((least >> np.uint64(56)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                ["doc_id", "n_shingles", "set_id", "groups", "sketch"],
            )

    return run


def _sets(size: int):
    """Batches of (set_id, text) -> (set_id, shingles) for the rows whose text has that very set."""

    def run(batches):
        for batch in batches:
            ids, out = [], []
            for want, found in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), size)):
                if len(found) and _set_id(found) == want:
                    ids.append(want)
                    out.append(found.tobytes())
                if len(ids) == 500:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(out, pa.binary())], ["set_id", "shingles"])
                    ids, out = [], []
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(out, pa.binary())], ["set_id", "shingles"])

    return run


def _alike_sketches(batches):
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sketch_x", "sketch_y"))
        keep = (a == b).mean(axis=1) >= LEAST_EQUAL if batch.num_rows else np.zeros(0, bool)
        yield batch.select(["x", "y"]).filter(pa.array(keep))


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are linked."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    both = int((y[at] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _set(value) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint64)


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            keep = [_alike(_set(a), _set(b), percent) for a, b in zip(batch.column("set_x"), batch.column("set_y"))]
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return run


def _connecting(percent: int):
    """The rows of two blocks (or of one with itself) -> links that connect what labels do not."""

    def run(table: pa.Table) -> pa.Table:
        x, block = table.column("x").to_pylist(), np.array(table.column("block").to_pylist())
        names = {}
        root = np.array([names.setdefault(v, len(names)) for v in table.column("label").to_pylist()])
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(x), -1)
        sets = table.column("shingles").combine_chunks()
        two, found = len(set(block.tolist())) > 1, []
        for i in range(len(x) - 1):
            other = i + 1 + np.flatnonzero((root[i + 1 :] != root[i]) & ((block[i + 1 :] != block[i]) | (not two)))
            if not len(other):
                continue
            equal = (sketch[other] == sketch[i]).mean(axis=1)
            for j in other[equal >= LEAST_EQUAL][np.argsort(-equal[equal >= LEAST_EQUAL])].tolist():
                if root[j] != root[i] and _alike(_set(sets[i]), _set(sets[j]), percent):
                    root[root == root[j]] = root[i]
                    found.append((x[i], x[j]))
        return pa.table({"x": pa.array([a for a, _ in found], pa.binary()), "y": pa.array([b for _, b in found], pa.binary())})

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of edges (x, y): the smallest node of each connected component.

    Alternating large and small stars; every step is stored, so lineage stays short.
    """
    edges = stored(edges.filter("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), "star")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.filter("y > x").join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).distinct()
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).filter("x <> y")
        small = small.unionByName(least.select("x", F.col("m").alias("y"))).distinct()
        edges = stored(small.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")), "star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y") % 1_000_003)).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("x").alias("node"), F.col("y").alias("label")).unionByName(
        edges.select(F.col("y").alias("node"), F.col("y").alias("label")).distinct()
    )


def _shared_groups(classes: DataFrame, low: int) -> DataFrame:
    """(set_id, held): the groups of one collection that a class shares with some other class."""
    rows = classes.select("set_id", F.posexplode(F.slice("groups", low + 1, GROUPS)).alias("g", "key"))
    many = rows.groupBy("g", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return rows.join(many, ["g", "key"]).groupBy("set_id").agg(F.collect_list(F.struct("g", "key")).alias("held"))


def _candidates(classes: DataFrame) -> DataFrame:
    """Distinct (x, y): a class and the smallest class, the head, of a bucket that holds both."""
    first = _shared_groups(classes, 0).withColumnRenamed("held", "first")
    second = _shared_groups(classes, GROUPS).withColumnRenamed("held", "second")
    rows = first.join(second, "set_id").select("set_id", F.explode("first").alias("a"), "second")
    rows = rows.select(F.col("set_id").alias("x"), "a", F.explode("second").alias("b"))
    rows = stored(rows.select(F.xxhash64("a.g", "a.key", "b.g", "b.key").alias("bucket"), "x"), "tables")
    heads = rows.groupBy("bucket").agg(F.min("x").alias("y"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return stored(rows.join(heads, "bucket").filter("x <> y").select("x", "y").distinct(), "candidates")


class _Confirmer:
    """Which candidate pairs are links, on sketches first and full sets then."""

    def __init__(self, docs: DataFrame, classes: DataFrame, needed: DataFrame, size: int, percent: int):
        self.percent = percent
        self.sketches = classes.select("set_id", "sketch")
        wanted = classes.join(needed, "set_id").select(F.col("rep").alias("of"), "set_id")
        texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("of"))).select("set_id", "text")
        sets = texts.mapInArrow(_sets(size), "set_id binary, shingles binary")
        self.sets = stored(sets.dropDuplicates(["set_id"]), "sets")

    def links(self, pairs: DataFrame) -> DataFrame:
        """pairs (x, y), y the head where many share one -> those that are links, stored."""
        own = self.sketches
        near = pairs.join(own.select(F.col("set_id").alias("y"), F.col("sketch").alias("sketch_y")), "y")
        near = near.join(own.select(F.col("set_id").alias("x"), F.col("sketch").alias("sketch_x")), "x")
        near = stored(near.mapInArrow(_alike_sketches, "x binary, y binary"), "near")
        # the set of a head that many pairs share is copied, so that no task gets all of them
        copies = near.groupBy("y").agg(F.ceil(F.count(F.lit(1)) / PER_HEAD_COPY).cast("int").alias("copies"))
        spread = near.join(copies, "y").withColumn("copy", F.pmod(F.xxhash64("x"), F.col("copies")).cast("int"))
        heads = copies.join(self.sets.withColumnRenamed("set_id", "y"), "y").select(
            "y", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.col("shingles").alias("set_y")
        )
        full = spread.join(heads, ["y", "copy"]).select("x", "y", "set_y")
        full = full.join(self.sets.select(F.col("set_id").alias("x"), F.col("shingles").alias("set_x")), "x")
        return stored(full.select("x", "y", "set_x", "set_y").mapInArrow(_confirm(self.percent), "x binary, y binary"), "links")


    def links_between(self, groups: DataFrame, block: int) -> DataFrame:
        """(x, label, group) -> links between classes of one group but of several labels, as many as connect them."""
        size = groups.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
        rows = groups.join(size, "group").withColumn("block", F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int"))
        rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = rows.select("group", F.least("block", "with").alias("a"), F.greatest("block", "with").alias("b"), "x", "label", "block")
        full = rows.join(self.sketches.withColumnRenamed("set_id", "x"), "x").join(self.sets.withColumnRenamed("set_id", "x"), "x")
        return full.groupBy("group", "a", "b").applyInArrow(_connecting(self.percent), "x binary, y binary")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, percent: int = 80, block: int = BLOCK
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * |intersection| >= percent * |union| of their sets of distinct shingles of
    `shingle` lower-cased words; a text with fewer words is one shingle. component_id is the smallest doc_id that
    links reach, the document itself included; kept says that it is the document's own. Null and empty texts and
    texts of white space have no shingles and no links. Rows with equal sets are linked however many there are; rows that
    repeat an id are linked like any others. A null id counts as no id: it is nobody's component unless the
    whole component has none. Other columns are not read. A table without rows gives none.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = docs.mapInArrow(
        _signatures(shingle), "doc_id long, n_shingles long, set_id binary, groups array<long>, sketch binary"
    )
    signed = stored(signed, "signatures")
    classes = signed.filter("n_shingles > 0").groupBy("set_id").agg(
        F.min("doc_id").alias("rep"), F.any_value("groups").alias("groups"), F.any_value("sketch").alias("sketch")
    )
    classes = stored(classes, "classes")
    candidates = _candidates(classes)
    needed = candidates.select(F.col("x").alias("set_id")).union(candidates.select("y")).distinct()
    confirmer = _Confirmer(docs, classes, needed, shingle, percent)
    links = confirmer.links(candidates)
    labels = stored(components(links), "labels")
    groups = components(candidates).select(F.col("node").alias("x"), F.col("label").alias("group"))
    groups = groups.join(labels.withColumnRenamed("node", "x"), "x", "left").withColumn("label", F.coalesce("label", "x"))
    groups = stored(groups, "groups")
    # groups of two have been compared; others whose members links do not all connect go on
    open_ = groups.groupBy("group").agg(F.min("label").alias("l"), F.max("label").alias("m"), F.count(F.lit(1)).alias("n"))
    more = stored(confirmer.links_between(groups.join(open_.filter("l <> m AND n > 2").select("group"), "group"), block), "links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    named = classes.select("set_id", "rep").join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
    named = named.withColumn("label", F.coalesce("label", "set_id"))
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    of_set = named.join(least, "label").select("set_id", "component_id")
    out = signed.select("doc_id", "n_shingles", "set_id").join(of_set, "set_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of docs that stay, with all their columns: one id of each component, and what is in none.

    Documents without shingles stay. The rows of a repeated id stay if any of them does. No column of docs may be
    named `_stay_id`.
    """
    judged = near_duplicates(docs, doc_id, text, **options)
    gone = judged.groupBy(F.col("doc_id").alias("_stay_id")).agg(F.max("kept").alias("any")).filter("NOT any").select("_stay_id")
    return docs.join(gone, F.col(doc_id).cast("long").eqNullSafe(F.col("_stay_id")), "left_anti")

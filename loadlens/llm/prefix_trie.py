"""Burst trie over conversations: which ones begin alike, how often a beginning is shared, and what sharing spares.

Conversations lie in containers under the heads of a trie; at first one container under the root holds all. A container
with more than `most` turns and conversations bursts: its conversations move to one container per next turn id, and its
head stays as a node of the trie. All containers of a depth burst in the same Spark jobs, and moving is a join on the
conversation, so neither a hot beginning nor a table of copies gathers in one task. When no container is too large, those
with several conversations are sorted and swept into nodes, each by one task that holds at most `most` rows of it; one
with a single conversation is a chain of nodes as it stands. Sums over subtrees then go up from heads to heads.

A turn id is the first 16 bytes of the SHA-256 of role and text. There are as many rounds as the longest beginning that
an oversized container shares.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import stored, word_count

#: Turns and conversations of a container that one task sorts.
MOST = 2_000
NOTHING = hashlib.sha256(b"").hexdigest()
NODE = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [T.StructField("ends_sha256", T.StringType())]
)
HEAD = T.StructType([*NODE, T.StructField("parent", T.BinaryType())])


def _id(*parts: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, position from 1, turn_id, words: the turns in order, without their texts.

    Order: turn, nulls first, then the turn id. Rows without conv_id belong to no conversation and are left out; null
    role or text is empty; other columns are not read. Turns are dealt out by ranges, so a conversation of any length is
    numbered by many tasks: each counts from 1, and what lies in earlier tasks is added to the one conversation that may
    go on from the task before.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    role = text("role")
    turn_id = _id(F.length(role).cast("string").cast("binary"), F.lit(b":"), role.cast("binary"), text("text").cast("binary"))
    light = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), "turn", turn_id.alias("turn_id"), word_count(F.col("text")).alias("words"))
    light = stored(light, "light")  # dealing by range reads its input twice; texts are read once
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "turn", "turn_id"]
    schema = T.StructType([T.StructField(*x) for x in (("conv_id", T.LongType()), ("position", T.LongType()), ("turn_id", T.BinaryType()), ("words", T.LongType()), ("part", T.IntegerType()))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            begins = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            at = np.arange(len(ids)) - np.repeat(begins, np.diff(np.r_[begins, len(ids)])) + 1
            if ids[0] == last:
                at[: begins[1] if len(begins) > 1 else len(ids)] += seen
            last, seen = ids[-1], at[-1]
            columns = [batch.column(0), pa.array(at, pa.int64()), batch.column(1), batch.column(2), pa.array(np.full(len(ids), part), pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    dealt = light.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv_id", "turn_id", "words")
    counted = stored(dealt.mapInArrow(count, schema), "turns")
    spans = counted.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window

    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # at most one conversation goes on in each part: no more rows than parts
    offsets = spans.withColumn("before", F.sum("n").over(before)).filter("before > 0").select("conv_id", "part", "before")
    position = F.col("position") + F.coalesce("before", F.lit(0))
    return counted.join(F.broadcast(offsets), ["conv_id", "part"], "left").select("conv_id", position.alias("position"), "turn_id", "words")


def lengths(turns: DataFrame) -> DataFrame:
    return turns.groupBy("conv_id").agg(F.max("position").alias("length"))


def shared_beginnings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """turns and lengths after conversation c has taken its first h turns from conversation c - c % 20.

    h is crc32(c) % 4. All turns are taken if there are fewer, none if there is no such conversation; c's own turns
    after its first h follow. A conversation may end up without turns; it keeps its row in the lengths.
    """
    had = stored(lengths(turns), "lengths")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    wanted = had.select("conv_id", (F.col("conv_id") - F.pmod("conv_id", F.lit(20))).alias("giver"), h.alias("h"), "length")
    givers = had.filter(F.pmod("conv_id", F.lit(20)) == 0).select(F.col("conv_id").alias("giver"), F.col("length").alias("given"))
    got = F.least("h", F.coalesce("given", F.lit(0)))
    after = F.greatest(F.col("length") - F.col("h"), F.lit(0))
    wanted = stored(wanted.join(givers, "giver", "left").select("conv_id", "giver", "h", got.alias("got"), (got + after).alias("length")), "wanted")
    lent = turns.filter((F.pmod("conv_id", F.lit(20)) == 0) & (F.col("position") < 4)).withColumnRenamed("conv_id", "giver")
    taken = wanted.filter("got > 0").select("conv_id", "giver", "got").join(lent, "giver").filter("position <= got")
    own = turns.join(wanted.select("conv_id", "h", "got"), "conv_id").filter("position > h")
    columns = ("conv_id", "position", "turn_id", "words")
    own = own.withColumn("position", F.col("position") - F.col("h") + F.col("got")).select(*columns)
    return taken.select(*columns).unionByName(own), wanted.select("conv_id", "length")


def _swept(rows: list[tuple]) -> Iterator[dict]:
    """The nodes of a container, its head first. rows: (key, conv, depth, turn id, words, ...), the head's turn id null."""
    head = rows[0]
    _, _, top, _, words, parent, parent_conv = head
    items = [(tuple(r[3] for r in turns[1:]), conv, [r[4] for r in turns[1:]]) for conv, turns in ((c, list(t)) for c, t in groupby(rows, key=itemgetter(1)))]
    items.sort(key=itemgetter(0, 1))
    above, depth, size, ends = [-1], [top], [words], [[]]
    path, before = [0], ()
    for turns, conv, counts in items:
        alike = next((i for i, (a, b) in enumerate(zip(before, turns)) if a != b), min(len(before), len(turns)))
        del path[alike + 1 :]
        for i in range(alike, len(turns)):
            above.append(path[-1])
            depth.append(top + i + 1)
            size.append(counts[i])
            ends.append([])
            path.append(len(above) - 1)
        ends[path[-1]].append(conv)
        before = turns
    n = len(above)
    convs, low, children, leaves, saved = [0] * n, [None] * n, [0] * n, [0] * n, [0] * n
    for i in reversed(range(n)):
        convs[i] += len(ends[i])
        low[i] = min([*ends[i], *([] if low[i] is None else [low[i]])])
        leaves[i] = leaves[i] or 1
        saved[i] += (convs[i] - 1) * size[i]
        if i:
            a = above[i]
            convs[a] += convs[i]
            low[a] = low[i] if low[a] is None else min(low[a], low[i])
            children[a] += 1
            leaves[a] += leaves[i]
            saved[a] += saved[i]
    for i in range(n):
        digest = hashlib.sha256(",".join(map(str, sorted(ends[i]))).encode()).hexdigest() if ends[i] else NOTHING
        values = (low[i], depth[i], low[above[i]] if i else parent_conv, convs[i], children[i], leaves[i], saved[i], digest)
        yield dict(zip(NODE.names, values)) | {"parent": None if i else parent}


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _sweep(schema: pa.Schema):
    def sweep(batches):
        held = []
        for _, rows in groupby(_rows(batches), key=itemgetter(0)):
            for node in _swept(list(rows)):
                held.append(node)
                if len(held) == 5000:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return sweep


def _end_digests(schema: pa.Schema):
    """(key, conv) in order -> one digest a key, the conversations as a stream."""

    def digests(batches):
        held = []
        for key, rows in groupby(_rows(batches), key=itemgetter(0)):
            digest, between = hashlib.sha256(), b""
            for _, conv in rows:
                digest.update(between + str(conv).encode())
                between = b","
            held.append({"key": key, "ends_sha256": digest.hexdigest()})
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return digests


def trie(turns: DataFrame, members: DataFrame, most: int = MOST) -> DataFrame:
    """The nodes of the trie: the columns of NODE. turns: as numbered(); members: every conversation and its length.

    A node is a distinct sequence of the first `depth` turns; the root has depth 0, and the columns parent_conv_id null.
    conv_id is the smallest member; ends_sha256 the SHA-256 of the ids of members that end at the node, ascending,
    joined by commas. An empty table has no nodes.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    whole = stored(turns, "sequences")
    null = lambda kind: F.lit(None).cast(kind)
    # a conversation's container: its key, the head's depth and last words, and the head above
    first = members.select(
        "conv_id", "length", F.lit(b"").alias("key"), F.lit(0).cast("long").alias("words"), null("binary").alias("parent"), null("long").alias("parent_conv_id")
    )
    depth, levels = 0, []
    while True:
        moved = stored(first, f"level-{depth}")
        size = F.count(F.lit(1)) + F.sum(F.col("length") - depth)
        heads = moved.groupBy("key").agg(
            F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("low"), ((F.count(F.lit(1)) > 1) & (size > most)).alias("burst"),
            F.max("words").alias("head_words"), F.max("parent").alias("head_parent"), F.max("parent_conv_id").alias("head_parent_conv_id"),
        )
        heads = stored(heads, f"heads-{depth}")
        placed = moved.join(heads.select("key", "n_convs", "low", "burst"), "key")
        levels.append((depth, heads, placed))
        if not heads.filter("burst").limit(1).count():
            break
        next_turn = whole.filter(F.col("position") == depth + 1).select("conv_id", "turn_id", F.col("words").alias("next_words"))
        going = placed.filter(F.col("burst") & (F.col("length") > depth)).select("conv_id", "length", "key", "low")
        first = going.join(next_turn, "conv_id").select(
            "conv_id", "length", _id(F.col("key"), F.col("turn_id")).alias("key"), F.col("next_words").alias("words"),
            F.col("key").alias("parent"), F.col("low").alias("parent_conv_id"),
        )
        depth += 1

    union = lambda frames: reduce(lambda a, b: a.unionByName(b), frames)
    closed = stored(union([p.filter("NOT burst").drop("burst", "low").withColumn("depth", F.lit(d).cast("long")) for d, _, p in levels]), "containers")

    # one conversation in a container: a chain
    alone = closed.filter("n_convs = 1").select("conv_id", "length", "depth", "parent", "parent_conv_id")
    chain = alone.join(whole.select("conv_id", "position"), "conv_id").filter("position > depth").select(
        "conv_id", "length", F.col("position").alias("depth"), null("binary").alias("parent"), F.col("conv_id").alias("parent_conv_id")
    )
    last = F.col("depth") == F.col("length")
    one = F.lit(1).cast("long")
    digest = F.when(last, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(NOTHING)
    chains = alone.unionByName(chain).select(
        "conv_id", "depth", "parent_conv_id", one.alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), digest.alias("ends_sha256"), "parent",
    )

    # several: sorted and swept
    several = closed.filter("n_convs > 1")
    marks = several.select("key", "conv_id", "depth", null("binary").alias("turn_id"), "words", "parent", "parent_conv_id")
    suffixes = several.select("key", "conv_id", F.col("depth").alias("top")).join(whole, "conv_id").filter("position > top").select(
        "key", "conv_id", F.col("position").alias("depth"), "turn_id", "words", null("binary").alias("parent"), null("long").alias("parent_conv_id")
    )
    swept = marks.unionByName(suffixes).repartition("key").sortWithinPartitions("key", "conv_id", "depth").mapInArrow(_sweep(to_arrow_schema(HEAD)), HEAD)
    below = stored(chains.select(*HEAD.names).unionByName(swept), "nodes")

    # heads whose containers burst, from the deepest up
    nodes, children = [below.select(*NODE.names)], below.filter("parent IS NOT NULL").select("parent", "n_leaves", "saved_tokens", "depth")
    for d, heads, placed in reversed(levels):
        if d == depth:
            continue
        schema = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("ends_sha256", T.StringType())])
        ended = placed.filter(F.col("burst") & (F.col("length") == d)).select("key", "conv_id")
        ended = ended.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(_end_digests(to_arrow_schema(schema)), schema)
        sums = children.filter(F.col("depth") == d + 1).groupBy(F.col("parent").alias("key")).agg(
            F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
        )
        number = lambda c, other=0: F.coalesce(c, F.lit(other))
        found = heads.filter("burst").join(sums, "key", "left").join(ended, "key", "left").select(
            F.col("low").alias("conv_id"), F.lit(d).cast("long").alias("depth"), F.col("head_parent_conv_id").alias("parent_conv_id"), "n_convs",
            number("n_children").alias("n_children"), number("leaves", 1).alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("head_words") + number("saved")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"), F.col("head_parent").alias("parent"),
        )
        found = stored(found, f"burst-{d}")
        nodes.append(found.select(*NODE.names))
        children = children.unionByName(found.filter("parent IS NOT NULL").select(*children.columns))
    return union(nodes)


def conversation_trie(conversations: DataFrame, most: int = MOST) -> DataFrame:
    """The trie of conversations as they are; cases as in numbered() and trie()."""
    turns = stored(numbered(conversations), "numbered")
    return trie(turns, lengths(turns), most)


def rebuilt_trie(conversations: DataFrame, most: int = MOST) -> DataFrame:
    """The trie after shared_beginnings()."""
    return trie(*shared_beginnings(stored(numbered(conversations), "numbered")), most)


def oracle() -> str:
    """The same nodes in DuckDB: groups of whole prefixes; a node's subtree is found along its smallest member."""
    return """
        WITH own AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS position
            FROM conversations WHERE conv_id IS NOT NULL
        ), convs AS (
            -- crc32: each byte, then eight shifts (marked -1)
            SELECT conv_id, xor(4294967295, list_reduce(
                       list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
                           lambda d: [ascii(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                       lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)) % 4 AS h
            FROM (SELECT DISTINCT conv_id FROM own)
        ), taken AS (
            SELECT c.conv_id, position, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 20 AND position <= h
        ), built AS (
            SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY part, position) AS depth
            FROM (SELECT *, 0 AS part FROM taken
                  UNION ALL SELECT o.conv_id, position, role, text, 1 FROM own o JOIN convs c ON o.conv_id = c.conv_id AND position > h)
        ), prefixes AS (
            SELECT conv_id, 0 AS depth, []::STRUCT(role VARCHAR, text VARCHAR)[] AS prefix, '' AS text FROM convs
            UNION ALL
            SELECT conv_id, depth, list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY depth), text FROM built
        ), ended AS (
            SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM prefixes
        ), nodes AS (
            SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, count(*) FILTER (ends) AS n_ends,
                   coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ending,
                   (count(*) - 1) * len(regexp_extract_all(any_value(text), '[^\\x20\\x09-\\x0D]+')) AS saved
            FROM ended GROUP BY depth, prefix
        ), linked AS (
            SELECT n.*, up.conv_id AS parent_conv_id
            FROM nodes n LEFT JOIN nodes up ON up.depth = n.depth - 1 AND up.prefix = n.prefix[:n.depth - 1]
        ), counted AS (
            SELECT n.*, (SELECT count(*) FROM linked k WHERE k.depth = n.depth + 1 AND k.parent_conv_id = n.conv_id) AS n_children FROM linked n
        ), below AS (
            -- every node with each node on the path of its smallest member above it
            SELECT a.depth, a.prefix, sum((d.n_children = 0)::INT) AS n_leaves, sum(d.saved) AS saved_tokens
            FROM counted d JOIN prefixes p ON p.conv_id = d.conv_id AND p.depth <= d.depth
            JOIN counted a ON a.depth = p.depth AND a.prefix = p.prefix
            GROUP BY a.depth, a.prefix
        )
        SELECT c.conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, b.n_leaves::BIGINT AS n_leaves,
               b.saved_tokens::BIGINT AS saved_tokens, sha256(ending) AS ends_sha256
        FROM counted c JOIN below b USING (depth, prefix)
    """

"""Byte-level BPE: speculate by longest match, verify adjacent pairs, merge exactly where that fails.

A sequence of tokens is the BPE encoding of its bytes when every token is the encoding of its own bytes and no
merge would ever cross the seam between two neighbours. So a word is first cut into longest matches, for many
words at once; all distinct neighbour pairs are then tested together; only words with a failing pair go
through the merges one by one. Every step is exact: the ids are those of merging from single bytes.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The pattern by which byte-level vocabularies split text, and white space as it means it.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)
#: The same for texts of ASCII only, which the standard module does faster.
ASCII_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)
NEVER = np.iinfo(np.int64).max
#: Distinct pre-tokens that a worker remembers before it starts afresh.
MOST_REMEMBERED = 400_000
SLICE_CHARS = 1 << 21


def byte_of_char() -> dict[str, int]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return out | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    """A vocabulary read from a tokenizers .json file; made where it is used."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        chars = byte_of_char()
        self.n = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.bytes = [b""] * self.n
        for token, i in vocab.items():
            self.bytes[i] = bytes(chars[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for text, i in self.special.items():
            self.bytes[i] = text.encode()
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.single = np.full(256, -1, np.int64)
        for token, i in vocab.items():
            if len(self.bytes[i]) == 1:
                self.single[self.bytes[i][0]] = i
        self.left, self.right = np.arange(self.n), np.arange(self.n)
        self.rank = np.full(self.n, -1, np.int64)  # of the merge that makes a token
        self.merge: dict[int, tuple[int, int]] = {}
        for r, pair in enumerate(merges):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right, made = vocab[a], vocab[b], vocab[a + b]
            if self.merge.setdefault(left * self.n + right, (r, made))[0] == r and self.rank[made] < 0:
                self.left[made], self.right[made], self.rank[made] = left, right, r
        pairs = np.array(sorted(self.merge), np.int64)
        self.pairs, self.pair_rank = pairs, np.array([self.merge[k][0] for k in pairs.tolist()], np.int64)
        self.pair_made = np.array([self.merge[k][1] for k in pairs.tolist()], np.int64)
        made = np.flatnonzero(self.rank >= 0)
        # a token that merging its bytes would not give is never proposed
        whole = self.compatible(self.left[made], self.right[made], self.rank[made])
        usable = set(made[whole].tolist()) | set(self.single[self.single >= 0].tolist())
        self._make_trie(usable)
        self.find = regex.compile(PATTERN).findall
        self.find_ascii = re.compile(ASCII_PATTERN).findall
        self.known: dict[str, bytes] = {}

    def _make_trie(self, usable: set[int]) -> None:
        steps: dict[int, int] = {}
        accepts = [-1]
        for i in sorted(usable):
            node = 0
            for b in self.bytes[i]:
                node = steps.setdefault(node << 8 | b, len(accepts))
                if node == len(accepts):
                    accepts.append(-1)
            accepts[node] = i
        self.step_key = np.array(sorted(steps), np.int64)
        self.step_to = np.array([steps[k] for k in self.step_key.tolist()], np.int64)
        self.accepts = np.array(accepts, np.int64)

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """For token pairs: whether no merge (of a rank below `before`) crosses the seam of a and b.

        Going back in time, the symbols beside the seam are a and b, then the right part of a or the left part of b,
        whichever was merged last, and so on. A merge of the two beside the seam comes first if it ranks below the
        merge that takes either of them away; at the same rank the leftmost goes first.
        """
        a, b = a.copy(), b.copy()
        good = np.ones(len(a), bool)
        until = np.full(len(a), NEVER) if before is None else before.copy()  # ranks below it come first
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            key = x * self.n + y
            at = np.searchsorted(self.pairs, key)
            at[at == len(self.pairs)] = 0
            crossing = (self.pairs[at] == key) & (self.pair_rank[at] < until[live])
            good[live[crossing]] = False
            more = ~crossing & ((self.rank[x] >= 0) | (self.rank[y] >= 0))
            live, x, y = live[more], x[more], y[more]
            # the part made last is undone first; of equal merges, that on the right
            undo_left = self.rank[x] > self.rank[y]
            until[live] = np.where(undo_left, self.rank[x], self.rank[y] + 1)
            a[live] = np.where(undo_left, self.right[x], x)
            b[live] = np.where(undo_left, y, self.left[y])
        return good

    def longest_matches(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(word number, token) in order, each word cut into longest matches from its start."""
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        end = np.cumsum([len(w) for w in words])
        at = end - np.array([len(w) for w in words])
        live = np.flatnonzero(at < end)
        found_word, found_token = [], []
        while len(live):
            p, best, best_at = at[live].copy(), np.full(len(live), -1), at[live] + 1
            node, walk = np.zeros(len(live), np.int64), np.arange(len(live))
            while len(walk):
                key = node[walk] << 8 | data[p[walk]]
                j = np.searchsorted(self.step_key, key)
                j[j == len(self.step_key)] = 0
                ok = self.step_key[j] == key
                walk = walk[ok]
                node[walk] = self.step_to[j[ok]]
                p[walk] += 1
                token = self.accepts[node[walk]]
                hit = token >= 0
                best[walk[hit]], best_at[walk[hit]] = token[hit], p[walk[hit]]
                walk = walk[p[walk] < end[live[walk]]]
            found_word.append(live)
            found_token.append(best)
            at[live] = best_at
            live = live[at[live] < end[live]]
        if not found_word:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        word, token = np.concatenate(found_word), np.concatenate(found_token)
        order = np.argsort(word, kind="stable")
        return word[order], token[order]

    def merged(self, word: bytes) -> list[int]:
        """The tokens of a word by merging from single bytes, the lowest rank first, leftmost first."""
        ids = self.single[np.frombuffer(word, np.uint8)].tolist()
        merge, n = self.merge, self.n
        if len(ids) <= 48:
            while len(ids) > 1:
                best = min([merge.get(a * n + b, (NEVER, -1)) for a, b in zip(ids, ids[1:])])
                if best[0] == NEVER:
                    break
                made, out, i = best[1], [], 0
                left, right = int(self.left[made]), int(self.right[made])
                while i < len(ids):
                    if ids[i] == left and i + 1 < len(ids) and ids[i + 1] == right:
                        out.append(made)
                        i += 2
                    else:
                        out.append(ids[i])
                        i += 1
                ids = out
            return ids
        # long words: a queue of (rank, place) over a linked list
        after, prior = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        queue = [(merge[k][0], i) for i in range(len(ids) - 1) if (k := ids[i] * n + ids[i + 1]) in merge]
        heapq.heapify(queue)
        while queue:
            r, i = heapq.heappop(queue)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or merge.get(ids[i] * n + ids[j], (NEVER,))[0] != r:
                continue
            ids[i], ids[j], after[i] = merge[ids[i] * n + ids[j]][1], -1, after[j]
            if after[i] >= 0:
                prior[after[i]] = i
            for a, b in ((prior[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (k := ids[a] * n + ids[b]) in merge:
                    heapq.heappush(queue, (merge[k][0], a))
        return [i for i in ids if i >= 0]

    def merged_many(self, words: list[bytes]) -> list[np.ndarray]:
        """merged() for many short words at once: every round does the next merge of every word."""
        data = np.frombuffer(b"".join(words), np.uint8)
        ids, word = self.single[data], np.repeat(np.arange(len(words)), [len(w) for w in words])
        done_ids, done_word = [], []
        while len(ids):
            same = np.append(word[1:] == word[:-1], False)
            key = ids * self.n + np.append(ids[1:], 0)
            at = np.searchsorted(self.pairs, key)
            at[at == len(self.pairs)] = 0
            rank = np.where(same & (self.pairs[at] == key), self.pair_rank[at], NEVER)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            size = np.diff(np.append(first, len(ids)))
            least = np.minimum.reduceat(rank, first)
            ended = np.repeat(least == NEVER, size)
            done_ids.append(ids[ended])
            done_word.append(word[ended])
            # the leftmost pair of the lowest rank of each word
            best = np.flatnonzero((rank == np.repeat(least, size)) & ~ended)
            best = best[np.append(True, word[best][1:] != word[best][:-1])] if len(best) else best
            ids = ids.copy()
            ids[best] = self.pair_made[at[best]]
            keep = ~ended
            keep[best + 1] = False
            ids, word = ids[keep], word[keep]
        ids, word = np.concatenate(done_ids or [ids]), np.concatenate(done_word or [word])
        order = np.argsort(word, kind="stable")
        return np.split(ids[order], np.searchsorted(word[order], np.arange(1, len(words))))

    def _exact(self, words: list[bytes], failing: list[int]):
        """(number, ids) of the words that need merging."""
        short = [i for i in failing if len(words[i]) <= 48]
        yield from zip(short, self.merged_many([words[i] for i in short]) if short else ())
        for i in failing:
            if len(words[i]) > 48:
                yield i, self.merged(words[i])

    def _proposed(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """The longest matches, and the numbers of the words that have an incompatible pair."""
        word, token = self.longest_matches(words)
        pair = np.flatnonzero(word[1:] == word[:-1])
        keys, which = np.unique(token[pair] * self.n + token[pair + 1], return_inverse=True)
        good = self.compatible(keys // self.n, keys % self.n)
        return word, token, np.unique(word[pair[~good[which]]]).tolist()

    def count_words(self, words: list[bytes]) -> list[int]:
        """The number of tokens of each word."""
        word, _, failing = self._proposed(words)
        out = np.bincount(word, minlength=len(words)).tolist()
        for i, ids in self._exact(words, failing):
            out[i] = len(ids)
        return out

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as little-endian unsigned 32-bit integers."""
        word, token, failing = self._proposed(words)
        packed = token.astype("<u4").tobytes()
        cut = np.searchsorted(word, np.arange(len(words) + 1)) * 4
        out = [packed[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
        for i, ids in self._exact(words, failing):
            out[i] = np.asarray(ids, "<u4").tobytes()
        return out

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a text; a special string is one."""
        find = self.find_ascii if text.isascii() else self.find
        if self.split is None or not any(s in text for s in self.special):
            return find(text)
        out = []
        for i, part in enumerate(self.split.split(text)):
            out += [part] if i % 2 else find(part)
        return out

    def learn(self, pieces: set[str]) -> None:
        """Remember the ids of these pre-tokens."""
        if len(self.known) + len(pieces) > MOST_REMEMBERED:
            self.known.clear()
        if not self.known:
            self.known = {s: np.array([i], "<u4").tobytes() for s, i in self.special.items()}
        new = [p for p in pieces if p not in self.known]
        if new:
            self.known.update(zip(new, self.encode_words([p.encode("utf-8", "replace") for p in new])))

    def encode_all(self, texts):
        """For each text its ids, packed; texts are looked at in slices, so that words are encoded together."""
        part, chars = [], 0
        for text in texts:
            part.append(text)
            chars += len(text)
            if chars >= SLICE_CHARS:
                yield from self._encode_slice(part)
                part, chars = [], 0
        yield from self._encode_slice(part)

    def _encode_slice(self, texts):
        cut = [self.pieces(t) for t in texts]
        self.learn(set().union(*cut))
        get = self.known.__getitem__
        for pieces in cut:
            yield b"".join(map(get, pieces))

    def decode(self, packed: bytes) -> bytes:
        """The text of packed ids in UTF-8, bytes that are none replaced."""
        out = b"".join(map(self.bytes.__getitem__, np.frombuffer(packed, "<u4").tolist()))
        try:
            out.decode()
        except UnicodeDecodeError:
            out = out.decode("utf-8", "replace").encode()
        return out


def _encoded(path: str):
    def run(batches):
        bpe = ByteBPE(path)
        for batch in batches:
            row = batch.column(0)
            texts = (x.as_py() or "" for x in batch.column(1))
            done, ids, text = 0, [], []

            def out():
                return pa.RecordBatch.from_arrays(
                    [row.slice(done, len(ids)), pa.array(ids, pa.list_(pa.int32())), pa.array(text, pa.string())], ["row", "ids", "text"]
                )

            size = 0
            for packed in bpe.encode_all(texts):
                ids.append(np.frombuffer(packed, "<i4"))
                text.append(bpe.decode(packed).decode())
                size += len(packed)
                if size > 1 << 24:
                    yield out()
                    done, ids, text, size = done + len(ids), [], [], 0
            yield out()

    return run


def _digested(path: str):
    def run(batches):
        bpe = ByteBPE(path)
        for batch in batches:
            n, ids, text = [], [], []
            for packed in bpe.encode_all(x.as_py() or "" for x in batch.column(1)):
                n.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest())
                text.append(hashlib.sha256(bpe.decode(packed)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())],
                ["row", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def encode(docs: DataFrame, path: str, row: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, ids (array of int), decoded (the text that the ids stand for).

    Null and empty texts have no ids and decode to ''. Special strings inside a text are their one id; nothing is
    added before or after, nothing cut. Rows that repeat are encoded each. Only `row` and `text` are read; `row`, of
    any type, comes out as doc_id. A table without rows gives none.
    """
    docs = docs.select(F.col(row).alias("row"), F.col(text).alias("text"))
    kind = docs.schema["row"].dataType.simpleString()
    done = docs.mapInArrow(_encoded(path), f"row {kind}, ids array<int>, text string")
    return done.select(F.col("row").alias("doc_id"), "ids", F.col("text").alias("decoded"))



def encode_digests(docs: DataFrame, path: str, row: str = "doc_id", text: str = "text") -> DataFrame:
    """The same as digests, which is all that leaves the worker: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    docs = docs.select(F.col(row).alias("row"), F.col(text).alias("text"))
    kind = docs.schema["row"].dataType.simpleString()
    done = docs.mapInArrow(_digested(path), f"row {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return done.withColumnRenamed("row", "doc_id")

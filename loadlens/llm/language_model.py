"""Scores by a hierarchical Pitman-Yor language model, its seating sampled by Gibbs.

Each context has a restaurant whose customers are the words that follow it; a table of a restaurant is a customer
of the parent, the restaurant of words without context; its tables draw on an even distribution. A context is
the word before, by the first 40 bits of its hash: there are as many restaurants as words, however large the corpus is.

The work is dealt out by the word that is scored. A bucket holds all customers that eat its words, in all
contexts, and its words' part of the parent. What buckets share is the customers and tables of each context: they
are added up by shards of contexts, and each bucket gets back the sums of the contexts that come in its lists.
Documents send their words, by chunk, to the buckets and get sums of logarithms back.

1. lists: documents -> per chunk and bucket the (word, context) pairs, training counts, and who has them.
2. counts: per bucket the training counts of all chunks, added up and stored, and its part of each context.
3. seating: customers enter, Gibbs sweeps that reseat every customer; the seating is stored, and the tables of
   each context are summed over buckets.
4. scores: sweeps go on from that seating and those totals, predictive probabilities are averaged over the last samples,
   lists are scored, and the sums of a chunk added up. Buckets with more than their share of lists are scored by
   several tasks, each with the same sampled model.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import pack, unpack
from .shared import stored
from .words import LOWER, blocks, mixed, words_in

CONTEXT_BITS = 40  # of a word's hash: of ten million words about 45 pairs share a context; lists are shorter than with 64
START = (1 << CONTEXT_BITS) - 1  # the context of a first word, among word hashes; sorts last
CONTEXTS = (1 << 13) + 1  # contexts of a small model, for tests; score_texts has no such number
END = 0x5EED0E4D  # stands for the end of a text among word hashes
CHUNK_BYTES = 6 << 20
BUCKET_BYTES = 12 << 20  # of text, whose words a bucket's share holds in memory
BUCKETS = (12, 4096)
STRENGTH = 1.0
SMALL = 64  # customers up to which the chance to sit alone is exact, and each is reseated by itself
ROUNDS = SMALL  # parts in which a sweep reseats the customers of a larger dish
BURN_IN = 12  # Gibbs sweeps before tables are reported, and again before samples
SAMPLES = 4
BETWEEN = 3  # sweeps from sample to sample
SCORE_BITS = 32  # binary places of the sums that a bucket sends back
SEED = 11


def held_out(doc_id) -> bool:
    """Whether a document is kept from training; a null id counts as ''."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


class Restaurant:
    """Discount d and strength; how likely a customer of a dish with c customers at t tables sits alone."""

    def __init__(self, d: float):
        self.d = d
        log = np.full((SMALL + 1, SMALL + 2), -np.inf)  # generalised Stirling numbers
        log[1, 1] = 0.0
        for c in range(2, SMALL + 1):
            t = np.arange(1, c + 1)
            with np.errstate(divide="ignore", invalid="ignore"):
                log[c, 1 : c + 1] = np.logaddexp(log[c - 1, t - 1], np.log(np.maximum(c - 1 - d * t, 1e-300)) + log[c - 1, t])
        # by c and t, in one line: whether a customer sits alone, and the weight of the tables that are there, for another
        alone, stay = np.zeros((SMALL + 1, SMALL + 2)), np.full((SMALL + 1, SMALL + 2), np.inf)
        for c in range(2, SMALL + 1):
            t = np.arange(1, c + 1)
            alone[c, 1 : c + 1] = np.exp(log[c - 1, t - 1] - log[c, t])
            stay[c, : c + 1] = c - 1 - d * np.arange(c + 1)
        self.alone, self.stay = alone.ravel(), stay.ravel()
        # saddle point of larger numbers: over the log of customers a table, the factor beside (t - 1) / (c - 1)
        u = -np.geomspace(1e-6, 700, 4096)
        self.factor = -d * np.expm1(u) / -np.expm1(d * u)
        self.log_size = np.log(self.factor) + (d - 1) * u

    def enter(self, c: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Tables when c customers of a dish have come; q: weight of a new table for each dish."""
        t, n = np.ones(len(c)), 1.0
        # as many have come to every dish that waits for more
        waits = np.flatnonzero(c > n)
        while len(waits):
            step = np.minimum(max(1.0, n / 4), c[waits] - n)
            t[waits] += step * q[waits] / (n - self.d * t[waits] + q[waits])
            n += max(1.0, n / 4)
            waits = waits[c[waits] > n]
        return np.clip(np.rint(t), 1, c)

    def leaving(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        """The odds that a customer of a dish with more than SMALL sits alone."""
        share = (t - 1) / (c - 1)
        share *= np.interp(-np.log(np.maximum(share, 1e-300)), self.log_size, self.factor)
        share = np.minimum(share, 1 - 1e-15)
        return share / (1 - share)

    def one_by_one(self, place: np.ndarray, q, rng: np.random.Generator) -> np.ndarray:
        """One customer of every dish leaves and sits down again: what its tables change by. place is where c and t are, and changes with t.

        The only table is never left, and of c tables one always is, so t stays between 1 and c.
        """
        left = rng.random(len(place)) < self.alone.take(place)
        place -= left
        stay = self.stay.take(place)
        stay += q
        stay *= rng.random(len(place))
        new = stay < q
        place += new
        return np.subtract(new, left, dtype=np.int8)

    def at_once(self, c: np.ndarray, t: np.ndarray, q, away: np.ndarray, m: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """m of more than SMALL customers of every dish leave and sit down again: its tables then. away: the odds that one sits alone."""
        left = np.minimum(_successes(m, away, rng), t - 1)
        new = _successes(m, q / (c - 1 - self.d * (t - left / m)), rng)
        return np.minimum(t - left + new, c)

    def step(self, c: np.ndarray, t: np.ndarray, q: np.ndarray, rng: np.random.Generator, m: np.ndarray | None = None) -> np.ndarray:
        """One customer of every dish, or m at once, leave and sit down again. Dishes of one customer stay as they are."""
        dishes = Dishes(self, c, t, 0 if m is None else len(c), rng)
        dishes.reseat(0, len(c), m, q)
        return dishes.tables()


def _place(c: np.ndarray, t: np.ndarray) -> np.ndarray:
    return c.astype(np.intp) * (SMALL + 2) + t.astype(np.intp)


def _successes(m: np.ndarray, odds: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Binomial draws: the first success by a geometric draw, and only where it is among the m trials those after it."""
    out, u = np.zeros(len(m)), rng.random(len(m))
    # m times the odds is above the chance of a success, so none is passed over
    at = (u < m * odds).nonzero()[0]
    odds = odds[at]
    left = m[at] - 1 - np.floor(np.log1p(-u[at]) / -np.log1p(odds))
    out[at[left >= 0]] = 1
    more = (left > 0).nonzero()[0]
    if len(more):
        odds = odds[more]
        out[at[more]] += rng.binomial(left[more].astype(np.int64), odds / (1 + odds))
    return out


class Dishes:
    """The tables of dishes while they are reseated: the first `large` ones by many customers at once, the others by one."""

    def __init__(self, restaurant: Restaurant, c: np.ndarray, t: np.ndarray, large: int, rng: np.random.Generator):
        self.restaurant, self.large, self.rng = restaurant, large, rng
        self.c, self.t = c[:large].astype(float), t[:large].astype(float)
        self.away = restaurant.leaving(self.c, self.t)  # only what moves is looked up again
        self.start = _place(c[large:], np.zeros(len(c) - large))
        self.place = self.start + t[large:].astype(np.intp)

    def reseat(self, first: int, end: int, m: np.ndarray | None, q) -> np.ndarray:
        """A round: what the tables of its dishes change by."""
        if m is None:
            return self.restaurant.one_by_one(self.place[first - self.large : end - self.large], q, self.rng)
        t = self.restaurant.at_once(self.c, self.t, q, self.away, m.astype(float), self.rng)
        by, self.t = t - self.t, t
        moved = (by != 0).nonzero()[0]
        self.away[moved] = self.restaurant.leaving(self.c[moved], t[moved])
        return by

    def tables(self) -> np.ndarray:
        return np.concatenate([self.t, self.place - self.start])


def in_rounds(c: np.ndarray) -> tuple[np.ndarray, list]:
    """A sweep over dishes of c customers: an order of the dishes, and of one round after another its range in that order
    and how many customers of each dish are reseated.

    Dishes of up to SMALL customers have a round for each, larger ones ROUNDS rounds with equal parts. None: one of each.
    """
    # bytes are sorted in one pass; large dishes need no order
    up = np.uint8(SMALL + 1) - np.minimum(c, SMALL + 1).astype(np.uint8)
    order = np.argsort(up, kind="stable")
    up, parts = up[order], []
    # dishes with more than so many customers come first
    above = lambda n: int(np.searchsorted(up, SMALL + 1 - n))
    large = above(SMALL)
    each, rest = np.divmod(c[order[:large]].astype(np.int64), ROUNDS)
    for k in range(1, ROUNDS + 1):
        if large:
            # the rest is spread evenly over the rounds
            more = np.arange(ROUNDS) * k // ROUNDS - np.arange(ROUNDS) * (k - 1) // ROUNDS
            parts.append((0, large, each + more[rest]))
        if k <= SMALL and (end := above(max(k, 2) - 1)) > large:
            parts.append((large, end, None))
    return order, parts


def _large(parts: list) -> int:
    return parts[0][1] if parts and parts[0][2] is not None else 0


def rounds(c: np.ndarray):
    """The same as (dishes, customers of each that are reseated)."""
    order, parts = in_rounds(c)
    for first, end, m in parts:
        yield order[first:end], m


class Seating:
    """The restaurants of one bucket. word: sorted keys; of, context, c: the pairs, ordered by word and context.

    A context is its place in the customers and tables of totals, which are sums over all buckets.
    """

    def __init__(self, counts, totals: dict, bucket: int, seat=None):
        """seat: the tables of the pairs and of the words in the parent, where sweeps have been before."""
        self.word, self.of, self.context, self.c = counts
        self.totals, self.rng = totals, np.random.default_rng([SEED, bucket, seat is not None])
        self.low, self.top = Restaurant(totals["d"]), Restaurant(totals["d_top"])
        self.even, self.rounds = 1.0 / (totals["words"] + 1), None
        n = len(self.word)
        # tables of a context over all buckets, and of the parent; what this bucket changes is added
        self.tables, self.top_tables = totals["tables"].astype(float), float(totals["top_tables"])
        self.all_tables = float(totals.get("all_tables", self.tables.sum()))  # also those of contexts that no list here has
        if seat is not None:
            self.t, self.top_t = (x.astype(float) for x in seat)
            self.customers = np.bincount(self.of, self.t, n)
            return
        first = np.bincount(self.of, minlength=n).astype(float)
        self.customers, self.top_t = first, np.ones(n)
        p = self.parent()
        self.t = self.low.enter(self.c.astype(float), self.new_weight(p))
        if "first" in totals:  # the totals count one table a pair; those of this bucket are seated now
            self.tables = self.tables + np.bincount(self.context, self.t - 1, len(self.tables))
            self.all_tables += float((self.t - 1).sum())
        self.customers = np.bincount(self.of, self.t, n)
        self.top_t = self.top.enter(self.customers, np.full(n, self.top_weight()))
        if "first" in totals:
            self.top_tables += float((self.top_t - 1).sum())

    def top_weight(self) -> float:
        return (STRENGTH + self.top.d * self.top_tables) * self.even

    def parent(self) -> np.ndarray:
        """The probability of each word without context."""
        return (self.served(slice(None)) + self.top_weight()) / (STRENGTH + self.all_tables)

    def served(self, words) -> np.ndarray:
        """The weight of the tables of words in the parent."""
        customers = self.customers[words]
        return customers - self.top.d * np.minimum(self.top_t[words], customers)

    def unknown(self) -> float:
        return self.top_weight() / (STRENGTH + self.all_tables)

    def new_weight(self, p: np.ndarray) -> np.ndarray:
        return (STRENGTH + self.low.d * self.tables[self.context]) * p[self.of]

    def sweep(self, times: int) -> None:
        """Every customer leaves and sits down again; a round sees what the rounds before it have changed."""
        if self.rounds is None:
            order, parts = in_rounds(self.c)
            # in this order the dishes of a round lie side by side
            seated = order[: max((end for _, end, _ in parts), default=0)]
            self.rounds = seated, parts, self.of[seated], self.context[seated]
        seated, parts, of, context = self.rounds
        dishes = Dishes(self.low, self.c[seated], self.t[seated], _large(parts), self.rng)
        weight = STRENGTH + self.low.d * self.tables
        for _ in range(times):
            # both are kept up to date where something moves
            served = self.served(slice(None))
            for first, end, m in parts:
                w, x = of[first:end], context[first:end]
                q = served.take(w)
                q += self.top_weight()
                q *= weight.take(x)
                q /= STRENGTH + self.all_tables
                by = dishes.reseat(first, end, m, q)
                moved = (by != 0).nonzero()[0]
                w, x, by = w[moved], x[moved], by[moved].astype(float)
                np.add.at(self.tables, x, by)
                np.add.at(self.customers, w, by)
                self.all_tables += float(by.sum())
                weight[x] = STRENGTH + self.low.d * self.tables[x]
                served[w] = self.served(w)
            top = np.minimum(self.top_t, self.customers)
            self.top_tables += float((top - self.top_t).sum())
            order, top_parts = in_rounds(self.customers)
            top_dishes = Dishes(self.top, self.customers[order], top[order], _large(top_parts), self.rng)
            for part in top_parts:
                self.top_tables += float(top_dishes.reseat(*part, self.top_weight()).sum())
            self.top_t[order] = top_dishes.tables()
        self.t[seated] = dishes.tables()

    def sample(self) -> dict:
        back = (STRENGTH + self.low.d * self.tables) / (STRENGTH + self.totals["customers"])
        p = self.parent()
        seen = (self.c - self.low.d * self.t) / (STRENGTH + self.totals["customers"][self.context]) + back[self.context] * p[self.of]
        return {"back": back, "parent": p, "seen": seen, "unknown": self.unknown()}


class Sorted:
    """Different keys in order, found like np.searchsorted, but from a table: the first bits of hashes nearly tell their place."""

    def __init__(self, keys: np.ndarray, bits: int):
        self.shift = np.uint64(max(bits - len(keys).bit_length() - 1, 0))
        self.keys = np.append(keys, np.uint64((1 << 64) - 1))
        size = np.bincount((keys >> self.shift).astype(np.intp), minlength=(1 << bits >> int(self.shift)))
        self.start = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.start.take((keys >> self.shift).astype(np.intp))
        behind = (self.keys.take(at) < keys).nonzero()[0]
        for _ in range(16):
            if not len(behind):
                break
            at[behind] += 1
            behind = behind[self.keys[at[behind]] < keys[behind]]
        # keys that crowd together
        at[behind] = np.searchsorted(self.keys[:-1], keys[behind])
        return at


def _once(ordered: np.ndarray) -> np.ndarray:
    return ordered[np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)]]


def _different(keys: np.ndarray, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """np.unique of hashes with the inverse; numbers are sorted several times faster than their places."""
    ordered = _once(np.sort(keys))
    return ordered, Sorted(ordered, bits)(keys)


def _lists(buckets: int, training: bool):
    """The lists, with training counts and without holders, or without counts and with holders; size: how many they are."""

    def run(batches):
        from pyspark import TaskContext

        part, chunk = TaskContext.get().partitionId(), 0
        names = ["chunk", "bucket", "ids", "pairs", "holders", "size"]
        types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64()]
        row = lambda *v: pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(v, types)], names)

        def out(ids, keys, docs):
            nonlocal chunk
            number = (part << 32) + chunk
            chunk += 1
            if not training:
                yield row(number, number % buckets, ids, None, None, None)
            key, doc = np.concatenate(keys), np.concatenate(docs)
            word, which = _different(key)
            # the context is the word before in the same text
            before = np.append(word >> np.uint64(64 - CONTEXT_BITS), np.uint64(START))
            context = np.append(len(word), which[:-1])
            context[1:][doc[1:] != doc[:-1]] = len(word)
            place = (mixed(word) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            word, place = word[order], place[order]
            pair, pairs = rank[which] * len(before) + context, None
            if len(word) * len(before) * len(ids) >= 1 << 62:
                pairs, pair = np.unique(pair, return_inverse=True)
            code, n = np.unique(pair * len(ids) + doc, return_counts=True)
            pair, doc = code // len(ids), code % len(ids)
            new = np.concatenate(([True], pair[1:] != pair[:-1]))
            first = np.flatnonzero(new)
            of_pair = np.cumsum(new) - 1
            holders = np.diff(np.append(first, len(pair)))
            if training:
                counts = np.bincount(of_pair, n * np.array([not held_out(i) for i in ids])[doc]).astype(np.int64)
            pair = pair[first] if pairs is None else pairs[pair[first]]
            pair_word, context = pair // len(before), pair % len(before)
            word_cut = np.searchsorted(place, np.arange(buckets + 1))
            pair_cut = np.searchsorted(pair_word, word_cut)
            cut = np.append(first, len(doc))[pair_cut]
            place_of = np.zeros(len(before), np.int64)
            for b in range(buckets):
                w, p, h = (slice(x[b], x[b + 1]) for x in (word_cut, pair_cut, cut))
                if w.start == w.stop:
                    continue
                each = np.bincount(pair_word[p] - w.start, minlength=w.stop - w.start)
                own = _once(np.sort(context[p]))
                place_of[own] = np.arange(len(own))
                at = place_of[context[p]]
                pairs_here = pack(_steps(word[w]), each, _steps(before[own]), at, *([counts[p]] if training else []))
                yield row(number, b, None, pairs_here, None if training else pack(holders[p], doc[h], n[h]), h.stop - h.start)

        ids, keys, docs, size = [], [], [], 0
        for batch in batches:
            all_ids = batch.column(0).to_pylist()
            for block in blocks(batch.column(1)):
                words = words_in(block, LOWER[block.data])
                # every text gets an end after its words
                key = np.insert(words.key, words.docs[1:], np.uint64(END))
                doc = np.insert(words.doc, words.docs[1:], np.arange(block.n))
                keys.append(key)
                docs.append(doc + len(ids))
                ids += all_ids[block.first : block.first + block.n]
                size += len(block.data) + 64 * block.n
                if size >= CHUNK_BYTES:
                    yield from out(ids, keys, docs)
                    ids, keys, docs, size = [], [], [], 0
        if ids:
            yield from out(ids, keys, docs)

    return run


def _planes(x: np.ndarray) -> np.ndarray:
    """64-bit numbers as bytes, the lowest of all first: the highest are mostly 0."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8).T.ravel()


def _from_planes(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.astype(np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _steps(keys: np.ndarray) -> np.ndarray:
    """Sorted 64-bit keys as the bytes of their differences."""
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def _keys(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(_from_planes(steps), dtype=np.uint64)


def _pairs(packed: bytes):
    """A list: sorted words, the word of each pair, sorted contexts, the context of each pair, its training count if any."""
    word, each, before, context, *n = unpack(packed)
    return _keys(word), np.repeat(np.arange(len(each)), each), _keys(before), context, *n


def _packed_sums(tokens, known, base, score) -> bytes:
    """Sums of a list by document. Logarithms have SCORE_BITS binary places, fewer where they would not fit."""
    logs = np.concatenate([base, score])
    bits = min(SCORE_BITS, 61 - int(np.ceil(np.log2(np.abs(logs).max(initial=1.0)))))
    fixed = np.rint(np.ldexp(logs, bits)).astype(np.int64)
    tokens, known = (np.rint(x).astype(np.int64) for x in (tokens, known))
    return pack(np.array([bits]), tokens, tokens - known, _planes(((fixed << 1) ^ (fixed >> 63)).view(np.uint64)))


def _unpacked_sums(packed: bytes) -> np.ndarray:
    bits, tokens, unknown, logs = unpack(packed)
    logs = _from_planes(logs)
    logs = np.ldexp((logs >> np.uint64(1)).astype(np.int64) ^ -(logs & np.uint64(1)).astype(np.int64), -int(bits[0]))
    return np.concatenate([tokens, tokens - unknown, logs]).reshape(4, -1)


def _added(parts):
    """Pairs of several chunks with words and contexts sorted, pairs in order, counts added."""
    word, which = _different(np.concatenate([w for w, *_ in parts]))
    before, at = _different(np.concatenate([x for _, _, x, _, _ in parts]), CONTEXT_BITS)
    i, j, codes = 0, 0, []
    for w, of, own, context, _ in parts:
        codes.append(which[i : i + len(w)][of] * len(before) + at[j : j + len(own)][context])
        i, j = i + len(w), j + len(own)
    code, n = _summed(np.concatenate(codes), np.concatenate([n for *_, n in parts]))
    return word, code // max(len(before), 1), before, code % max(len(before), 1), n


def _summed(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different codes in order, and the numbers of each added up."""
    bits = int(n.max(initial=0)).bit_length()
    if not len(code) or int(code.max()) >= 1 << (63 - bits):
        code, where = np.unique(code, return_inverse=True)
        return code, np.bincount(where, n).astype(np.int64)
    # in one number both are sorted at once
    both = np.sort(code << bits | n)
    code, n = both >> bits, both & ((1 << bits) - 1)
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    return code[first], np.add.reduceat(n, first)


def _counts(shards: int):
    """(bucket, pairs, size) in order of buckets -> (bucket, model, what each shard gets of its contexts, statistics, size).

    A shard gets all contexts of the bucket's lists, trained or not, with their pairs here; shards are even ranges of
    contexts. The size is that of all lists.
    """

    def out(bucket, parts, size):
        word, of, before, context, c = _added(parts)
        pairs = np.bincount(context, minlength=len(before))
        cut = np.searchsorted((before >> np.uint64(CONTEXT_BITS - 32)) * np.uint64(shards) >> np.uint64(32), np.arange(shards + 1).astype(np.uint64))
        sent = [pack(_steps(before[a:b]), pairs[a:b]) if a < b else None for a, b in zip(cut[:-1], cut[1:])]
        spread = np.bincount(of, minlength=len(word))
        stats = [
            len(word), int((c == 1).sum()), int((c == 2).sum()), int((spread == 1).sum()), int((spread == 2).sum()), int(c.sum()), len(c)
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int32()), pa.array([pack(_steps(word), spread, context, c)], pa.binary()),
             pa.array([sent], pa.list_(pa.binary())), pa.array([stats], pa.list_(pa.int64())), pa.array([size], pa.int64())],
            ["bucket", "model", "parts", "stats", "size"],
        )

    def trained(packed):
        word, of, before, context, n = _pairs(packed)
        keep = n > 0
        have = np.bincount(of[keep], minlength=len(word)) > 0
        return word[have], (np.cumsum(have) - 1)[of[keep]], before, context[keep], n[keep]

    def run(batches):
        bucket, parts, size = None, [], 0
        for batch in batches:
            for b, packed, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if b != bucket and bucket is not None:
                    yield out(bucket, parts, size)
                    parts, size = [], 0
                bucket, size = b, size + n
                parts.append(trained(packed))
                if len(parts) == 16:
                    parts = [_added(parts)]
        if bucket is not None:
            yield out(bucket, parts, size)

    return run


def _model(packed: bytes):
    word, each, context, c = unpack(packed)
    return _keys(word), np.repeat(np.arange(len(each)), each), context, c


def _places(table: pa.Table) -> pa.Table:
    """The contexts that buckets have of a shard -> for each bucket their places in the shard, as steps, and their pairs in all buckets."""
    parts = [unpack(x) for x in table.column("part").to_pylist()]
    contexts, at = np.unique(np.concatenate([_keys(steps) for steps, _ in parts]), return_inverse=True)
    pairs = np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)
    out, i = [], 0
    for _, n in parts:
        own = at[i : i + len(n)]
        out.append(pack(np.diff(own, prepend=0), pairs[own]))
        i += len(own)
    return table.select(["bucket", "shard"]).append_column("share", pa.array(out, pa.binary()))


def _shared(table: pa.Table) -> pa.Table:
    """(places, customers, tables) of a shard's contexts in each bucket -> for each bucket their customers and tables in all."""
    parts = [unpack(x) for x in table.column("part").to_pylist()]
    at = [np.cumsum(steps) for steps, *_ in parts]
    customers, tables = (np.bincount(np.concatenate(at), np.concatenate([p[i] for p in parts])).astype(np.int64) for i in (1, 2))
    out = [pack(customers[x], tables[x]) for x in at]
    return table.select(["bucket", "shard"]).append_column("share", pa.array(out, pa.binary()))


def _joined_up(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *parts])


def _tables(totals: dict):
    """Rows of a bucket: its model, then its places and pairs by shard -> its seating, what it brings the contexts of each shard,
    and the tables of its part of the parent and of its pairs."""

    def out(bucket, model, shares):
        parts = [unpack(x) for _, x in shares]
        n = [len(pairs) for _, pairs in parts]
        # customers of a context do not count for its seating
        seating = Seating(_model(model), totals | {"tables": _joined_up([pairs for _, pairs in parts])}, bucket)
        seating.sweep(BURN_IN)
        sums = [np.bincount(seating.context, x, sum(n)).astype(np.int64) for x in (seating.c, seating.t)]
        cut, sent = np.concatenate(([0], np.cumsum(n, dtype=np.int64))), []
        for i, (steps, _) in enumerate(parts):
            sent.append({"shard": shares[i][0], "part": pack(steps, *(x[cut[i] : cut[i + 1]] for x in sums))})
        seat = pack(seating.t.astype(np.int64), seating.top_t.astype(np.int64))
        kind = pa.list_(pa.struct([("shard", pa.int32()), ("part", pa.binary())]))
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int32()), pa.array([seat], pa.binary()), pa.array([sent], kind),
             pa.array([[int(seating.top_t.sum()), int(seating.t.sum())]], pa.list_(pa.int64()))],
            ["bucket", "seat", "parts", "stats"],
        )

    def run(batches):
        own, shares = None, []
        for batch in batches:
            for b, shard, model, share in zip(*(batch.column(c).to_pylist() for c in ("bucket", "shard", "model", "share"))):
                if model is None:
                    shares.append((shard, share))
                    continue
                if own is not None:
                    yield out(*own, shares)
                own, shares = (b, model), []
        if own is not None:
            yield out(*own, shares)

    return run


def _scores(totals: dict):
    """Rows of a bucket, its model first, then its contexts -> per chunk the sums that its documents get from the bucket."""

    def run(batches):
        own, shares, samples, seen_mean = None, [], [], 0.0
        n_all, even = totals["tokens"], 0.1 * (totals["words"] + 1)
        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("bucket", "model", "parts", "seat", "share", "pairs", "holders"))
            for b, model, parts, seat, share, pairs, holders in zip(*columns):
                if model is not None:
                    own, shares, samples, seen_mean = (b, model, parts, seat), [], [], 0.0
                elif share is not None:
                    shares.append(share)
                if pairs is None:
                    done.append(None)
                    continue
                if not samples:
                    before = np.concatenate([np.zeros(0, np.uint64), *(_keys(unpack(x)[0]) for x in own[2] if x is not None)])
                    sums = [unpack(x) for x in shares]
                    sums = {k: _joined_up([x[i] for x in sums]) for i, k in enumerate(("customers", "tables"))}
                    seating = Seating(_model(own[1]), totals | sums, own[0], unpack(own[3]))
                    seating.sweep(BURN_IN)
                    for _ in range(SAMPLES):
                        seating.sweep(BETWEEN)
                        samples.append(seating.sample())
                        seen_mean = seen_mean + samples[-1].pop("seen") / SAMPLES
                    known = np.bincount(seating.of, seating.c, len(seating.word))
                    codes = seating.of * len(before) + seating.context
                    find_word, find_before = Sorted(seating.word, 64), Sorted(before, CONTEXT_BITS)
                word, of, mine, context = _pairs(pairs)
                context = find_before(mine)[context]
                at = find_word(word)
                at[at == len(seating.word)] = 0
                hit = seating.word[at] == word if len(seating.word) else np.zeros(len(word), bool)
                c = np.where(hit, known[at], 0) if len(known) else np.zeros(len(word))
                code = at[of] * len(before) + context
                place = np.searchsorted(codes, code)
                place[place == len(codes)] = 0
                seen = hit[of] & (codes[place] == code) if len(codes) else np.zeros(len(of), bool)
                p, other = np.zeros(len(of)), np.flatnonzero(~seen)
                p[seen] = seen_mean[place[seen]] if len(codes) else 0
                for s in samples:
                    parent = np.where(hit, s["parent"][at], s["unknown"]) if len(known) else np.full(len(word), s["unknown"])
                    p[other] += s["back"][context[other]] * parent[of[other]] / SAMPLES
                score = np.log10(p)
                base = np.log10((c + 0.1) / (n_all + even))[of]
                each, doc, n = unpack(holders)
                pair = np.repeat(np.arange(len(of)), each)
                done.append(_packed_sums(*[np.bincount(doc, x) for x in (n, n * (c > 0)[of][pair], n * base[pair], n * score[pair])]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("chunk"), batch.column("bucket"), batch.column("ids"), pa.array(done, pa.binary())], ["chunk", "bucket", "ids", "sums"]
            ).filter(pa.array([c is not None for c in batch.column("chunk").to_pylist()]))

    return run


def _joined(total_tokens: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("bucket")
        ids = next(x for x in table.column("ids") if x.is_valid).values
        sums = np.zeros((4, len(ids)))
        for part in table.column("sums").to_pylist():
            if part is not None:
                part = _unpacked_sums(part)
                sums[:, : part.shape[1]] += part
        counts = np.rint(sums[:2]).astype(np.int64)
        return pa.table({
            "doc_id": ids, "held_out": pa.array([held_out(i) for i in ids.to_pylist()], pa.bool_()),
            "n_tokens": counts[0], "n_known": counts[1],
            "train_tokens": np.full(len(ids), total_tokens), "base_score": sums[2], "score": sums[3],
        })

    return run


def _discount(one: int, two: int) -> float:
    return float(np.clip(one / max(one + 2 * two, 1), 0.05, 0.95))


def _sums(df: DataFrame, column: str) -> list[int]:
    """The sum of an array column over all rows, place by place: a few numbers."""
    rows = df.select(F.posexplode(column).alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n")).orderBy("i").collect()
    return [r.n for r in rows]


def score_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the lower-cased words of the text and one end; null and empty texts are an end only. Documents whose
    crc32(doc_id as text) is divisible by 10 are held out of training; a null id counts as ''. Rows that repeat
    count each time. score is the log10 probability of all tokens, averaged over samples before the logarithm; a
    word not in training has the even part of the parent. The same texts give the same scores up to rounding, in any
    partitions. Other columns are not read. A table without rows gives none. docs must give the same rows in
    the same order when a task is repeated, as tables do.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = min(max(-(-size // BUCKET_BYTES), BUCKETS[0]), BUCKETS[1])
    # made twice, for counts and for scores, since they take more room than the texts
    lists = lambda training: docs.mapInArrow(
        _lists(buckets, training), "chunk long, bucket int, ids array<long>, pairs binary, holders binary, size long"
    )
    counts = lists(True).select("bucket", "pairs", "size").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    counts = stored(
        counts.mapInArrow(_counts(buckets), "bucket int, model binary, parts array<binary>, stats array<long>, size long"), "counts",
        release=True,
    )
    words, one, two, one_top, two_top, tokens, pairs = _sums(counts, "stats") or [0] * 7
    totals = {
        "tokens": tokens, "words": words, "all_tables": pairs, "top_tables": words,
        "d": _discount(one, two), "d_top": _discount(one_top, two_top),
    }
    null = lambda kind, name: F.lit(None).cast(kind).alias(name)
    by_shard = lambda df, f: df.groupBy("shard").applyInArrow(f, "bucket int, shard int, share binary")
    places = by_shard(counts.select("bucket", F.posexplode("parts").alias("shard", "part")).filter("part IS NOT NULL"), _places)
    rows = counts.select("bucket", null("int", "shard"), "model", null("binary", "share")).unionByName(
        places.select("bucket", "shard", null("binary", "model"), "share")
    )
    rows = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", F.col("shard").asc_nulls_first())
    seated = stored(
        rows.mapInArrow(
            _tables(totals | {"first": True}), "bucket int, seat binary, parts array<struct<shard:int,part:binary>>, stats array<long>"
        ),
        "tables",
        release=True,
    )
    totals["top_tables"], totals["all_tables"] = _sums(seated, "stats") or [0, 0]
    contexts = stored(by_shard(seated.select("bucket", F.inline("parts")), _shared), "contexts", release=True)
    # a bucket with more than its share of lists is scored by several tasks
    sizes = {r.bucket: r["size"] for r in counts.select("bucket", "size").collect()}
    mean = max(sum(n or 0 for n in sizes.values()) / max(len(sizes), 1), 1)
    split = [max(1, round((sizes.get(b) or 0) / mean)) for b in range(buckets)]
    copies = F.get(F.array(*[F.lit(n) for n in split]), F.col("bucket"))
    columns = {
        "chunk": "long", "bucket": "int", "ids": "array<long>", "shard": "int", "model": "binary", "parts": "array<binary>", "seat": "binary",
        "share": "binary", "pairs": "binary", "holders": "binary", "copy": "int",
    }
    row = lambda df: df.select(*[F.col(c) if c in df.columns else null(kind, c) for c, kind in columns.items()])
    every = F.explode(F.sequence(F.lit(0), copies - 1))
    models = counts.select("bucket", "model", "parts").join(seated.select("bucket", "seat"), "bucket").withColumn("copy", every)
    texts = lists(False).withColumn("copy", F.pmod(F.xxhash64("chunk"), copies).cast("int"))
    rows = row(models).unionByName(row(contexts.withColumn("copy", every))).unionByName(row(texts))
    # the model, then its contexts in order, then lists
    dealt = rows.repartition(buckets, "bucket", "copy").sortWithinPartitions(
        "bucket", "copy", F.col("model").isNull(), F.col("shard").asc_nulls_last()
    )
    sums = dealt.mapInArrow(_scores(totals), "chunk long, bucket int, ids array<long>, sums binary")
    return sums.groupBy("chunk").applyInArrow(
        _joined(totals["tokens"]),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )

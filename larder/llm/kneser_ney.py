"""Text quality by the perplexity of an interpolated modified Kneser-Ney bigram model.

The model is counted over trusted text and judges every document. Its sum of
log-probabilities is rearranged so that it falls into three lookups that add up:

    log p(w|v) = log g(v) + log p(w) + d(v, w)

with g(v) the weight that context v leaves to the lower order, p(w) the
interpolated continuation probability, and d(v, w) what a pair seen in training
adds; d is 0 for all other pairs, as is log g for words that no pair begins with.
Words are known by 64 bits of hash, so the vocabulary grows with the corpus. The
most frequent words, a fixed number, are looked up exactly in arrays that travel
with the job; the tables of all other words and of the pairs live in shards.
Documents send their pairs and their rare words to the shards in packed, sorted
arrays and get sums back. Pairs that are the most frequent of their shard, a
fixed number, travel with the job too, which also keeps them from crowding a
shard.
"""

from __future__ import annotations

import copy
import math
import pickle
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import Stages, text_bytes

BITS = 17  # of the number of a frequent word; number 0 begins a text
WORDS = 1 << 20  # words that the uniform distribution below all others allows for, unless more are seen
SIEVE = 26  # bits of the places of a table that tells what was never seen
PAIR = np.uint64((1 << 2 * BITS) - 1)
SCATTER = np.uint64(0x9E3779B97F4A7C15 & ((1 << 2 * BITS) - 1) | 1)


def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays, byte planes apart, so that small numbers compress."""
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() for a in arrays]
    return zlib.compress(pickle.dumps([(len(a), a.dtype.str, p) for a, p in zip(arrays, planes, strict=True)]), 1)


def unpack(blob: bytes) -> list[np.ndarray]:
    out = []
    for n, kind, planes in pickle.loads(zlib.decompress(blob)):
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T).view(kind).reshape(n))
    return out


def gaps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x.dtype.type(0))


class Words:
    """Hashes of words, remembered for a while; 0 is left for the beginning of a text."""

    def __init__(self, most: int = 300_000):
        self.most, self.known = most, {}

    def of(self, text: str) -> np.ndarray:
        import xxhash

        words = text.split()
        if len(self.known) > self.most:
            self.known.clear()
        for w in {w for w in words if w not in self.known}:
            self.known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) or 1
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))


def scattered(pairs: np.ndarray) -> np.ndarray:
    """A one-to-one shuffle of pair numbers, so that ranges of it hold about equally many."""
    return pairs * SCATTER & PAIR


UNSCATTER = np.uint64(pow(int(SCATTER), -1, 1 << 2 * BITS))


def pair_keys(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of pairs of word hashes, in their order."""
    x = v * np.uint64(0x9E3779B97F4A7C15) + w
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def by_shard(keys: np.ndarray, shards: int, bits: int = 2 * BITS) -> np.ndarray:
    """Where each shard begins in sorted keys of so many bits, and the end of the last."""
    edges = (np.arange(shards, dtype=object) * (1 << bits) // shards).tolist()
    return np.r_[np.searchsorted(keys, np.array(edges, np.uint64)), len(keys)]


def sieve_slice(keys: np.ndarray, part: int, parts: int, bits: int = 2 * BITS) -> bytes:
    """The part of a bit table that the keys of one of ``parts`` ranges set, by their leading bits."""
    low, high = ((k << SIEVE) // parts for k in (part, part + 1))
    marks = np.zeros(high - low + 1, bool)
    marks[(keys >> np.uint64(bits - SIEVE)).astype(np.int64) - low] = True
    return pack(np.array([low, len(marks)]), np.packbits(marks))


def sieve_of(slices: Sequence[bytes]) -> np.ndarray:
    table = np.zeros((1 << SIEVE) + 8, bool)
    for (low, size), marks in map(unpack, slices):
        table[low:low + size] |= np.unpackbits(marks, count=size).astype(bool)
    return np.packbits(table)


def may_hold(table: np.ndarray, keys: np.ndarray, bits: int = 2 * BITS) -> np.ndarray:
    """False for keys that were certainly never seen."""
    at = (keys >> np.uint64(bits - SIEVE)).astype(np.int64)
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def looked_up(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each wanted key in sorted keys, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def summed(keys: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    """Distinct keys in order, and the sums of their columns."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return [keys[first], *(np.add.reduceat(c[order], first) if len(first) else c for c in columns)]


# --- training -------------------------------------------------------------------


def frequent_words(texts: DataFrame, spans: int, most: int, tokens_at_once: int) -> np.ndarray:
    """Sorted hashes of the most frequent words of each range of hashes, ``most`` in all, and the 0 that begins a text."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()

        def flush(held: list[np.ndarray]) -> pd.DataFrame:
            seen, n = np.unique(np.concatenate(held), return_counts=True)
            cut = by_shard(seen, spans, 64)
            blobs = [pack(gaps(seen[a:b]), n[a:b].astype(np.uint32)) for a, b in zip(cut, cut[1:], strict=False)]
            return pd.DataFrame({"part": np.arange(spans, dtype=np.int32), "blob": blobs})

        held, size = [], 0
        for batch in batches:
            for t in batch["text"]:
                held.append(words.of(t or ""))
                size += len(held[-1])
                if size >= tokens_at_once:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    def pick(group: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack(b) for b in group["blob"]]
        seen, n = summed(np.concatenate([np.cumsum(k) for k, _ in parts]), np.concatenate([c for _, c in parts]).astype(np.int64))
        top = np.argsort(-n, kind="stable")[:most // spans]
        return pd.DataFrame({"blob": [pack(seen[top])]})

    picked = texts.mapInPandas(count, "part int, blob binary").groupBy("part").applyInPandas(pick, "blob binary")
    return np.sort(np.concatenate([np.zeros(1, np.uint64), *(unpack(bytes(r[0]))[0] for r in picked.toLocalIterator())]))


def count_pairs(texts: DataFrame, top: np.ndarray, shards: int, tokens_at_once: int) -> DataFrame:
    """Pair counts of batches, packed per shard: (shard, blob). ``texts`` has one column, text.

    Pairs of frequent words (``top``) are coded by their numbers, others by their hashes.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()

        def flush(held: list[np.ndarray]) -> pd.DataFrame:
            w = np.concatenate(held)
            v = np.concatenate([np.r_[np.uint64(0), x[:-1]] for x in held])
            (left, has_left), (right, has_right) = looked_up(top, v), looked_up(top, w)
            near = has_left & has_right
            pairs, n = np.unique(scattered((left[near].astype(np.uint64) << np.uint64(BITS)) | right[near].astype(np.uint64)), return_counts=True)
            v, w = v[~near], w[~near]
            far, first, m = np.unique(pair_keys(v, w), return_index=True, return_counts=True)
            v, w = v[first], w[first]
            cut, far_cut = by_shard(pairs, shards), by_shard(far, shards, 64)
            blobs = [pack(gaps(pairs[a:b]), n[a:b].astype(np.uint32), v[c:d], w[c:d], m[c:d].astype(np.uint32))
                     for a, b, c, d in zip(cut, cut[1:], far_cut, far_cut[1:], strict=False)]
            return pd.DataFrame({"shard": np.arange(shards, dtype=np.int32), "blob": blobs})

        held, size = [], 0
        for batch in batches:
            for t in batch["text"]:
                ids = words.of(t or "")
                if len(ids):
                    held.append(ids)
                    size += len(ids)
                if size >= tokens_at_once:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return texts.mapInPandas(run, "shard int, blob binary")


def merge_counts(packed: DataFrame, top: np.ndarray, shards: int, ranges: int, spans: int, hot: int) -> DataFrame:
    """Counts of each shard's pairs, and what its contexts and words need: (kind, part, origin, blob).

    kind "pairs": the shard's pairs of frequent words and counts, then its other
    pairs (hashes of both words) and counts; "words": for a range of frequent
    words, continuations of contexts by count and predecessors of words; "rare":
    the same for a span of hashes of the other words, from the shard ``origin``;
    "sizes": how many pairs have count 1, 2, 3, 4; "hot": the most frequent pairs;
    "near", "far": bits of the shard's pairs of either kind.
    """
    span = (1 << BITS) // ranges

    def run(group: pd.DataFrame) -> pd.DataFrame:
        shard = int(group["shard"].iloc[0])
        parts = [unpack(b) for b in group["blob"]]
        pairs, n = summed(np.concatenate([np.cumsum(x[0]) for x in parts]), np.concatenate([x[1] for x in parts]).astype(np.int64))
        v, w, m = (np.concatenate([x[k] for x in parts]) for k in (2, 3, 4))
        far = pair_keys(v, w)
        first = np.unique(far, return_index=True)[1]
        m = summed(far, m.astype(np.int64))[1]
        v, w = v[first], w[first]
        out = [("pairs", shard, shard, pack(gaps(pairs), n, v, w, m)),
               ("near", shard, shard, sieve_slice(pairs, shard, shards)),
               ("far", shard, shard, sieve_slice(pair_keys(v, w), shard, shards, 64))]
        plain = pairs * UNSCATTER & PAIR
        left, right = (plain >> np.uint64(BITS)).astype(np.int64), (plain & np.uint64((1 << BITS) - 1)).astype(np.int64)
        (v_at, v_top), (w_at, w_top) = looked_up(top, v), looked_up(top, w)
        left, right, of_left = np.r_[left, v_at[v_top]], np.r_[right, w_at[w_top]], np.r_[n, m[v_top]]
        for side, kinds in ((left, np.minimum(of_left, 3)), (right, np.full(len(right), 4))):
            slot = side * 8 + kinds
            for weights in (None, of_left) if side is left else (None,):
                key, where = np.unique(slot if weights is None else side * 8 + 5, return_inverse=True)
                total = np.bincount(where, weights=weights, minlength=len(key)).astype(np.int64)
                cut = np.searchsorted(key, np.arange(ranges + 1) * span * 8)
                out += [("words", r, shard, pack(gaps(key[a:b]), total[a:b])) for r, (a, b) in enumerate(zip(cut, cut[1:], strict=False)) if b > a]
        v, of_v, w = v[~v_top], m[~v_top], w[~w_top]
        none, one = np.zeros(len(w), np.int64), np.ones(len(w), np.int64)
        rare, *stats = summed(np.r_[v, w], *(np.r_[x.astype(np.int64), none] for x in (of_v == 1, of_v == 2, of_v > 2, of_v)),
                              np.r_[np.zeros(len(v), np.int64), one])
        cut = by_shard(rare, spans, 64)
        out += [("rare", r, shard, pack(gaps(rare[a:b]), *(x[a:b] for x in stats))) for r, (a, b) in enumerate(zip(cut, cut[1:], strict=False)) if b > a]
        out.append(("sizes", shard, shard, pack(np.bincount(np.minimum(np.r_[n, m], 5), minlength=6)[1:5].astype(np.int64))))
        best = np.sort(np.argsort(-n, kind="stable")[:hot])
        out.append(("hot", shard, shard, pack(pairs[best], n[best])))
        return pd.DataFrame(out, columns=["kind", "part", "origin", "blob"])

    return packed.groupBy("shard").applyInPandas(run, "kind string, part int, origin int, blob binary")


def word_tables(parts: DataFrame) -> DataFrame:
    """Sums of the "words" parts of a range: one row (part, blob) each."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        keys, totals = zip(*(unpack(b) for b in group["blob"]), strict=True)
        keys = [np.cumsum(k) for k in keys]
        low = min(int(k[0]) for k in keys) // 8 * 8
        size = max(int(k[-1]) for k in keys) - low + 1
        dense = np.zeros(size, np.int64)
        for k, t in zip(keys, totals, strict=True):
            dense[k - low] += t
        at = np.flatnonzero(dense)
        return pd.DataFrame([(int(group["part"].iloc[0]), pack(at + low, dense[at]))], columns=["part", "blob"])

    return parts.groupBy("part").applyInPandas(run, "part int, blob binary")


def rare_tables(parts: DataFrame, shards: int, spans: int) -> DataFrame:
    """Sums of the "rare" parts of a span of hashes: (kind, part, blob).

    kind "back": sums for the words of one shard's pairs; "facts": for the words
    whose own hash belongs to a shard; "seen": words by number of predecessors
    (0 to 4, 5 or more), and all predecessors; "known": bits of the span's words.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        span, sent = int(group["part"].iloc[0]), [unpack(b) for b in group["blob"]]
        asked = [np.cumsum(x[0]) for x in sent]
        words, *stats = summed(np.concatenate(asked), *(np.concatenate([x[k] for x in sent]) for k in range(1, 6)))
        out = []
        for origin, own in zip(group["origin"], asked, strict=True):
            at = np.searchsorted(words, own)
            out.append(("back", int(origin), pack(gaps(own), *(x[at] for x in stats))))
        cut = by_shard(words, shards, 64)
        out += [("facts", s, pack(gaps(words[a:b]), *(x[a:b] for x in stats))) for s, (a, b) in enumerate(zip(cut, cut[1:], strict=False)) if b > a]
        out.append(("known", span, sieve_slice(words, span, spans, 64)))
        out.append(("seen", span, pack(np.r_[np.bincount(np.minimum(stats[4], 5), minlength=6), stats[4].sum()].astype(np.int64))))
        return pd.DataFrame(out, columns=["kind", "part", "blob"])

    return parts.groupBy("part").applyInPandas(run, "kind string, part int, blob binary")


def discounts(n: np.ndarray) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, from how often counts 1 to 4 occur."""
    n1, n2, n3, n4 = (float(x) for x in n)
    if min(n1, n2, n3, n4) <= 0:
        return np.array([0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    d = np.array([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(d, 0, [0, 0.95, 1.95, 2.95])


class Model:
    """The parts of bounded size: discounts, log p, log g and totals of frequent words, frequent pairs, bit tables."""

    def __init__(self, top: np.ndarray, words: list[bytes], sizes: list[bytes], hot: list[bytes], seen: list[bytes],
                 near: list[bytes], far: list[bytes], known: list[bytes]):
        self.top, self.near, self.far, self.known = top, sieve_of(near), sieve_of(far), sieve_of(known)
        table = np.zeros(len(top) * 8, np.int64)
        for blob in words:
            at, n = unpack(blob)
            table[at] += n
        table = table.reshape(len(top), 8)
        before = table[:, 4]  # distinct words seen before each word
        self.discount = discounts(np.sum([unpack(b)[0] for b in sizes], axis=0) if sizes else np.zeros(4))
        rare = np.sum([unpack(b)[0] for b in seen], axis=0) if seen else np.zeros(7, np.int64)
        spread = np.bincount(np.minimum(before, 5), minlength=6) + rare[:6]  # words by number of predecessors
        self.low = discounts(spread[1:5])
        self.pairs = max(before.sum() + rare[6], 1)
        cut = float(self.low[np.minimum(np.arange(6), 3)] @ spread)
        self.base = max(cut, 1.0) / self.pairs / max(WORDS, int(spread[1:].sum()))
        self.unseen = math.log(self.base)
        self.log_p, self.total = self.p_of(before), np.maximum(table[:, 5], 1)
        self.log_g = self.g_of(table[:, 1:4].T, table[:, 5])
        pairs = [unpack(b) for b in hot]
        self.hot = np.concatenate([p for p, _ in pairs]) if pairs else np.empty(0, np.uint64)
        order = np.argsort(self.hot)
        n = np.concatenate([c for _, c in pairs]) if pairs else np.empty(0, np.int64)
        self.hot, self.hot_gain = self.hot[order], self.gain(self.hot[order], n[order]).astype(np.float32)
        self.log_p, self.log_g = self.log_p.astype(np.float32), self.log_g.astype(np.float32)

    def for_shards(self) -> Model:
        """The model without what only the asking side looks at: bit tables and frequent pairs."""
        out = copy.copy(self)
        del out.near, out.far, out.known, out.hot, out.hot_gain
        return out

    def p_of(self, before: np.ndarray) -> np.ndarray:
        """log p of words with so many predecessors."""
        return np.log(np.maximum(before - self.low[np.minimum(before, 3)], 0) / self.pairs + self.base)

    def g_of(self, kinds: Sequence[np.ndarray], total: np.ndarray) -> np.ndarray:
        """log g of contexts with so many continuations of count 1, 2, more."""
        left = sum(k * d for k, d in zip(kinds, self.discount[1:], strict=True)) / np.maximum(total, 1)
        return np.where(total > 0, np.log(np.maximum(left, 1e-12)), 0.0)

    def gain(self, pairs: np.ndarray, n: np.ndarray) -> np.ndarray:
        """d(v, w) of pairs of frequent words seen ``n`` times."""
        plain = pairs * UNSCATTER & PAIR
        v, w = (plain >> np.uint64(BITS)).astype(np.int64), (plain & np.uint64((1 << BITS) - 1)).astype(np.int64)
        return self.gain_of(self.log_g[v].astype(np.float64) + self.log_p[w], self.total[v], n)

    def gain_of(self, lower: np.ndarray, total: np.ndarray, n: np.ndarray) -> np.ndarray:
        """d(v, w) from log g(v) + log p(w), the total of v, and the count of the pair."""
        return np.log((n - self.discount[np.minimum(n, 3)]) / total + np.exp(lower)) - lower

    def far_gain(self, v: np.ndarray, w: np.ndarray, n: np.ndarray, rare: np.ndarray, stats: list[np.ndarray]) -> np.ndarray:
        """d(v, w) of pairs of word hashes; ``rare`` and ``stats`` are the sums of their words that are not frequent."""
        lower, total = np.zeros(len(n)), np.ones(len(n), np.int64)
        at, has = looked_up(self.top, v)
        lower[has], total[has] = self.log_g[at[has]], self.total[at[has]]
        at = np.searchsorted(rare, v[~has])
        lower[~has], total[~has] = self.g_of([x[at] for x in stats[:3]], stats[3][at]), np.maximum(stats[3][at], 1)
        at, has = looked_up(self.top, w)
        lower[has] += self.log_p[at[has]]
        lower[~has] += self.p_of(stats[4][np.searchsorted(rare, w[~has])])
        return self.gain_of(lower, total, n)


# --- scoring ----------------------------------------------------------------------


def score(docs: DataFrame, tables: DataFrame, model: Model, shards: int, tokens_at_once: int) -> DataFrame:
    """(id, lang, n_words, log_prob) of docs (id, lang, text); ``tables``: (kind, part, blob) of each shard."""
    docs_at_once = 1 << 16
    own_model = model.for_shards()

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, task, done = Words(), TaskContext.get().partitionId(), 0

        def flush(keys: list, held: list[np.ndarray]) -> pd.DataFrame:
            nonlocal done
            batch, done = (task << 24) + done, done + 1
            size = np.array([len(x) for x in held])
            doc = np.repeat(np.arange(len(held)), size)
            w = np.concatenate(held) if held else np.empty(0, np.uint64)
            at, top = looked_up(model.top, w)
            known = np.where(top, model.log_p[at], model.unseen).astype(np.float64)
            starts = (np.cumsum(size) - size)[size > 0]
            v = np.r_[np.uint64(0), w[:-1]] if len(w) else w
            v[starts] = 0
            v_at, v_top = (np.r_[x[:1], x[:-1]] for x in (at, top))
            v_at[starts], v_top[starts] = 0, True  # number 0 begins a text
            known[v_top] += model.log_g[v_at[v_top]]
            near = top & v_top
            pair = scattered(v_at[near].astype(np.uint64) << np.uint64(BITS) | at[near].astype(np.uint64))
            found, hot = looked_up(model.hot, pair)
            known[np.flatnonzero(near)[hot]] += model.hot_gain[found[hot]]
            sums = np.bincount(doc, weights=known, minlength=len(held))
            last = np.zeros(len(w), bool)
            last[(np.cumsum(size) - 1)[size > 0]] = True
            # what no shard has seen adds nothing and need not be asked
            ask_near = ~hot & may_hold(model.near, pair)
            far, rare = pair_keys(v[~near], w[~near]), w[~top]
            ask_far, ask_rare = may_hold(model.far, far, 64), may_hold(model.known, rare, 64)
            wanted = [ordered(pair[ask_near], doc[near][ask_near]), ordered(far[ask_far], doc[~near][ask_far]),
                      ordered(rare[ask_rare], doc[~top][ask_rare], last[~top][ask_rare])]
            cuts = [by_shard(x[0], shards, bits) for x, bits in zip(wanted, (2 * BITS, 64, 64), strict=True)]
            rows = []
            for s in range(shards):
                part = [[y[cut[s]:cut[s + 1]] for y in x] for x, cut in zip(wanted, cuts, strict=True)]
                if any(len(x[0]) for x in part):
                    rows.append((batch, s, False, pack(*(y for x in part for y in (gaps(x[0]), *x[1:])))))
            # what the batch already knows travels along to one of the shards
            rows.append((batch, batch % shards, True, zlib.compress(pickle.dumps((keys, size, sums)), 1)))
            return pd.DataFrame(rows, columns=["batch", "shard", "head", "blob"])

        def ordered(key: np.ndarray, doc: np.ndarray, *more: np.ndarray) -> list[np.ndarray]:
            order = np.lexsort((doc, key))
            return [key[order], doc[order].astype(np.uint16), *(x[order] for x in more)]

        keys, held, size = [], [], 0
        for batch in batches:
            for key, lang, t in zip(batch["id"], batch["lang"], batch["text"], strict=True):
                keys.append((key, lang))
                held.append(words.of(t or ""))
                size += len(held[-1])
                if size >= tokens_at_once or len(held) >= docs_at_once:
                    yield flush(keys, held)
                    keys, held, size = [], [], 0
        if held:
            yield flush(keys, held)

    def answer(asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        def table(kind: str) -> tuple[np.ndarray, list[np.ndarray]]:
            parts = sorted(([np.cumsum(x[0]), *x[1:]] for x in map(unpack, own["blob"][own["kind"] == kind])), key=lambda x: x[0][0])
            every = [np.concatenate(x) for x in zip(*parts, strict=True)] or [np.empty(0, np.uint64)] + [np.empty(0, np.int64)] * 5
            return every[0], every[1:]

        seen, n, v, w, m = next((unpack(b) for b in own["blob"][own["kind"] == "pairs"]), [np.empty(0, t) for t in (np.uint64, np.int64, np.uint64, np.uint64, np.int64)])
        seen, far = np.cumsum(seen).astype(np.uint64), pair_keys(v, w)
        gain, far_gain = own_model.gain(seen, n), own_model.far_gain(v, w, m, *table("back"))
        rare, stats = table("facts")
        log_p, log_g = own_model.p_of(stats[4]) - own_model.unseen, own_model.g_of(stats[:3], stats[3])
        out = []
        for batch, head, blob in zip(asked["batch"], asked["head"], asked["blob"], strict=True):
            if head:
                out.append((batch, True, blob))
                continue
            pair, doc, other, other_doc, word, word_doc, last = unpack(blob)
            docs, values = [], []
            for keys, wanted, of, value in ((seen, pair, doc, gain), (far, other, other_doc, far_gain)):
                at, hit = looked_up(keys, np.cumsum(wanted))
                docs.append(of[hit]), values.append(value[at[hit]])
            at, hit = looked_up(rare, np.cumsum(word))
            docs.append(word_doc[hit]), values.append(log_p[at[hit]] + np.where(last[hit], 0, log_g[at[hit]]))
            doc = np.concatenate(docs)
            if len(doc):
                sums = np.bincount(doc, weights=np.concatenate(values))
                some = np.flatnonzero(sums)
                out.append((batch, False, pack(some.astype(np.uint16), sums[some].astype(np.float32))))
        return pd.DataFrame(out, columns=["batch", "head", "blob"])

    def collect(group: pd.DataFrame) -> pd.DataFrame:
        keys, size, sums = pickle.loads(zlib.decompress(group["blob"][group["head"]].iloc[0]))
        for blob in group["blob"][~group["head"]].sort_values(key=lambda s: s.map(zlib.crc32)):  # one order of addition
            doc, part = unpack(blob)
            sums[doc] += part
        return pd.DataFrame({"id": [k for k, _ in keys], "lang": [x for _, x in keys], "n_words": size, "log_prob": sums})

    asked = docs.mapInPandas(ask, "batch long, shard int, head boolean, blob binary")
    answers = asked.groupBy("shard").cogroup(tables.groupBy("part")).applyInPandas(answer, "batch long, head boolean, blob binary")
    return answers.groupBy("batch").applyInPandas(collect, "id string, lang string, n_words long, log_prob double")


def perplexities(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
                 bytes_in_shard: int = 16 << 20, hot_pairs: int = 1 << 18, tokens_at_once: int = 500_000,
                 hot_words: int = (1 << BITS) - 1) -> DataFrame:
    """(id, lang, n_words, log_ppl) for each row of ``docs``: log of the perplexity under a model of ``trusted``'s text.

    ``log_ppl`` is rounded to four digits, and null for a text without words.
    Everything is counted over all rows. Shards follow the size of the input;
    ``hot_pairs`` frequent pairs and arrays of ``hot_words`` (less than 2**17)
    frequent words travel with the job (under 10 MB together), and three bit
    tables of 8 MB that tell which pairs and words no shard can know.
    """
    stages = Stages(docs.sparkSession, "kneser-ney")
    shards = min(max(16, -(-text_bytes(docs, text) // bytes_in_shard)), 1 << 16)
    spans = max(16, shards // 16)  # of word hashes
    texts = trusted.select(F.col(text).alias("text"))
    top = frequent_words(texts, spans, hot_words, tokens_at_once)
    stages.release()
    packed = count_pairs(texts, top, shards, tokens_at_once)
    merged = stages.keep(merge_counts(packed, top, shards, 64, spans, -(-hot_pairs // shards)), "counts")
    stages.release()
    rare = stages.keep(rare_tables(merged.where("kind = 'rare'").select("part", "origin", "blob"), shards, spans), "rare")
    words = [bytes(r[0]) for r in word_tables(merged.where("kind = 'words'").select("part", "blob")).select("blob").toLocalIterator()]
    small = {k: [bytes(r[0]) for r in t.where(F.col("kind") == k).select("blob").toLocalIterator()]
             for t, k in ((merged, "sizes"), (merged, "hot"), (rare, "seen"), (merged, "near"), (merged, "far"), (rare, "known"))}
    model = Model(top, words, *small.values())
    # documents ask for these only; what the model took from the others need not lie beside the asks
    tables = stages.keep(merged.where("kind = 'pairs'").select("kind", "part", "blob").unionByName(rare.where("kind IN ('back', 'facts')")), "tables")
    stages.drop(merged, rare)
    stages.release()
    rows = docs.select(F.col(key).cast("string").alias("id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    out = score(rows, tables, model, shards, tokens_at_once)
    own = docs.schema[key].dataType
    scores = stages.keep(out.select(F.col("id").cast(own).alias("id"), "lang", "n_words", F.when(F.col("n_words") > 0, F.round(-F.col("log_prob") / F.col("n_words"), 4)).alias("log_ppl")), "scores")
    stages.drop(tables)
    stages.release()
    return scores


def in_fold(key: Column) -> Column:
    """Whether a trusted document is held out of training, to set thresholds: a fifth of them, by hash."""
    return F.crc32(F.concat(F.lit("fold"), key.cast("string"))) % 5 == 0


def judge(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, slack: float = 0.05, least: int = 50, key: str = "doc_id",
          text: str = "text", lang: str = "lang", **model: int) -> DataFrame:
    """(key, lang, n_words, log_ppl, limit, kept) for each row of ``docs``.

    Trusted documents are those labelled quality 1; the model is trained on four
    fifths of them, and the rest set the limits: per language (null is one), the
    ``quantile`` of the log-perplexity of its n held-out documents, plus a margin
    of ``slack * (1 + least / n)``, which widens smoothly as there are fewer. A
    document above the limit of its language is rejected. Texts without words,
    and documents of a language that has no held-out trusted document, are kept:
    nothing speaks against them. Their limit is null. Keys may be of any type;
    they meet those of the labels as text.
    """
    good = labels.where("quality = 1").select(F.col("doc_id").cast("string").alias("_id")).where("_id IS NOT NULL").distinct()
    # A first sieve drops most other documents before the join moves their texts: at most 2**20 hash values
    sieve = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 20))
    values = good.where(~in_fold(F.col("_id"))).select(sieve(F.col("_id")).alias("_sieve")).distinct()
    train = docs.select(F.col(key).cast("string").alias("_id"), text).withColumn("_sieve", sieve(F.col("_id"))).join(
        F.broadcast(values), "_sieve", "left_semi").join(good.where(~in_fold(F.col("_id"))), "_id", "left_semi")
    scores = perplexities(docs, train, key, text, lang, **model)
    # rounded values: exact quantiles over a few ten thousand distinct numbers at most
    held = scores.join(good.where(in_fold(F.col("_id"))), scores["id"].cast("string") == F.col("_id"), "left_semi").select(
        "lang", F.round("log_ppl", 3).alias("x")).where("x IS NOT NULL")
    # null and the empty string are languages of their own
    named = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit(""))
    by_lang = held.groupBy(named(F.col("lang")).alias("_lang")).agg(F.percentile("x", F.lit(quantile)).alias("own"), F.count("x").alias("n"))
    told = scores.withColumn("_lang", named(F.col("lang"))).join(F.broadcast(by_lang), "_lang", "left")  # a row a language
    limit = F.round(F.col("own") + slack * (1 + least / F.col("n")), 4)
    return told.select(F.col("id").alias(key), "lang", "n_words", "log_ppl", limit.alias("limit"),
                       F.coalesce(F.col("log_ppl") <= limit, F.lit(True)).alias("kept"))

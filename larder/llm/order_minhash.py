"""Near-duplicate texts by Order MinHash and banded alignment.

A sketch takes the smallest few of a text's word 3-mers (2-mers in short texts)
under one hash, each labelled with its number of occurrence, and keeps them in
the order in which the text has them: two texts share it with a probability that follows
their edit similarity, order included. Texts that share a sketch are candidates;
a candidate links if a banded alignment of the words leaves at most a fifth of
the longer text unmatched.

One edit spoils at most k k-mers, so of the k-mers of a text of n words at least
n - k + 1 - k * n / 5 are left in any other that is alike, wherever the edits
are: about 2/5 of the 3-mers of a long text, a Jaccard similarity of 1/4. Two
minima are shared with its square, and all of 96 sketches miss such a pair with a
probability of 0.2 %; it is below 1 % at every length, as short texts use 2-mers
(with the few k-mers of a text counted, at worst 0.9 % at 40 words).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import Stages, components

STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit numbers (the finisher of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str) -> list[str]:
    return text.lower().split()


ODD, LONGEST = 0xD1342543DE82EF95, 256
OF_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * STEP)


def powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    return tuple(np.cumprod(np.r_[np.uint64(1), np.full((1 << bits) - 1, x, np.uint64)]) for x in (ODD, pow(ODD, -1, 1 << 64)))


def word_hashes(words: Sequence[str], known: dict[int, tuple[np.ndarray, np.ndarray]], at_once: int = 1024) -> np.ndarray:
    """64 bits for each word: sums over its bytes from running sums over the text, or xxHash where a word is very long.

    ``known`` keeps :func:`powers` from text to text.
    """
    import xxhash

    out = np.empty(len(words), np.uint64)
    for i in range(0, len(words), at_once):
        part = words[i:i + at_once]
        odd = [j for j, w in enumerate(part) if len(w) > LONGEST] if max(map(len, part)) > LONGEST else []
        data = np.frombuffer(" ".join("" if len(w) > LONGEST else w for w in part).encode("utf-8", "surrogatepass") if odd
                             else " ".join(part).encode("utf-8", "surrogatepass"), np.uint8)
        bits = len(data).bit_length()
        if bits not in known:
            known[bits] = powers(bits)
        up, down = known[bits]
        running = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(OF_BYTE[data] * up[:len(data)], out=running[1:])
        gaps = np.flatnonzero(data == 32)
        ends, starts = np.append(gaps, len(data)), np.append(0, gaps + 1)
        out[i:i + at_once] = mixed((running[ends] - running[starts]) * down[starts])
        for j in odd:
            out[i + j] = xxhash.xxh64_intdigest(part[j].encode("utf-8", "surrogatepass"))
    return out


def factors(sketches: int) -> np.ndarray:
    return (mixed(np.arange(1, sketches + 1, dtype=np.uint64) * STEP) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def sketch(hashes: np.ndarray, sketches: int, per_sketch: int, shingle: int) -> np.ndarray:
    """``sketches`` numbers for a text of at least ``shingle`` words."""
    n = len(hashes) - shingle + 1
    kmers = hashes[:n].copy()
    for j in range(1, shingle):
        kmers = kmers * STEP + hashes[j:j + n]  # words' hashes are well mixed
    labelled = mixed(kmers + occurrences(kmers) * STEP)
    short, seeds, most = (labelled >> np.uint64(32)).astype(np.uint32), factors(sketches), np.uint32(0xFFFFFFFF)
    take, rows = min(per_sketch, n), max(1, 65_536 // n)  # so few at a time stay in the processor's cache
    places = np.empty((take, sketches), np.int64)
    for s in range(0, sketches, rows):
        # an odd factor permutes the well-mixed hashes of the k-mers
        value = short[None] * seeds[s:s + rows, None]
        every = np.arange(len(value))
        for j in range(take):
            at = places[j, s:s + rows] = value.argmin(axis=1)
            if j + 1 < take:
                value[every, at] = most
    out = np.zeros(sketches, np.uint64)
    for at in np.sort(places, axis=0):  # in the order of the text
        out = mixed(out + STEP) + labelled[at]
    return out


def occurrences(items: np.ndarray) -> np.ndarray:
    """How often each item came before in ``items``."""
    ranked = np.sort(items)
    if not (ranked[1:] == ranked[:-1]).any():
        return np.zeros(len(items), np.uint64)
    order = np.argsort(items, kind="stable")
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    out = np.empty(len(items), np.uint64)
    out[order] = (np.arange(len(items)) - np.repeat(first, np.diff(np.r_[first, len(items)]))).astype(np.uint64)
    return out


# --- rare words ------------------------------------------------------------------

PLACES = 1 << 17


def rarest(hashes: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The rarest words of a text, one more than an alignment may leave unmatched in it.

    Of two texts that are alike, the longer one has all but this many of its words
    in common with the other, each occurrence for itself. So if both are ordered
    alike, by whatever order, one of the first words is the same in both, where
    "first" is one more than may be missing. With the rarest words first, by the
    ``counts`` of :func:`places`, unlike texts with a passage in common seldom
    share one.
    """
    labelled = mixed(hashes + occurrences(hashes) * STEP)
    order = np.lexsort((labelled, counts[places(hashes)]))
    return labelled[order[:unmatched(len(hashes), similarity) + 1]]


def places(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(PLACES - 1)).astype(np.int64)


def unmatched(n: int, similarity: float) -> int:
    """The most edits between a text of ``n`` words and one as long or shorter that is alike."""
    return math.floor((1 - similarity) * n + 1e-9)


# --- alignment -----------------------------------------------------------------


def banded_distance(long: Sequence[int], short: Sequence[int], band: int) -> int:
    """Edit distance if it is at most ``band``, else some number above ``band``.

    One bit per cell of the band: the vertical differences of a column are two
    bit vectors, and a column follows from the last with a handful of integer
    operations (bit-parallel dynamic programming in a diagonal band).
    """
    band = min(band, len(long))
    width = 2 * band + 2
    full = (1 << width) - 1
    at: dict[int, int] = {}
    for i, w in enumerate(long):
        at[w] = at.get(w, 0) | 1 << i
    up, down, dist = full & (full << (width - band - 1)), 0, band
    diagonal, side = 1 << (width - 1), 1 << (width - 2)
    turn = len(long) - band  # from here on the band's lower edge runs along the last row
    for i, w in enumerate(short):
        shift, same = i + band - width + 1, at.get(w, 0)
        same = (same >> shift if shift >= 0 else same << -shift) & full
        d0 = ((((same & up) + up) & full) ^ up) | same | down
        right, left = down | (full & ~(d0 | up)), d0 & up
        if i < turn:
            dist += not d0 & diagonal
        else:
            dist += bool(right & side) - bool(left & side)
            side >>= 1
        up, down = left | (full & ~((d0 >> 1) | right)), (d0 >> 1) & right
        if dist > 2 * band + 1 + len(long) - len(short):
            return dist
    return dist


def alike(a: Sequence[int], b: Sequence[int], similarity: float) -> bool:
    """Whether 1 - edit distance / longer length is at least ``similarity``; the band widens as needed."""
    if len(a) < len(b):
        a, b = b, a
    limit = unmatched(len(a), similarity)
    if len(a) - len(b) > limit or len(a) - sum((Counter(a) & Counter(b)).values()) > limit:
        return False
    lead = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(b))
    a, b = a[lead:], b[lead:]
    tail = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b), strict=False)) if x != y), len(b))
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if not b:
        return len(a) <= limit
    band = max(16, len(a) - len(b))
    while True:
        band = min(band, limit)
        found = banded_distance(a, b, band)
        if found <= band or band == limit:
            return found <= limit
        band *= 4


# --- the operator ----------------------------------------------------------------


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = 0.8, shingle: int = 3,
                    sketches: int = 96, per_sketch: int = 2, leaders: int = 8, short_shingle: int = 2, long_from: int = 40,
                    fewest: int = 5, wordless_alike: bool = False, words_at_once: int = 200_000, crowd: int = 32) -> DataFrame:
    """One row per row of ``docs``: the key, ``group_id`` (smallest key of its group), ``kept`` (key = group_id).

    Texts with the same words (lower case, cut at white space) are one class.
    Classes of at least ``fewest`` words that share a sketch are candidates if
    their lengths allow the similarity; a group is what links between candidates
    connect. Sketches are of ``shingle``-mers from ``long_from`` words on and of
    ``short_shingle``-mers below; texts a little longer than ``long_from`` have
    both, so that any two texts whose lengths allow a link share a kind. Texts
    without words, null ones too, are groups of their own, or with
    ``wordless_alike`` one group; other texts of fewer words group with equal ones
    only. A row with a null key is a group of its own. Rows that share a key
    should have one text.

    In a bucket of candidates each member is aligned with the bucket's leaders
    rather than with everyone: first with the smallest key, then, for what that
    leaves unlinked, with ``leaders`` more, then four times as many, and so on
    until the bucket is used up. Buckets in which more than ``crowd`` members are
    left hold mostly unlike texts with a passage in common. After the smallest
    key's turn those with the same smallest member become one, and after the first
    ``leaders`` they are cut into one for each of their members' rarest words
    (:func:`rarest`): any two that are alike meet in one of them.
    Pairs inside a group already found are not aligned again, so a group of many
    near copies costs about one alignment a text.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "order-minhash")
    longest_short = math.floor((long_from - 1) / similarity + 1e-9)

    @F.pandas_udf("struct<n:int,h1:long,h2:long,sketch:array<long>>")
    def sketched(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        spread, number = np.uint64(0xD6E8FEB86659FD93), np.arange(1, sketches + 1, dtype=np.uint64)
        for batch in batches:
            rows, held = [], 0
            for t in batch:
                if held > words_at_once:  # not a whole batch of long texts at a time
                    yield pd.DataFrame(rows, columns=["n", "h1", "h2", "sketch"])
                    rows, held = [], 0
                words = words_of(t or "")
                h = word_hashes(words, known)
                held += len(words) + sketches
                place = np.arange(1, len(h) + 1, dtype=np.uint64)
                one, two = mixed(h + place * STEP).sum(dtype=np.uint64), mixed(h ^ place * spread).sum(dtype=np.uint64)
                kinds = [k for k, has in ((shingle, len(h) >= long_from), (short_shingle, len(h) <= longest_short)) if has and len(h) >= fewest]
                own = [mixed(sketch(h, sketches, per_sketch, k) + number * STEP + np.uint64(k)) for k in kinds]
                own = np.concatenate([np.empty(0, np.uint64), *own]).view(np.int64)
                rows.append((len(h), int(one.view(np.int64)), int(two.view(np.int64)), own))
            yield pd.DataFrame(rows, columns=["n", "h1", "h2", "sketch"])

    same = ["n", "h1", "h2"]
    all_rows = stages.keep(docs.select(F.col(key).alias("id"), sketched(text).alias("s")).where("id IS NOT NULL")
                           .where("s.n > 0" if not wordless_alike else "true").select("id", "s.*"), "sketches")
    classes = stages.keep(all_rows.groupBy(*same).agg(F.min("id").alias("rep"), F.any_value("sketch").alias("sketch")), "classes")
    rows = stages.keep(all_rows.select("id", *same), "rows")
    stages.drop(all_rows)
    stages.release()
    # first the sketches that two texts share, whatever their lengths: most are of one text only
    rung = F.floor(F.log(F.col("n")) / -math.log(similarity) + 1e-9).cast("int")
    values = classes.select("rep", "n", rung.alias("rung"), F.explode("sketch").alias("value"))

    def common(rows: DataFrame, by: str) -> DataFrame:
        several = rows.groupBy(by).agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high").select(by)
        return rows.join(several, by, "left_semi")

    shared = stages.keep(common(values, "value"), "shared")
    reps = stages.keep(stages.again(classes).select(*same, "rep"), "reps")
    stages.drop(classes)
    stages.release()
    # then two length classes a text, so that lengths within the similarity meet in one
    buckets = shared.select("rep", "n", F.explode(F.array("rung", F.col("rung") + 1)).alias("rung"), "value").select(
        "rep", "n", F.xxhash64("rung", "value").alias("bucket"))
    buckets = stages.keep(common(buckets, "bucket"), "buckets")
    stages.drop(shared)
    stages.release()
    texts = stages.keep(
        docs.select(F.col(key).alias("rep"), F.col(text).alias("text")).join(buckets.select("rep").distinct(), "rep", "left_semi"),
        "texts")

    @F.pandas_udf("boolean")
    def linked(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            numbers: dict[str, int] = {}
            last, other = None, []  # leaders come in runs
            out = []
            for x, y in zip(a, b, strict=True):
                if y is not last:
                    last, other = y, [numbers.setdefault(w, len(numbers)) for w in words_of(y)]
                out.append(alike([numbers.setdefault(w, len(numbers)) for w in words_of(x)], other, similarity))
                if len(numbers) > 500_000:
                    numbers, last = {}, None
            yield pd.Series(out, dtype=bool)

    def merged(crowded: DataFrame) -> DataFrame:
        """Buckets with the same smallest member, as those of one passage often have, as one: whoever met in one of them still does."""
        first = crowded.groupBy("bucket").agg(F.xxhash64(F.min("rep")).alias("first"))
        return stages.keep(crowded.join(first, "bucket").select(F.col("first").alias("bucket"), "rep", "n", "group").distinct(), "merged")

    def split(crowded: DataFrame) -> DataFrame:
        """Buckets as one for each of the rarest words of their members."""
        members = stages.keep(stages.again(texts).join(crowded.select("rep").distinct(), "rep", "left_semi"), "members")

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found, known = np.zeros(PLACES, np.uint32), {}
            for batch in batches:
                for t in batch.column(0):
                    np.add.at(found, places(word_hashes(words_of(t.as_py()), known)), 1)
            yield pa.RecordBatch.from_arrays([pa.array([int(found.sum()) % 16], pa.int32()), pa.array([found.tobytes()])], ["part", "counts"])

        def summed(parts: pd.DataFrame) -> pd.DataFrame:
            total = np.sum([np.frombuffer(c, np.uint32) for c in parts["counts"]], axis=0, dtype=np.uint32)
            return pd.DataFrame({"counts": [total.tobytes()]})

        # 16 rows, whatever the corpus: how often words are met, by 17 bits of their hash
        sums = members.select("text").mapInArrow(counted, "part int, counts binary").groupBy("part").applyInPandas(summed, "counts binary")
        counts = np.sum([np.frombuffer(r.counts, np.uint32) for r in sums.collect()], axis=0, dtype=np.uint64).astype(np.uint32)

        @F.pandas_udf("array<long>")
        def rare(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for batch in batches:
                yield pd.Series([rarest(word_hashes(words_of(t), known), counts, similarity).view(np.int64) for t in batch])

        words = stages.keep(members.select("rep", rare("text").alias("words")), "words")
        cut = crowded.join(words, "rep").select("rep", "n", "group", "bucket", F.explode("words").alias("word")).select(
            F.xxhash64("bucket", "word").alias("bucket"), "rep", "n", "group")
        out = stages.keep(cut, "cut")
        stages.drop(members, words)
        return out

    def mixed_groups(rows: DataFrame) -> DataFrame:
        """Buckets in which several groups are left, and how many members."""
        return rows.groupBy("bucket").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.count(F.lit(1)).alias("members")).where(
            "low < high").select("bucket", "members")

    edges = tried = None
    slots = 1
    longer = F.greatest("n", "leader_n")
    fits = longer - F.least("n", "leader_n") <= F.floor((1 - similarity) * longer + 1e-9)
    left = start = stages.keep(buckets.withColumn("group", F.col("rep")), "left")
    stages.drop(buckets)
    while True:
        slot = F.pmod(F.xxhash64("rep"), F.lit(slots))
        heads = left.groupBy("bucket", slot.alias("slot")).agg(F.min(F.struct("rep", "n", "group")).alias("head")).select(
            "bucket", F.col("head.rep").alias("leader"), F.col("head.n").alias("leader_n"), F.col("head.group").alias("leader_group"))
        heads = stages.keep(heads, "heads")
        if slots == 1:  # a text's smallest leader first: most links need no other
            pairs = left.join(heads, "bucket").where("rep > leader").where(fits).groupBy("rep").agg(F.min("leader").alias("leader"))
        else:
            pairs = left.join(heads, "bucket").where("rep <> leader AND group <> leader_group").where(fits).select(
                F.least("rep", "leader").alias("leader"), F.greatest("rep", "leader").alias("rep")).distinct()
            pairs = pairs.join(tried, ["rep", "leader"], "left_anti")
        pairs = stages.keep(pairs.select("rep", "leader"), "pairs")
        before, tried = tried, pairs if tried is None else stages.keep(tried.unionByName(pairs), "tried")
        told = pairs.join(stages.again(texts).withColumnRenamed("text", "a"), "rep").join(
            texts.select(F.col("rep").alias("leader"), F.col("text").alias("b")), "leader")
        new = stages.keep(told.select("rep", "leader", linked("a", "b").alias("same")).where("same").select("rep", "leader"), "links")
        if before is not None:
            stages.drop(before, pairs)
        grown = edges is None or not new.isEmpty()
        if edges is not None and grown:
            both = stages.keep(edges.unionByName(new), "edges")
            stages.drop(edges, new)
            edges = both
        elif edges is None:
            edges = new
        if grown:
            found = components(edges, stages, "leader", "rep").select(F.col("node").alias("rep"), F.col("component").alias("group"))
        if slots > 1:  # leaders have met their whole bucket, and stand for their group in it
            of = heads.select("bucket", F.col("leader").alias("rep"))
            left = left.join(of, ["bucket", "rep"], "left_anti")
        now = stages.keep(left.select("bucket", "rep", "n").join(found, "rep", "left").select(
            "bucket", "rep", "n", F.coalesce("group", "rep").alias("group")), "now")
        stages.release()
        rest = stages.keep(now.join(mixed_groups(now), "bucket"), "left")
        stages.drop(now, heads, start)
        crowded = rest.where(F.col("members") > crowd)
        if slots <= leaders and not crowded.isEmpty():
            fewer = merged(crowded.drop("members"))
            if slots == leaders:
                parts = split(fewer)
                stages.drop(fewer)
                fewer = parts
            both = stages.keep(fewer.join(mixed_groups(fewer), "bucket").unionByName(rest.where(F.col("members") <= crowd)), "left")
            stages.drop(rest, fewer)
            stages.release()
            rest = both
        left = start = rest
        if left.isEmpty():
            break
        slots = max(leaders, 4 * slots)
    member = rows.join(reps, same).join(found, "rep", "left").select(
        "id", F.coalesce("group", "rep").alias("group")).distinct()
    return docs.select(F.col(key).alias("id")).join(member, "id", "left").select(
        F.col("id").alias(key), F.coalesce("group", "id").alias("group_id"),
        F.coalesce(F.col("group") == F.col("id"), F.lit(True)).alias("kept"))

"""Target-distribution importance resampling over hashed n-grams of words.

A document's words, joined by single spaces, are scanned once; the CRC-32 of
the prefix before and after each word is stored. The CRC of any n-gram follows
from two prefixes: appending bytes to A multiplies its CRC by a power of x over
GF(2) that depends on their number only, so ``crc(AB) ^ shift(crc(A), len(B))``
is ``crc(B)``, what A brought in cancels out. No n-gram is ever built as a string.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import Stages
from larder.operators.ranking import with_running

# Bytes of words stay, A-Z become a-z, all others separate; every byte of a
# character beyond ASCII belongs to a word.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
NEAR = 64  # shifts below this many bytes take one table


class Shift:
    """Multiplication of CRCs by x**(8 * bytes) modulo the CRC-32 polynomial, for many values at once."""

    def __init__(self) -> None:
        table = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)  # fixed value: the polynomial
        self.table = table
        # row k: the four bytes of a value, each shifted by k bytes
        rows = [np.arange(256, dtype=np.uint32)[None] << (8 * np.arange(4, dtype=np.uint32))[:, None]]
        for _ in range(NEAR):
            rows.append((rows[-1] >> 8) ^ table[rows[-1] & 255])
        self.near = np.stack(rows[:-1])
        self.far = [rows[-1]]  # by NEAR * 2**i bytes

    def __call__(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        low = n % NEAR
        out = self.near[low, 0, crc & 255]
        for k in (1, 2, 3):
            out = out ^ self.near[low, k, (crc >> (8 * k)) & 255]
        rest, i = n // NEAR, 0
        while rest.any():
            if i == len(self.far):
                self.far.append(self.by(self.far[-1], self.far[-1]))
            odd = np.flatnonzero(rest & 1)
            out[odd] = self.by(self.far[i], out[odd])
            rest, i = rest >> 1, i + 1
        return out

    @staticmethod
    def by(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24]


def stretches(text: bytes, longest: int, size: int) -> Iterator[tuple[list[bytes], int]]:
    """Words of a text in stretches of about ``size`` bytes, and how many of them the stretch before had already.

    A stretch repeats the last words of the one before it, so that every n-gram lies in one.
    """
    text = text.translate(WORD_BYTES)
    at, carried = 0, []
    while at < len(text):
        end = text.find(b" ", at + size)
        end = len(text) if end < 0 else end
        words = carried + text[at:end].split()
        yield words, len(carried)
        at, carried = end, words[max(len(words) - longest + 1, 0):]


class Features:
    """N-gram buckets of many texts at once."""

    def __init__(self, longest: int, buckets: int):
        self.longest, self.buckets, self.shift = longest, buckets, Shift()

    def of(self, parts: list[tuple[list[bytes], int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For n from 1 to ``longest``: buckets of all n-grams, and the stretch each belongs to."""
        sizes = np.array([len(words) for words, _ in parts], np.int64)
        part = np.repeat(np.arange(len(parts)), sizes)
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        new = np.arange(len(part)) - first >= np.repeat([carried for _, carried in parts], sizes)
        before, after, length = [], [], []
        for words, _ in parts:
            crc = 0
            for w in words:
                before.append(crc)
                crc = zlib.crc32(w, crc)
                after.append(crc)
                crc = zlib.crc32(b" ", crc)
            length += map(len, words)
        before, after = np.array(before, np.uint32), np.array(after, np.uint32)
        stop = np.cumsum(np.array(length, np.int64) + 1) - 1  # places if all words were joined by one byte
        start = stop - length
        for n in range(1, self.longest + 1):
            m = len(part) - n + 1
            if m <= 0:
                return
            at = np.flatnonzero((part[:m] == part[n - 1:]) & new[n - 1:])
            crc = after[at + n - 1] ^ self.shift(before[at], stop[at + n - 1] - start[at])
            yield (crc % np.uint32(self.buckets)).astype(np.int64), part[at]


def _groups(texts: list[bytes | None], longest: int, chars: int) -> Iterator[tuple[list, list[int]]]:
    """Stretches of a batch of texts, some ``chars`` bytes at a time, and the text each belongs to."""
    parts, owner, held = [], [], 0
    for i, t in enumerate(texts):
        for part in stretches(t or b"", longest, chars):
            parts.append(part)
            owner.append(i)
            held += sum(map(len, part[0]))
            if held >= chars:
                yield parts, owner
                parts, owner, held = [], [], 0
    if parts:
        yield parts, owner


def bucket_counts(docs: DataFrame, text: str, longest: int, buckets: int, chars_at_once: int = 1_000_000) -> DataFrame:
    """(bucket, n): how many n-grams of all texts fall in each bucket; buckets without any are left out.

    A task keeps one array of counts, so at most ``buckets`` rows of a task are shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(longest, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for parts, _ in _groups(batch.column(0).cast(pa.binary()).to_pylist(), longest, chars_at_once):
                for bucket, _ in features.of(parts):
                    total += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])

    counted = docs.select(F.col(text).cast("string")).mapInArrow(run, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(own: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """What a feature of each bucket adds to a document's weight, in thousandths of a natural logarithm, rounded down.

    One is added to the count of every bucket on either side.
    """
    s_all, t_all = sum(own.values()), sum(target.values())
    return np.array([
        math.floor(1000 * math.log((target.get(b, 0) + 1) * float(s_all + buckets) / ((own.get(b, 0) + 1) * float(t_all + buckets))))
        for b in range(buckets)], np.int64)


def weigh(docs: DataFrame, key: str, text: str, gain: np.ndarray, longest: int, chars_at_once: int = 1_000_000) -> DataFrame:
    """(key, n_words, n_features, weight) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(longest, len(gain))
        for batch in batches:
            words, found, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for parts, owner in _groups(batch.column(1).cast(pa.binary()).to_pylist(), longest, chars_at_once):
                owner = np.array(owner)
                np.add.at(words, owner, [len(w) - carried for w, carried in parts])
                for bucket, part in features.of(parts):
                    np.add.at(found, owner, np.bincount(part, minlength=len(parts)))
                    # sums of whole numbers far below 2**53: exact
                    np.add.at(weight, owner, np.bincount(part, gain[bucket], len(parts)).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, (words, found, weight))], [key, "n_words", "n_features", "weight"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key), F.col(text).cast("string").alias("text" if key != "text" else "_text"))
    return rows.mapInArrow(run, f"`{key}` {kind}, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
             percent: int = 5, fewest_words: int = 20, longest: int = 3, buckets: int = 10_000, seed: int = 42) -> DataFrame:
    """Draw the documents that look most like ``target``, without replacement.

    Returns one row per row of ``docs``: the key, n_words, n_features, weight,
    score and rank. The weight is the sum of the gains of a text's n-grams of 1
    to ``longest`` words; Gumbel noise made from the hash of ``seed`` and key
    turns the highest scores into a sample drawn by weight. Of the N rows with at
    least ``fewest_words`` words, floor(percent * N / 100) are drawn; ties go to
    the smaller key, then to the smaller weight. Others have a null rank.

    A null text, or one without words, has no features and weight 0. A row with a
    null key has a null score and is neither counted in N nor drawn. Rows that
    share a key are rows of their own. Only key and text of ``docs`` are read.

    Two narrow maps over the texts: the tables between them hold ``buckets`` rows,
    whatever the size of the corpus. The ranking range-partitions a few numbers
    a document.
    """
    stages = Stages(docs.sparkSession, "resample")
    # both tables have at most ``buckets`` rows
    own, wanted = ({r.bucket: r.n for r in bucket_counts(df, column, longest, buckets).collect()}
                   for df, column in ((docs, text), (target, target_text)))
    weighed = weigh(docs, key, text, gains(own, wanted, buckets), longest)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = stages.keep(weighed.withColumn("score", F.col("weight") + noise), "scored")
    may = (F.col("n_words") >= fewest_words) & F.col("score").isNotNull()
    drawn = scored.agg(F.floor(F.count_if(may) * percent / 100)).scalar()
    ordered = with_running(scored.withColumn("_may", may), [F.desc("_may"), F.desc("score"), F.asc(key), F.asc("weight")])
    rank = F.when(F.col("_may") & (F.col("position") <= drawn), F.col("position"))
    return ordered.select(key, "n_words", "n_features", "weight", "score", rank.alias("rank"))

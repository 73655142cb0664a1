"""Clusters of similar word sets: MinHash signatures cut in bands, pairs verified, linked sets joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.graph import components
from larder.session import discard, materialize


def band_hashes(words: Column, bands: int, rows: int) -> Column:
    """One hash a band, of the ``rows`` smallest word hashes of that band."""
    def smallest(number: Column) -> Column:
        return F.array_min(F.transform(words, lambda w: F.xxhash64(number, w)))

    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)), lambda band: F.xxhash64(band, *[smallest(band * rows + k) for k in range(rows)])
    )


def overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct words."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def similar_pairs(
    sets: DataFrame, key: str, words: str, similarity: float = 0.8, bands: int = 24, rows: int = 4, block: int = 128
) -> DataFrame:
    """(a, b): keys of distinct word sets with a Jaccard similarity of ``similarity`` or more, each pair once.

    ``key`` is unique. Candidates share a band; with 24 bands of 4 a pair at 0.8
    is missed with a probability of 3 in a million, one at 0.9 of 3 in 10**12.
    They are verified, so no pair below the limit comes out. The members of a
    bucket meet in blocks of about ``block``: a bucket that half the sets fall in
    is dealt over as many tasks as its pairs of blocks, and only pairs that pass
    leave the join. Sets whose sizes rule out the similarity do not meet.
    """
    stored = materialize(
        sets.where(F.size(words) > 0).select(F.col(key).alias("key"), F.col(words).alias("words"))
        .withColumn("band", band_hashes(F.col("words"), bands, rows)), "signatures")
    member = stored.select("key", "words", F.posexplode("band").alias("band", "bucket"))
    crowded = stored.select(F.posexplode("band").alias("band", "bucket")).groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n"))
    # a bucket with one member has no pairs: most of them end here
    blocks = crowded.where("n > 1").select("band", "bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    placed = materialize(
        member.join(blocks, ["band", "bucket"]).withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")), "members")
    cell = ["band", "bucket", "i", "j"]
    left = placed.select("band", "bucket", F.col("key").alias("a"), F.col("words").alias("a_words"), F.col("own").alias("i"),
                         F.explode(F.sequence(F.col("own"), F.col("blocks") - 1)).alias("j"))
    right = placed.select("band", "bucket", F.col("key").alias("b"), F.col("words").alias("b_words"), F.col("own").alias("j"),
                          F.explode(F.sequence(F.lit(0), F.col("own"))).alias("i"))
    small, large = F.least(F.size("a_words"), F.size("b_words")), F.greatest(F.size("a_words"), F.size("b_words"))
    # inside one block every pair is met from both sides, between blocks from one
    once = (F.col("i") < F.col("j")) | (F.col("a") < F.col("b"))
    passes = once & (small >= similarity * large - 1e-9) & (overlap(F.col("a_words"), F.col("b_words")) >= similarity - 1e-9)
    pairs = left.join(right, cell).where(passes).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    found = materialize(pairs.distinct(), "pairs")
    discard(placed, stored)
    return found


def clusters(sets: DataFrame, key: str, words: str, similarity: float = 0.8) -> DataFrame:
    """(key, cluster): sets linked by similarity, directly or through others; the cluster is its smallest key."""
    pairs = similar_pairs(sets, key, words, similarity)
    joined = components(pairs)
    discard(pairs)
    return sets.select(key).join(joined.withColumnRenamed("node", key), key, "left").select(
        key, F.coalesce("component", key).alias("cluster"))

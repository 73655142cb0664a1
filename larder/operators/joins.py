"""Lookup joins that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The sketch names at most this many keys; a task has room for as many counters as it tracks.
MOST_HEAVY, TRACKED = 256, 4096


def heavy_keys(df: DataFrame, on: Sequence[str]) -> dict[int, int]:
    """Hash of each key that fills more than one shuffle partition's share of the rows -> how many shares.

    One pass over the key columns with a counting sketch: a row of bounded size
    a task, no shuffle of the data. A key above the sketch's error of one
    row in a thousand is found; keys below a partition's share need no split.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = df.select(F.xxhash64(*on).alias("key")).agg(
        F.expr(f"approx_top_k(key, {MOST_HEAVY}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("rows")
    ).first()
    share = max(found["rows"] / parts, 1.0)
    return {r["item"]: int(-(-r["count"] // share)) for r in found["top"] if r["count"] > share}


def pieces_of(on: Sequence[str], heavy: dict[int, int]) -> Column:
    """Into how many pieces a row's key is split: 1 for all but the heavy ones."""
    if not heavy:
        return F.lit(1)
    known = F.create_map(*[F.lit(x) for pair in heavy.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.xxhash64(*on)), F.lit(1))


def spread_join(
    big: DataFrame, unique: DataFrame, on: Sequence[str], spread: Sequence[str], how: str = "left",
    heavy: dict[int, int] | None = None,
) -> DataFrame:
    """Join ``big`` to ``unique`` (one row per key), heavy keys split over as many tasks as they are heavy.

    The heavy keys are found by a sketch over ``big``, unless given as
    :func:`heavy_keys` returns them; only their rows of ``unique`` are repeated,
    and without any it is a plain join. ``spread`` names
    columns that vary inside one key; their hash picks the piece, so a re-run of
    a lost task gives the same rows. No broadcast is forced: the planner chooses
    it where the size it knows is under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    heavy = heavy_keys(big, on) if heavy is None else heavy
    if not heavy:
        return big.join(unique, list(on), how)
    pieces = pieces_of(on, heavy)
    left = big.withColumn("_slice", F.pmod(F.xxhash64(*spread), pieces).cast("int"))
    right = unique.withColumn("_slice", F.explode(F.sequence(F.lit(0), (pieces - 1).cast("int"))))
    return left.join(right, [*on, "_slice"], how).drop("_slice")

"""What the two vector operators share: usable vectors, small codebooks, even blocks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vec: Column) -> Column:
    """Not null, not empty, and without null or non-finite components."""
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vec) > 0) & good, F.lit(False))


def spread_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, picked by the hash of ``key``: the same at every run."""
    return df.orderBy(F.xxhash64(key), key).limit(rows)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2 * x @ centres.T, axis=1)


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Up to ``k`` centres of the rows of ``x``."""
    x = np.unique(x, axis=0)
    centres = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(rounds if len(x) > k else 0):
        home = nearest(x, centres)
        count = np.bincount(home, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, home, x)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


def blocks(key: Column, of: Column) -> Column:
    """A block number from 0 to ``of`` - 1 by the hash of ``key``."""
    return F.pmod(F.xxhash64(key), of).cast("int")

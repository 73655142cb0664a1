"""Centroid clustering with ns-bounds.

Each vector stores its distance to every centroid with the round in which it
was last evaluated. Between then and now a centroid moved from one known place
to another, so the distance changed by at most the norm of that one
displacement. The history of centroids is kept for this, which gives tighter
bounds than adding up the norms of each round's drift. A vector whose bounds
cannot tell its nearest centroid is rescanned exactly, in whole numbers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import Stages
from larder.llm.vectors import usable

SAFE = 1e-9  # relative error allowed for in a comparison of bounds


def squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of whole numbers, pairwise by row."""
    gap = points - centres
    return np.einsum("ij,ij->i", gap, gap)


class State:
    """Nearest centroid of each vector, and its last known distance to every centroid."""

    def __init__(self, near: np.ndarray, dist: np.ndarray, seen: np.ndarray):
        self.near, self.dist, self.seen = near, dist, seen

    @classmethod
    def scan(cls, points: np.ndarray, centres: np.ndarray) -> "State":
        """Every distance, evaluated against the first centroids."""
        dist = np.stack([squared(points, c[None]) for c in centres], axis=1)
        return cls(dist.argmin(axis=1), np.sqrt(dist.astype(np.float64)), np.zeros(dist.shape, np.int64))

    def advance(self, points: np.ndarray, history: np.ndarray, exact: bool = False) -> np.ndarray:
        """Assign ``points`` to the centroids of the last round; returns how many distances were evaluated for each.

        With ``exact`` the distance to the nearest centroid is evaluated for all.
        """
        now, k = len(history) - 1, history.shape[1]
        known = np.full(self.dist.shape, np.iinfo(np.int64).max)  # squared distances evaluated now
        # moved[t, j]: norm of the displacement of centroid j since round t
        moved = np.sqrt(((history[-1][None] - history) ** 2).sum(axis=2).astype(np.float64))
        rows = np.arange(len(points))
        loose = moved[self.seen, np.arange(k)[None]]
        low = (self.dist - loose) * (1 - SAFE)
        high = (self.dist[rows, self.near] + loose[rows, self.near]) * (1 + SAFE)
        others = low.copy()
        others[rows, self.near] = np.inf
        spent = np.zeros(len(points), np.int64)
        stale = self.seen[rows, self.near] != now
        # first tighten the distance to the own centroid, then test again
        todo = np.flatnonzero(stale & (exact | (others.min(axis=1) <= high)))
        self._evaluate(points, history, todo, self.near[todo], known, spent)
        high[todo] = self.dist[todo, self.near[todo]] * (1 + SAFE)
        # what may still be as near is evaluated; the rest keeps its bound
        row, j = np.nonzero((others <= high[:, None]) & (self.seen != now))
        self._evaluate(points, history, row, j, known, spent)
        row = np.unique(row)
        self.near[row] = known[row].argmin(axis=1)  # of equal distances the smaller number
        return spent

    def _evaluate(self, points: np.ndarray, history: np.ndarray, row: np.ndarray, j: np.ndarray, known: np.ndarray,
                  spent: np.ndarray) -> None:
        known[row, j] = squared(points[row], history[-1][j])
        self.dist[row, j] = np.sqrt(known[row, j].astype(np.float64))
        self.seen[row, j] = len(history) - 1
        np.add.at(spent, row, 1)


def _matrix(column: pa.ListArray, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def _lists(values: np.ndarray) -> pa.ListArray:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * width, width, dtype=np.int32)), pa.array(values.ravel()))


def cluster(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", dim: int = 64, k: int = 16, rounds: int = 3,
            scale: int = 64, seed: int = 1) -> DataFrame:
    """K-means in whole numbers with a fixed start and number of rounds.

    Kept are the vectors of ``dim`` components, none null or non-finite, each
    component x as floor(scale * x). Those with a component beyond
    sqrt(2**60 / dim) (about 2 million before scaling, for 64 components) are left
    out, since a long cannot hold their squared distances. The start is
    the ``k`` vectors (fewer, if there are not as many) of smallest sha256 of
    ``seed:key``, ties by their components; a null key comes last. Each round
    assigns to the nearest centroid, ties to the smaller number, and moves each
    centroid that has vectors to the floor of their mean.

    Returns one row per kept row: the key, cluster, distance (squared),
    cluster_inertia, inertia (null beyond a long), centroid_sha256 and n_evaluated, the distances the
    last pass worked out for it. Rows that share a key, and equal vectors, are
    rows of their own; no kept row, no row. Only key and vector are read.

    Every round is one narrow map over a stored table of vectors and bounds, and
    sums combined in each task: k rows meet, whatever the share of a cluster.
    The driver holds k centroids a round.
    """
    spark = vectors.sparkSession
    stages = Stages(spark, "ns-bounds")
    whole = F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    largest = math.isqrt((1 << 60) // dim)
    fits = F.forall("q", lambda x: x.between(-largest, largest))
    kept = stages.keep(
        vectors.where(usable(F.col(vec)) & (F.size(vec) == dim))
        .select(F.col(key).alias("id"), whole.alias("q")).where(fits), "vectors")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    start = kept.select(digest.alias("h"), "q").orderBy(F.asc_nulls_last("h"), "q").limit(k).collect()
    if not start:
        empty = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, n_evaluated long"
        kind = vectors.schema[key].dataType.simpleString()
        return spark.createDataFrame([], f"`{key}` {kind}, {empty}")
    history = np.array([r.q for r in start], np.int64)[None]
    k = history.shape[1]
    id_type = kept.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, q array<bigint>, near int, dist array<double>, seen array<bigint>, distance long, n_evaluated long"

    def step(table: DataFrame, history: np.ndarray, last: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                points = _matrix(batch.column("q"), dim, np.int64)
                if len(history) == 1:
                    state = State.scan(points, history[0])
                    spent = np.full(len(points), k, np.int64)
                else:
                    state = State(batch.column("near").to_numpy().astype(np.int64),
                                  _matrix(batch.column("dist"), k, np.float64), _matrix(batch.column("seen"), k, np.int64))
                    spent = state.advance(points, history, exact=last)
                distance = squared(points, history[-1][state.near])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("q"), pa.array(state.near.astype(np.int32)), _lists(state.dist),
                     _lists(state.seen), pa.array(distance), pa.array(spent)],
                    ["id", "q", "near", "dist", "seen", "distance", "n_evaluated"])

        return stages.keep(table.mapInArrow(run, schema), "round")

    state = kept
    for done in range(rounds + 1):
        new = step(state, history, done == rounds)
        stages.drop(state)
        state = new
        if done < rounds:
            sums = state.groupBy("near").agg(  # one row a centroid
                F.count(F.lit(1)).alias("n"), *[F.sum(F.get("q", F.lit(i))).alias(f"s{i}") for i in range(dim)]).collect()
            moved = history[-1].copy()
            for r in sums:
                moved[r.near] = [r[f"s{i}"] // r.n for i in range(dim)]
            history = np.concatenate([history, moved[None]])

    marks = [(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(history[-1].tolist())]
    totals = state.groupBy("near").agg(F.try_sum("distance").alias("cluster_inertia"))
    every = totals.agg(F.try_sum("cluster_inertia").alias("inertia"))
    # k rows: the planner may send them to every task
    known = totals.join(spark.createDataFrame(marks, "near int, centroid_sha256 string"), "near").withColumn(
        "inertia", every.scalar())
    return state.join(F.broadcast(known), "near").select(
        F.col("id").alias(key), F.col("near").alias("cluster"), "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_evaluated")

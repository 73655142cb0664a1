"""Exact top-k inner products by a dual-tree search over cover trees.

The top of the tree are balls around pivots, each with the covering radius of
its rows. A query first searches the ball that its best pivot leads; a ball is
searched besides only if the bound over it reaches the query's k-th score so far.
In a block, queries and rows are indexed together in one cover tree: the children
of a node are a net of its points, picked farthest first, so they are apart from
each other by more than the child radius, from distances of the picked points to
the node's own points only. The search takes pairs of nodes, best bound first. By
the covering radii no query below one node can score higher with a row below the
other than the bound; where that is less than the worst k-th score of the node's
queries, the pair is dropped with all below it.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import Stages
from larder.llm.vectors import blocks, k_means, nearest, spread_sample, usable


VALUES = 4 << 20  # components of the sample, at most


class Node:
    """A ball around point ``centre`` that covers points ``all`` within ``radius``."""

    __slots__ = ("all", "centre", "children", "data", "queries", "radius")

    def __init__(self, centre: int, points: np.ndarray, radius: float, n_queries: int):
        self.centre, self.radius, self.all, self.children = centre, radius, points, []
        self.queries, self.data = points[points < n_queries], points[points >= n_queries] - n_queries


def cover_tree(points: np.ndarray, n_queries: int, shrink: float = 0.75, leaf: int = 64, fan: int = 12) -> Node:
    """The tree of all points; the first ``n_queries`` points are queries.

    The node's own centre comes first, so centres nest; then the point farthest
    from all centres, until every point is within ``shrink`` of the node's radius
    or ``fan`` centres are found. Points go to their nearest centre. A node of at
    most ``leaf`` points, or whose points are too spread for any child to be
    smaller, is a leaf, so a level takes at most ``fan`` distances a point.
    """
    root = Node(0, np.arange(len(points)), float(np.sqrt(((points - points[0]) ** 2).sum(axis=1).max())), n_queries)
    work = [root]
    while work:
        node = work.pop()
        if len(node.all) <= leaf or node.radius <= 0:
            continue
        own = points[node.all]
        centres, home, gap, centre = [], np.zeros(len(own), np.int64), np.full(len(own), np.inf), node.centre
        while True:
            away = np.sqrt(((own - points[centre]) ** 2).sum(axis=1))
            home = np.where(away < gap, len(centres), home)
            gap = np.minimum(away, gap)
            centres.append(centre)
            far = int(gap.argmax())
            if len(centres) == fan or gap[far] <= node.radius * shrink:
                break
            centre = int(node.all[far])
        if len(centres) == 1:  # all near the centre: the ball is smaller than it looked
            node.radius = float(gap.max())
            work.append(node)
            continue
        radii = [float(gap[home == k].max()) for k in range(len(centres))]
        if np.bincount(home) @ np.array(radii) > 0.95 * node.radius * len(own):
            continue  # a point's ball would hardly be smaller
        node.children = [Node(c, node.all[home == k], radii[k], n_queries) for k, c in enumerate(centres)]
        work += node.children
    return root


def best_of_block(queries: np.ndarray, q_id: np.ndarray, rows: np.ndarray, r_id: np.ndarray, k: int,
                  worst: np.ndarray | None = None) -> tuple[pd.DataFrame, int]:
    """The ``k`` best rows of the block for every query, and how many scores were taken.

    Ties go to the smaller id; a query's own id is no candidate, nor are scores
    below the query's ``worst``.
    """
    points = np.concatenate([queries, rows])
    norm = np.sqrt((points**2).sum(axis=1))
    slack = 1e-6 * (1 + norm.max() ** 2)  # rounding of distances
    root = cover_tree(points, len(queries))
    worst = np.full(len(queries), -np.inf) if worst is None else worst.astype(np.float64)
    best = np.full((len(queries), k), -np.inf)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    taken = 0

    def bound(a: Node, b: Node) -> float:
        x, y = a.centre, b.centre
        return float(points[x] @ points[y] + a.radius * norm[y] + b.radius * norm[x] + a.radius * b.radius) + slack

    heap, tick = [(-bound(root, root), 0, root, root)], 0
    while heap:
        low, _, a, b = heapq.heappop(heap)
        if -low < worst[a.queries].min():
            continue
        if not a.children and not b.children:
            scores = queries[a.queries] @ rows[b.data].T
            taken += scores.size
            ids = np.broadcast_to(r_id[b.data], scores.shape)
            scores[(ids == q_id[a.queries, None]) | (scores < worst[a.queries, None])] = -np.inf
            better = np.isfinite(scores).any(axis=1)
            hit = a.queries[better]
            if len(hit):
                s = np.concatenate([best[hit], scores[better]], axis=1)
                i = np.concatenate([best_id[hit], ids[better]], axis=1)
                order = np.lexsort((i, -s), axis=-1)[:, :k]
                best[hit], best_id[hit] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
                worst[hit] = np.maximum(worst[hit], best[hit, -1])
            continue
        split_a = bool(a.children) and (not b.children or a.radius >= b.radius)
        for x, y in ([(c, b) for c in a.children] if split_a else [(a, c) for c in b.children]):
            if len(x.queries) and len(y.data):
                top = bound(x, y)
                if top >= worst[x.queries].min():
                    tick += 1
                    heapq.heappush(heap, (-top, tick, x, y))
    q, place = np.nonzero(np.isfinite(best))
    return pd.DataFrame({"query": q_id[q], "row": best_id[q, place], "score": best[q, place]}), taken


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vec: str = "embedding", scale: int = 1024,
          rows_in_ball: int = 2048, rows_in_block: int = 16_384, queries_in_block: int = 2048, sample_rows: int = 20_000,
          most_pivots: int = 256) -> DataFrame:
    """The ``k`` highest scores of each query over all rows but those of its own key.

    A vector becomes integers, floor(``scale`` * x); the score is the integer
    inner product (exact while it stays below 2**53). ``is_query`` tells the
    query rows. Returns ``query_id, rank, vec_id, score``; ranks from 1, ties to
    the smaller key. Vectors that are null, empty or hold null or non-finite
    components, and null keys, take no part; vectors of different lengths do not
    meet; equal rows count once.

    There is a pivot for every ``rows_in_ball`` rows, ``most_pivots`` at most,
    fitted on at most ``sample_rows`` vectors of the commonest length. A ball of
    more than ``rows_in_block`` rows is searched in several blocks. Queries travel
    in teams of about ``queries_in_block``, those that begin in the same ball
    together, several balls a team where they are few; a team
    meets the balls only that one of its queries must search. Rows are stored
    once by ball and copied to those teams alone: how often follows the number of
    queries, not that of the balls.
    """
    stages = Stages(vectors.sparkSession, "cover-tree")
    ints = F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    rows = vectors.where(usable(F.col(vec)) & F.col(key).isNotNull()).select(
        F.col(key).alias("id"), ints.alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asks")).distinct()
    rows = stages.keep(rows.withColumn("dim", F.size("vec")), "rows")
    common = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if common is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"),
                           F.lit(0).cast("long").alias("score"))
    dim, n = common
    sample = spread_sample(rows.where(F.col("dim") == dim), "id", max(1, min(sample_rows, VALUES // dim))).select("vec").toPandas()
    pivots = k_means(np.array(sample["vec"].tolist(), np.float64), int(min(-(-n // rows_in_ball), most_pivots)))

    @F.pandas_udf("struct<ball:int,gap:double>")
    def placed(batch: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"ball": np.full(len(batch), -1, np.int32), "gap": 0.0})  # other lengths: a ball without a pivot
        own = np.flatnonzero(batch.map(len).to_numpy() == dim)
        if len(own):
            x = np.array(batch.iloc[own].tolist(), np.float64)
            home = nearest(x, pivots)
            out.loc[own, "ball"], out.loc[own, "gap"] = home.astype(np.int32), np.sqrt(((x - pivots[home]) ** 2).sum(axis=1))
        return out

    data = stages.keep(rows.select("id", "vec", "dim", placed("vec").alias("p")).select("id", "vec", "dim", "p.*"), "data")
    sizes = stages.keep(data.groupBy("dim", "ball").agg(
        F.ceil(F.count(F.lit(1)) / rows_in_block).cast("int").alias("parts"), F.max("gap").alias("radius")), "sizes")
    balls = sizes.where((F.col("dim") == dim) & (F.col("ball") >= 0)).orderBy("ball").collect()  # a row a pivot
    number, radius = np.array([b.ball for b in balls]), np.array([b.radius for b in balls])
    middle = pivots[number]
    length = np.sqrt((middle**2).sum(axis=1))

    @F.pandas_udf("int")
    def begin(batch: pd.Series) -> pd.Series:
        return pd.Series([int(number[np.argmax(middle @ v)]) if len(v) == dim else -1 for v in batch], dtype="int32")

    @F.pandas_udf("array<int>")
    def reached(vecs: pd.Series, starts: pd.Series, worst: pd.Series) -> pd.Series:
        """The other balls that may hold a score of at least ``worst``."""
        out = []
        for v, start, least in zip(vecs, starts, worst.fillna(-np.inf), strict=True):
            if start < 0:
                out.append([])
                continue
            size = np.sqrt(v @ v)
            top = middle @ v + size * radius + 1e-6 * (1 + size * (length + radius).max())
            out.append(number[(top >= least) & (number != start)].tolist())
        return pd.Series(out, dtype=object)

    asking = stages.keep(rows.where("asks").select("id", "vec", "dim", begin("vec").alias("start")), "asking")
    # a row for each ball that queries begin in: small ones share a team, large ones have several
    earlier = Window.partitionBy("dim").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    teams = asking.groupBy("dim", "start").agg(F.count(F.lit(1)).alias("n")).select(
        "dim", "start", F.floor(F.coalesce(F.sum("n").over(earlier), F.lit(0)) / queries_in_block).cast("int").alias("team"),
        F.ceil(F.col("n") / queries_in_block).cast("int").alias("teams"))
    asking = stages.keep(stages.again(asking).join(teams, ["dim", "start"]).select(
        "id", "vec", "dim", "start", (F.col("team") + blocks(F.col("id"), F.col("teams"))).alias("team")), "teams")
    parts = sizes.select("dim", "ball", "parts")
    data = data.join(parts, ["dim", "ball"]).select("id", "vec", "dim", "ball", blocks(F.col("id"), F.col("parts")).alias("part"))
    block = ["dim", "ball", "part", "team"]

    def search(ask: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if ask.empty or own.empty:
            return pd.DataFrame({"query": [], "row": [], "score": []}, dtype="int64")
        q, r = (np.array(x["vec"].tolist(), np.float64) for x in (ask, own))
        out, _ = best_of_block(q, ask["id"].to_numpy(), r, own["id"].to_numpy(), k,
                               ask["worst"].fillna(-np.inf).to_numpy(np.float64))
        return out.astype("int64")

    def searched(ask: DataFrame) -> DataFrame:
        """The best of each ball for the queries (id, vec, dim, team, ball, worst) that must search it."""
        ask = ask.join(parts, ["dim", "ball"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        # columns of their own: the two sides are grouped apart
        own = data.join(ask.select(*[F.col(c).alias(c) for c in block]).distinct(), ["dim", "ball", "part"])
        return ask.select(*block, "id", "vec", "worst").groupBy(*block).cogroup(
            own.select(*block, "id", "vec").groupBy(*block)).applyInPandas(search, "query long, row long, score long")

    order = Window.partitionBy("query").orderBy(F.desc("score"), "row")
    first = stages.keep(searched(asking.select("*", F.col("start").alias("ball"), F.lit(None).cast("double").alias("worst"))).withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= k), "first")
    worst = first.where(F.col("rank") == k).select(F.col("query").alias("id"), F.col("score").cast("double").alias("worst"))
    more = searched(stages.keep(stages.again(asking).join(worst, "id", "left").withColumn(
        "ball", F.explode(reached("vec", "start", "worst"))), "more"))
    found = first.select("query", "row", "score").unionByName(more)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        F.col("query").alias("query_id"), "rank", F.col("row").alias("vec_id"), "score")

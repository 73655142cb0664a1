"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut in two halves with a codebook each; the pairs of codewords
form a grid of cells, and every vector lives in one. A vector looks for links in
the cells that a multi-sequence walk visits in the order of their nearness, until
no later cell can hold a link (or until the wished share of links is reached).
Cells are verified in blocks of bounded size, by cosine in double precision.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import Stages, components
from larder.llm.vectors import blocks, k_means, nearest, spread_sample, usable


class Grid:
    """Two codebooks and the bound at which a walk over their cells stops."""

    def __init__(self, sample: np.ndarray, words: int, threshold: float, target_recall: float):
        self.dim = sample.shape[1]
        self.half = max(self.dim // 2, 1)
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        parts = self.parts(unit)
        self.books = [k_means(p, words) for p in parts]
        self.apart = [np.sqrt(np.maximum(((b[:, None] - b[None]) ** 2).sum(axis=2), 1e-30)) for b in self.books]
        #: two unit vectors that link are at most this far apart, squared
        self.bound = 2 - 2 * threshold + 1e-9
        if target_recall < 1:
            self.bound = self._bound_for(unit, threshold, target_recall)

    def parts(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return unit[:, :self.half], unit[:, self.half:] if self.dim > 1 else np.zeros((len(unit), 1))

    def gaps(self, unit: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Home codeword, and least squared distance to each codeword's region, for each half.

        The region of another codeword begins at the plane midway between it and
        the home codeword.
        """
        homes, gaps = [], []
        for p, book, apart in zip(self.parts(unit), self.books, self.apart, strict=True):
            home = nearest(p, book)
            far = ((p[:, None] - book[None]) ** 2).sum(axis=2)
            own = far[np.arange(len(p)), home][:, None]
            homes.append(home)
            gaps.append(np.square(np.maximum(far - own, 0) / (2 * apart[home])))
            gaps[-1][np.arange(len(p)), home] = 0
        return homes, gaps

    def _bound_for(self, unit: np.ndarray, threshold: float, target: float) -> float:
        """The bound that reaches ``target`` of the weakest links, tried on turned sample vectors."""
        side = np.random.default_rng(11).standard_normal(unit.shape)
        side -= (side * unit).sum(axis=1, keepdims=True) * unit
        side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-12)
        turned = threshold * unit + np.sqrt(1 - threshold**2) * side
        homes, _ = self.gaps(turned)
        _, gaps = self.gaps(unit)
        every = np.arange(len(unit))
        return float(np.quantile(gaps[0][every, homes[0]] + gaps[1][every, homes[1]], target)) + 1e-9

    def walk(self, first: np.ndarray, second: np.ndarray) -> list[int]:
        """Cells in the order of the sum of their halves' gaps, up to the bound (multi-sequence traversal)."""
        a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        x, y = first[a].tolist(), second[b].tolist()
        heap, out = [(x[0] + y[0], 0, 0)], []
        while heap:
            gap, i, j = heapq.heappop(heap)
            if gap > self.bound:
                break
            out.append(int(a[i]) * len(b) + int(b[j]))
            if j + 1 < len(b):
                heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))
        return out

    def place(self, vecs: list) -> tuple[list[int], list[list[int]]]:
        """Home cell and visited cells of each vector. Vectors of another length than the sample's share one cell."""
        home, visits = [0] * len(vecs), [[0]] * len(vecs)
        fit = [i for i, v in enumerate(vecs) if len(v) == self.dim]
        for start in range(0, len(fit), 1024):
            some = fit[start:start + 1024]
            x = np.array([vecs[i] for i in some], np.float64)
            homes, gaps = self.gaps(x / np.linalg.norm(x, axis=1, keepdims=True))
            for k, i in enumerate(some):
                home[i] = int(homes[0][k]) * len(self.books[1]) + int(homes[1][k])
                visits[i] = self.walk(gaps[0][k], gaps[1][k])
        return home, visits


def links_of(seekers: pd.DataFrame, members: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Number of vectors linked to each seeker, and pointers that connect all that is linked here."""
    q, m = (np.array(x["vec"].tolist(), np.float64) for x in (seekers, members))
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    q_id, m_id, copies = seekers["rep"].to_numpy(), members["rep"].to_numpy(), members["copies"].to_numpy()
    linked = (q @ m.T >= threshold) & (q_id[:, None] != m_id[None])
    count = linked @ copies
    q_low, m_low, top = q_id.copy(), m_id.copy(), np.iinfo(np.int64).max
    while True:  # the smallest id each can reach inside the block
        q_new = np.minimum(q_low, np.where(linked, m_low[None], top).min(axis=1))
        m_new = np.minimum(m_low, np.where(linked, q_new[:, None], top).min(axis=0))
        if (q_new == q_low).all() and (m_new == m_low).all():
            break
        q_low, m_low = q_new, m_new
    rep, low = np.concatenate([q_id, m_id]), np.concatenate([q_low, m_low])
    n = np.concatenate([count, np.zeros(len(m_id), np.int64)])
    useful = (n > 0) | (low != rep)
    return pd.DataFrame({"rep": rep[useful], "n": n[useful], "low": low[useful]})


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", label: str = "label",
                    threshold: float = 0.98, target_recall: float = 1.0, sample_rows: int = 20_000,
                    rows_in_cell: int = 128, most_words: int = 1024, rows_in_block: int = 1024) -> DataFrame:
    """Links between vectors of equal, non-null label with cosine >= ``threshold``.

    Returns one row per row of ``vectors``: the key, ``n_links`` (other vectors
    linked directly), ``component_id`` (smallest key reachable by links, itself
    included), ``kept`` (key = component_id). Vectors that are null, empty, zero
    or hold null or non-finite components link with nothing, nor do vectors of
    different lengths; null keys are left out. Keys should be unique; rows that
    share a key count as one vector of several forms.

    The codebooks are fitted on at most ``sample_rows`` rows; every row is
    indexed. With ``target_recall`` 1 a walk stops only where no further cell can
    hold a link, so no link is lost. Equal vectors are one class with a count,
    and a cell with more than ``rows_in_block`` members or seekers is dealt over
    blocks; a block returns a line per vector, never pairs.
    """
    spark = vectors.sparkSession
    stages = Stages(spark, "multi-index")
    rows = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vec).alias("vec")).where("id IS NOT NULL")
    good = rows.where(usable(F.col("vec")) & F.col("label").isNotNull() & F.exists("vec", lambda x: x != 0))
    classes = stages.keep(
        good.groupBy("label", "vec").agg(F.min("id").alias("rep"), F.countDistinct("id").alias("copies")), "classes")
    shape = classes.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if shape is None:
        return rows.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    labels = classes.select("label").distinct().count()
    words = int(min(max(np.sqrt(shape["count"] / (rows_in_cell * labels)), 4), most_words))
    sample = spread_sample(classes.where(F.size("vec") == shape["dim"]), "rep", sample_rows).select("vec").toPandas()
    grid = Grid(np.array(sample["vec"].tolist(), np.float64), words, threshold, target_recall)

    @F.pandas_udf("struct<home:long,visits:array<long>>")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            home, visits = grid.place(batch.tolist())
            yield pd.DataFrame({"home": home, "visits": visits})

    placed = stages.keep(classes.select("rep", "label", "copies", "vec", F.size("vec").alias("dim"), place("vec").alias("p")), "placed")
    cell = ["label", "dim", "cell"]
    members = stages.again(placed).select("rep", "label", "dim", "copies", "vec", F.col("p.home").alias("cell"))
    seekers = placed.select("rep", "label", "dim", "vec", F.explode("p.visits").alias("cell"))
    sizes = stages.keep(
        members.groupBy(*cell).count().withColumnRenamed("count", "m").join(
            seekers.groupBy(*cell).count().withColumnRenamed("count", "s"), cell)
        .select(*cell, *[F.ceil(F.col(c) / rows_in_block).alias(c) for c in ("m", "s")]), "sizes")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))
    block = [*cell, "mb", "sb"]
    members = members.join(stages.again(sizes), cell).withColumn("mb", blocks(F.col("rep"), F.col("m"))).withColumn("sb", every("s"))
    seekers = seekers.join(sizes, cell).withColumn("sb", blocks(F.col("rep"), F.col("s"))).withColumn("mb", every("m"))

    def verify(seek: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if seek.empty or own.empty:
            return pd.DataFrame({"rep": [], "n": [], "low": []}, dtype="int64")
        return links_of(seek, own, threshold)

    found = stages.keep(
        seekers.select(*block, "rep", "vec").groupBy(*block)
        .cogroup(members.select(*block, "rep", "vec", "copies").groupBy(*block))
        .applyInPandas(verify, "rep long, n long, low long"), "links")
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    joined = components(found, stages, "rep", "low").withColumnRenamed("node", "rep")
    classes = classes.join(counts, "rep", "left").join(joined, "rep", "left").select(
        "label", "vec", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "rep").alias("component"))
    mine = good.select("id", "label", "vec").distinct().join(classes, ["label", "vec"]).groupBy("id").agg(
        F.sum("n").alias("n"), F.min("component").alias("component"))
    out = rows.select("id").join(mine, "id", "left").select(
        F.col("id").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.col(key) == F.col("component_id"))

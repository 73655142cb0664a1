"""Helpers shared by the operators: stage tables, columns, connected components."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.session import shared_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Stages:
    """Tables in the shared folder that belong to one call of an operator.

    ``keep`` writes a DataFrame once and reads it back: lineage is cut, a lost
    executor costs a task, and the planner sees file sizes. ``drop`` removes a
    table as soon as its reader is done; what the returned DataFrame still reads
    stays.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.paths = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", {}
        self.made = 0

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.made += 1  # a name is never used again, even when its table was dropped
        path = f"{self.base}/{name}-{self.made}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def again(self, table: DataFrame) -> DataFrame:
        """The same table as a source of its own, for joins of a table with itself."""
        return self.spark.read.schema(table.schema).parquet(self.paths[id(table)][0])

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            path, _ = self.paths.pop(id(t))
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def release(self) -> None:
        """Let Spark remove the shuffle files of finished steps now, rather than when the driver next collects garbage."""
        gc.collect()
        self.spark._jvm.System.gc()


def text_bytes(df: DataFrame, text: str) -> int:
    """Bytes of a text column: the planner's figure where it comes from files, else counted."""
    known = int(str(df.select(text)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if known < 1 << 55:  # the planner's "unknown" is near 2**63
        return known
    return df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]


def unit_hash(column: Column, salt: str = "") -> Column:
    """A number in [0, 1) that depends on the value only; the same in any engine with md5."""
    digest = F.md5(F.concat(F.lit(salt), column.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without its own columns of these names: an operator's result replaces them."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def components(edges: DataFrame, stages: Stages, src: str = "a", dst: str = "b") -> DataFrame:
    """Connected components of an undirected graph, as (node, component): the
    smallest node of each component, for every node that is not itself the smallest.

    Each round points a node at its smallest neighbour (if that is smaller),
    follows the pointers to their roots by doubling, and rewrites the edges to
    roots, so that the edge list shrinks until it is empty; rounds and doublings
    are logarithmic in the usual case. Minima are combined before their shuffle,
    and all joins are plain equality joins, which adaptive execution splits where
    one node holds very many edges. Nothing is collected.
    """
    work = stages.keep(
        edges.select(F.least(src, dst).alias("a"), F.greatest(src, dst).alias("b")).where("a < b").distinct(), "edges")
    found: list[DataFrame] = []
    while not work.isEmpty():
        up = stages.keep(work.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up")), "up")
        while True:
            over = up.select(F.col("node").alias("up"), F.col("up").alias("over"))
            if up.join(over, "up", "left_semi").isEmpty():
                break
            nearer = stages.keep(up.join(over, "up", "left").select("node", F.coalesce("over", "up").alias("up")), "up")
            stages.drop(up)
            up = nearer
        found.append(up)
        of_a, of_b = (up.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up")) for c in "ab")
        moved = work.join(of_b, "b", "left").join(of_a, "a", "left").select(
            F.coalesce("a_up", "a").alias("x"), F.coalesce("b_up", "b").alias("y")).where("x <> y")
        smaller = stages.keep(
            moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        stages.drop(work)
        work = smaller
    if not found:
        return work.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = found.pop().select("node", F.col("up").alias("component"))
    while found:
        up = found.pop()
        here = up.join(out.select(F.col("node").alias("up"), "component"), "up", "left").select(
            "node", F.coalesce("component", "up").alias("component"))
        out = stages.keep(here.unionByName(out), "components")
    return out

"""Ingredient lines at table scale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import vocabulary as voc
from larder.functions.lines import parse_lines
from larder.operators.joins import spread_join
from larder.session import materialize


# A line is hot above one part in this many; there are fewer hot lines than that.
HOT_PARTS = 1000


def normalize(df: DataFrame, spread: Sequence[str], line: str = "line") -> DataFrame:
    """Parse every distinct line once and give the result back to each row.

    Lines repeat heavily, so the parse runs on the distinct texts, counted with
    a map-side combine and stored. The plan is the same at every size: the hot
    lines, fewer than ``HOT_PARTS`` by their share, are broadcast, and all other
    rows meet their line in a join for which the planner sees the stored table's
    bytes; where that shuffles, hot rows travel under keys made from ``spread``.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = df.where(F.col(line).isNotNull()).groupBy(line).agg(F.count(F.lit(1)).alias("_rows"))
    table = materialize(parse_lines(texts.repartition(n), line), "lines")
    parsed = [c for c in table.columns if c not in (line, "_rows")]
    return join_hot_apart(df, table, line, parsed, spread)


def join_hot_apart(
    df: DataFrame, table: DataFrame, key: str, columns: Sequence[str], spread: Sequence[str]
) -> DataFrame:
    """Left join to a stored ``table`` (unique ``key``, row counts in ``_rows``), hot keys by broadcast."""
    total = table.agg(F.sum("_rows").alias("n")).scalar()
    values = F.struct(*columns)
    is_hot = F.col("_rows") * HOT_PARTS > total
    hot = table.where(is_hot).select(key, values.alias("_hot"))
    cold = table.where(~is_hot).select(F.col(key).alias("_key"), values.alias("_cold"))
    apart = F.col("_hot").isNotNull() | F.col(key).isNull()
    return (
        df.join(F.broadcast(hot), key, "left")
        .withColumn("_key", F.when(apart, F.concat(F.lit("\x00"), F.xxhash64(*spread).cast("string"))).otherwise(F.col(key)))
        .join(cold, "_key", "left")
        .select(*df.columns, F.coalesce("_hot", "_cold").alias("_values"))
        .select(*df.columns, *[F.col(f"_values.{c}").alias(c) for c in columns])
    )


def convert(parsed: DataFrame, table: DataFrame, spread: Sequence[str], name: str = "cleaned") -> DataFrame:
    """Replace average factors by an ingredient's own where ``table`` has them.

    ``table(ingredient, per_cup, per_count)`` has one row per ingredient. A
    weight given in the line stays.
    """
    known = table.select(F.col("ingredient").alias(name), "per_cup", "per_count")
    joined = spread_join(parsed, known, [name], spread)
    weight = F.coalesce(
        F.col("measured_weight"),
        F.col("exact_volume") * F.coalesce("per_cup", F.lit(voc.GRAMS_PER_CUP)),
        F.col("exact_count") * F.coalesce("per_count", F.lit(voc.GRAMS_PER_COUNT)),
    )
    return joined.withColumn("weight", F.round(weight, 4)).drop("per_cup", "per_count")


def conversion_table(portions: DataFrame) -> DataFrame:
    """``portions(ingredient, measure, grams)`` -> one row per ingredient: grams per cup and per count.

    The measure is read as an ingredient line, each distinct one once; several
    portions give their median, which is taken over counted values, so that an
    ingredient with very many portions is merged in two steps. Ingredients that
    cannot be measured drop out.
    """
    lines = portions.select("ingredient", "grams", F.concat("measure", F.lit(" x")).alias("line"))
    read = normalize(lines, ["ingredient", "grams"])
    per_cup = F.try_divide(F.col("grams"), F.col("exact_volume"))
    per_count = F.when(F.col("exact_volume").isNull(), F.try_divide(F.col("grams"), F.col("exact_count")))
    values = read.select("ingredient", per_cup.alias("per_cup"), per_count.alias("per_count"))
    counted = values.groupBy("ingredient", "per_cup", "per_count").agg(F.count(F.lit(1)).alias("n"))
    middle = {c: F.percentile(c, F.lit(0.5), F.col("n")).alias(c) for c in ("per_cup", "per_count")}
    return counted.groupBy("ingredient").agg(*middle.values()).where(F.col("per_cup").isNotNull() | F.col("per_count").isNotNull())
